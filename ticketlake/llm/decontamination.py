"""Benchmark decontamination by template windows.

Texts and benchmark items are canonicalised alike: punctuation goes, letters become
lower case, and words with a digit, unit words behind a number, and capitalised words
inside a sentence become the placeholders number, unit and name. Whether a word begins a
sentence, and whether a text is all in capitals or all in small letters, may differ between
an item and its copy; so windows of both also stand with names as words, with capitalised
words at the start of a sentence as names, and as plain words.
Runs of ``width`` template words are windows. Windows of the documents are looked
up by hash among the item windows; a document holds an item if enough of the
item's windows stand in it along one line, after windows whose slots contradict
the others are dropped: one item value must always stand for the same document
value and the other way round. Equal slots mean a copy, consistent ones that
differ a re-parameterised question.

The item windows travel to the tasks in blocks of bounded size; a benchmark of
many blocks costs one scan of the documents for each.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.common import column_bytes, gram_hashes, lower_utf8, mix, runs_of, span_hashes, word_hashes, word_spans

# --- fixed values: words that are units behind a number ----------------------------
UNITS = (
    "mm cm m km meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard yards "
    "mg g kg gram grams kilogram kilograms ton tons pound pounds ounce ounces ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars euro euros cent cents eur usd kmh mph hz kb mb gb tb volt volts watt watts"
).split()

WIDTH = 5
SHARE = 0.8
#: Item windows in one block, each in up to four forms.
BLOCK_WINDOWS = 1_000_000
#: Words a line may be shifted by inserted or missing words.
SLACK = 3
_NUMBER, _UNIT, _NAME = 1, 2, 3
_SLOT = mix(np.array([0, 101, 102, 103], np.uint64))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    return np.sort(span_hashes(data, starts, ends))


@dataclass
class Template:
    tokens: np.ndarray  # hash of the template word
    values: np.ndarray  # hash of the word itself
    kinds: np.ndarray  # 0 or the slot's kind
    names: np.ndarray  # the kind if a sentence began nowhere
    firsts: np.ndarray  # of each text, the index of its first word


def canonicalise(data: np.ndarray, bounds: np.ndarray, units: np.ndarray) -> Template:
    """Template words of all texts in a byte array."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    digit = (data >= 48) & (data <= 57)
    lowered, upper = lower_utf8(data)
    letter = ((lowered >= 97) & (lowered <= 122)) | (data >= 128)
    keep = space | digit | letter
    # a sentence begins after . ! ? : or a line break, with only other characters than words between
    stop = (data == 46) | (data == 33) | (data == 63) | (data == 58) | (data == 10)
    moved = np.concatenate(([0], np.cumsum(keep)))
    stops, small = np.concatenate(([0], np.cumsum(stop)))[:-1][keep], lowered[keep]
    upper, digit = upper[keep], digit[keep]
    limits = moved[bounds]
    starts, ends, firsts = word_spans(small, limits)
    if not len(starts):
        nothing = np.zeros(0, np.uint64)
        return Template(nothing, nothing, np.zeros(0, np.int8), np.zeros(0, np.int8), firsts)
    values = word_hashes(small, starts, ends)
    digits = np.concatenate(([0], np.cumsum(digit)))
    number = digits[ends] > digits[starts]
    begins = np.zeros(len(starts), bool)
    begins[firsts[:-1][firsts[:-1] < len(starts)]] = True
    fresh = begins.copy()
    fresh[1:] |= stops[starts[1:]] > stops[ends[:-1] - 1]
    kinds = np.zeros(len(starts), np.int8)
    # a name has one capital, its first letter (of one or two bytes); words all in capitals are words
    uppers = np.concatenate(([0], np.cumsum(upper)))
    title = (uppers[ends] - uppers[starts] == 1) & (uppers[np.minimum(starts + 2, ends)] > uppers[starts])
    kinds[title & (upper[starts] | (small[starts] >= 128)) & (ends - starts > 2)] = _NAME
    kinds[number] = _NUMBER
    after = np.zeros(len(starts), bool)
    after[1:] = number[:-1] & ~begins[1:]
    if after.any():
        at = np.flatnonzero(after & ~number)
        place = np.minimum(np.searchsorted(units, values[at]), len(units) - 1)
        kinds[at[units[place] == values[at]]] = _UNIT
    names, kinds = kinds, np.where(fresh & (kinds == _NAME), 0, kinds).astype(np.int8)
    return Template(np.where(kinds > 0, _SLOT[kinds], values), values, kinds, names, firsts)


def _windows(t: Template, width: int, kinds: np.ndarray | None = None, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window inside one text with two literal words (all literal if shorter), and its hash.

    ``kinds`` are used in place of the template's; then only windows in which they differ from ``known`` count.
    """
    hashes = gram_hashes(t.tokens if kinds is None else np.where(kinds > 0, _SLOT[kinds], t.values), width)
    ok = (np.repeat(t.firsts[1:], np.diff(t.firsts)) - np.arange(len(t.tokens)) >= width)[: len(hashes)]
    literal = np.concatenate(([0], np.cumsum((t.kinds if kinds is None else kinds) == 0)))
    ok &= (literal[width:] - literal[:-width])[: len(ok)] >= min(2, width)
    if kinds is not None:
        other = np.concatenate(([0], np.cumsum(kinds != known)))
        ok &= (other[width:] > other[:-width])[: len(ok)]
    at = np.flatnonzero(ok)
    return at, hashes[at]


def _all_windows(t: Template, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the template, with names as words, with names also where sentences begin, and of plain words; each once."""
    named = np.where(t.kinds == _NAME, 0, t.kinds)
    forms = [_windows(t, width), _windows(t, width, named, t.kinds), _windows(t, width, t.names, t.kinds), _windows(t, width, np.zeros_like(t.kinds), named)]
    at, hashes = (np.concatenate(x) for x in zip(*forms))
    return at, hashes


@dataclass
class Index:
    """Windows of some items: sorted hashes per width, and where each stands."""

    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # width: hash, item, position
    need: dict[int, tuple[int, int]]  # item: windows it has, their width
    words: dict[int, tuple[np.ndarray, np.ndarray]]  # item: values, kinds


def build_index(items: list[tuple[int, str]], width: int = WIDTH) -> Index:
    units = _unit_hashes()
    rows: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
    index = Index({}, {}, {})
    for n, (_, text) in enumerate(items):
        data = np.frombuffer((text or "").encode(), np.uint8)
        t = canonicalise(data, np.array([0, len(data)]), units)
        size = min(width, len(t.tokens))
        if not size:
            continue
        at, _ = _windows(t, size)
        every, hashes = _all_windows(t, size)
        if len(at):
            counted = np.isin(every, at)
            every, hashes = every[counted], hashes[counted]
        else:
            # too few words besides slots: only an exact copy is one, with all its plain words
            at = np.arange(len(t.tokens) - size + 1)
            every, hashes = at, gram_hashes(t.values, size)
        index.need[n] = (len(at), size)
        index.words[n] = (t.values, t.kinds)
        rows[size].append((hashes, np.full(len(every), n), every))
    for size, parts in rows.items():
        hashes, item, at = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(hashes, kind="stable")
        index.tables[size] = (hashes[order], item[order], at[order])
    return index


def _consistent(lines: list[tuple[int, int]], item: tuple[np.ndarray, np.ndarray], values: np.ndarray, kinds: np.ndarray, size: int) -> tuple[int, bool]:
    """Windows (document, item position) that agree on the slots; whether all slots are equal."""
    item_values, item_kinds = item
    votes: Counter = Counter()
    slots = {(i + o, j + o) for i, j in lines for o in range(size) if item_kinds[j + o] and kinds[i + o]}
    for i, j in slots:
        votes[(int(item_kinds[j]), int(item_values[j]), int(values[i]))] += 1
    there: dict[tuple[int, int], int] = {}
    back: dict[tuple[int, int], int] = {}
    for (kind, a, b), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        if (kind, a) not in there and (kind, b) not in back:
            there[kind, a], back[kind, b] = b, a
    fine = set()
    for i, j in lines:
        if all(
            there.get((int(item_kinds[j + o]), int(item_values[j + o]))) == int(values[i + o]) if item_kinds[j + o] and kinds[i + o] else item_values[j + o] == values[i + o]
            for o in range(size)
        ):
            fine.add(j)
    # a copy is one whatever the votes say
    i, j = (np.array(x)[:, None] + np.arange(size) for x in zip(*lines))
    same = len({int(x) for x in j[(item_values[j] == values[i]).all(axis=1), 0]})
    return max((len(fine), all(a == b for (_, a), b in there.items())), (same, True))


def _find(index: Index, ids: np.ndarray, width: int, share: float):
    units = _unit_hashes()

    def search(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, float, bool]]:
        t = canonicalise(data, bounds, units)
        for size, (keys, items, spots) in index.tables.items():
            if len(t.tokens) < size:
                continue
            at, hashes = _all_windows(t, size)
            first = np.searchsorted(keys, hashes)
            hit = first < len(keys)
            hit[hit] = keys[first[hit]] == hashes[hit]
            if not hit.any():
                continue
            at, first = at[hit], first[hit]
            last = np.searchsorted(keys, keys[first], "right")
            times = last - first
            where = np.repeat(at, times)
            row = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            doc = np.searchsorted(t.firsts, where, "right") - 1
            # a pair needs the share in hits before its lines are looked at
            pair = doc * len(ids) + items[row]
            order = np.argsort(pair, kind="stable")
            edges = np.flatnonzero(np.diff(pair[order], prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(order))):
                mine = order[a:b]
                item = int(items[row[mine[0]]])
                need, _ = index.need[item]
                if len(mine) < share * need:
                    continue
                i, j = where[mine], spots[row[mine]]
                by_shift = np.argsort(i - j, kind="stable")
                i, j = i[by_shift], j[by_shift]
                shift = i - j
                lines = np.unique(shift)
                # each stretch of lines with enough hits is tried: a text may hold an item more than once
                near = np.stack((np.searchsorted(shift, lines - SLACK), np.searchsorted(shift, lines + SLACK, "right")), axis=1)
                near = np.unique(near[near[:, 1] - near[:, 0] >= share * need], axis=0)
                best = 0.0, False
                for low, high in near[np.argsort(near[:, 0] - near[:, 1], kind="stable")].tolist():
                    if len(np.unique(j[low:high])) < share * need:
                        continue
                    fine, equal = _consistent(list(zip(i[low:high].tolist(), j[low:high].tolist())), index.words[item], t.values, t.names, size)
                    best = max(best, (fine / need, equal))
                    if best == (1.0, True):
                        break
                if best[0] >= share:
                    yield int(doc[mine[0]]), int(ids[item]), need, best[0], best[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            data, bounds = column_bytes(batch.column(1))
            out = []
            for first, last in runs_of(bounds, 1 << 20):
                part = data[bounds[first] : bounds[last]]
                for doc, *rest in search(part, bounds[first : last + 1] - bounds[first]):
                    out.append((int(docs[first + doc]), *rest))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_row", "item_id", "n_windows", "share", "equal"])

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, one of them on the driver at a time."""
    block, held = [], 0
    for row in benchmark.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).where(F.col(f"`{text}`").isNotNull()).toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1]) // 2 + 1
        if held >= BLOCK_WINDOWS:
            yield block
            block, held = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """One row for each document and item it holds: ``doc_id``, ``item_id``, ``n_windows``, ``share``, ``equal``.

    ``share`` of the item's windows agree; ``equal`` means that all slots have the
    item's values. Items shorter than ``width`` words are one window. Of items without a
    window of two literal words (one, if the item is one word) the windows of plain words
    count, so that copies are found. Null or empty texts and items are in no row, nor are
    rows without an id. Equal document rows give equal result rows.
    """
    found = None
    for block in _blocks(benchmark, item_id, item_text):
        block = [(i, t) for i, t in block if i is not None]
        ids = np.array([i for i, _ in block], np.int64)
        index = build_index(block, width)
        rows = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))
        part = rows.mapInArrow(_find(index, ids, width, share), "_row long, item_id long, n_windows long, share double, equal boolean")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "_row long, item_id long, n_windows long, share double, equal boolean")
    return found.withColumnRenamed("_row", "doc_id")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document id: ``doc_id``, ``leaked``, ``n_items``, ``item_id``, ``share``, ``kind``.

    ``item_id`` is the item with the largest share (then the smallest id), ``kind``
    "copy" or "reparameterised"; they are null for clean documents. A null id is a
    clean row of its own.
    """
    every = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id")).groupBy("doc_id").agg(F.lit(1).alias("_one"))
    hits = leaks(docs, benchmark, doc_id, **options)
    best = F.max(F.struct("share", (-F.col("item_id")).alias("id"), "equal"))
    hits = hits.groupBy("doc_id").agg(F.count_distinct("item_id").alias("n_items"), best.alias("b"))
    rows = every.join(hits, "doc_id", "left")
    return rows.select(
        "doc_id", F.col("b").isNotNull().alias("leaked"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        (-F.col("b.id")).alias("item_id"), F.col("b.share").alias("share"),
        F.when(F.col("b").isNotNull(), F.when(F.col("b.equal"), "copy").otherwise("reparameterised")).alias("kind"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no item, with all their columns; rows with a null id stay."""
    bad = leaks(docs, benchmark, doc_id, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(bad, F.col(f"`{doc_id}`").cast("long") == F.col("_leaked"), "left_anti")
