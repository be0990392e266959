"""Finding windows of a corpus that start in more than one place.

A text is a sequence of symbols (bytes or words) and a window is ``depth`` neighbouring
symbols of one text. Equal windows hold equal runs of ``gram`` symbols at equal offsets,
so the run with the smallest hash of a window, its anchor, is the same run for both.
The work goes in four steps, each ending in a written table:

1. Every window names its anchor; neighbouring windows with one anchor hash are one row
   (hash, text, first window, number of windows, number of places with that hash), about one
   row for half a window of text. In a run of one symbol, or of a short period, the hash stays
   while its place moves, so the run is one row, too; rows of more than ``LONGEST`` windows are cut.
2. Rows whose hash has one place in all texts are dropped: their windows are unique.
3. The stretch of text of each remaining row goes to the task of its hash, where a
   solver (the operator's method) puts equal windows in one class. Hashes with more than
   ``HOT`` rows or symbols are dealt to several tasks; those also write one hash per class of
   windows, and an aggregation finds the classes that other tasks hold too.
4. The windows found come back to their texts by key, and the texts lose what they cover.

A row of documents is known by a hash of its id and text, so null ids, repeated ids and
repeated rows are all separate documents, and equal rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.llm.common import byte_values, column_bytes, discard, gram_hashes, release, runs_of, word_hashes, word_spans, written

#: Rows of one hash that go to one task, and their symbols; windows of one row.
HOT, HOT_SYMBOLS, LONGEST = 4096, 1 << 20, 1 << 14
#: Bytes of stretches that are solved at once.
BLOCK = 4 << 20
_PIECE = 1 << 22
#: Bytes of stretches in one batch.
_SHIPPED = 16 << 20
_LOW = np.uint64((1 << 24) - 1)

#: (bytes of all stretches, their bounds, windows in each) -> class of each window, in order
Solver = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Symbols:
    """What a text is a sequence of."""

    words: bool

    def read(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes (words: one blank between), start and end byte of each symbol, first symbol of each text."""
        if not self.words:
            at = np.arange(len(data) + 1)
            return data, at[:-1], at[1:], bounds
        starts, ends, firsts = word_spans(data, bounds)
        inside = (data != 32) & ((data < 9) | (data > 13))
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        moved = np.concatenate(([0], np.cumsum(keep)))
        return np.where(inside, data, np.uint8(32))[keep], moved[starts], moved[ends], firsts

    def values(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return word_hashes(data, starts, ends) if self.words else byte_values(data)


BYTES, WORDS = Symbols(False), Symbols(True)


# --- step 1: anchors ---------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, n = 1, len(x) - width + 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def anchors(values: np.ndarray, firsts: np.ndarray, gram: int, depth: int) -> tuple[np.ndarray, ...]:
    """Of all windows inside texts: anchor hash, text, first window, number of windows and of places of each row."""
    width, n = depth - gram + 1, len(values) - depth + 1
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    if n <= 0:
        return nothing
    hashes = gram_hashes(values, gram)
    place = _sliding_min((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), width) & _LOW
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[:n]
    at = np.flatnonzero(firsts[1:][text] - np.arange(n) >= depth)
    if not len(at):
        return nothing
    spot, text = place[at].astype(np.int64), text[at]
    hash_ = hashes[spot]
    other = np.concatenate(([True], text[1:] != text[:-1]))
    moves = other | np.concatenate(([True], spot[1:] != spot[:-1]))
    new = np.flatnonzero(other | np.concatenate(([True], hash_[1:] != hash_[:-1])))
    places, n = np.add.reduceat(moves.astype(np.int64), new), np.diff(np.append(new, len(at)))
    start, hash_, text = at[new] - firsts[text[new]], hash_[new].view(np.int64), text[new]
    pieces = -(-n // LONGEST)
    if pieces.max() == 1:
        return hash_, text, start, n, places
    row = np.repeat(np.arange(len(n)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return hash_[row], text[row], start[row] + nth * LONGEST, np.minimum(n[row] - nth * LONGEST, LONGEST), -(-places[row] // pieces[row])


def _anchor_rows(symbols: Symbols, gram: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, bounds = column_bytes(batch.column(1))
            for first, last in runs_of(bounds, 1 << 20):
                part, limits = data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
                body, starts, ends, firsts = symbols.read(part, limits)
                values = symbols.values(body, starts, ends)
                # a text longer than a piece is cut into pieces that share depth - 1 symbols
                for at in range(0, max(1, len(values)), _PIECE):
                    some = values[at : at + _PIECE + depth - 1]
                    here = np.clip(firsts - at, 0, len(some)) if len(values) > _PIECE else firsts
                    hashes, text, start, n, places = anchors(some, here, gram, depth)
                    start = start + np.maximum(at - firsts[text], 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes), pa.array(keys[first + text]), pa.array(start), *[pa.array(x.astype(np.int32)) for x in (n, places)]],
                        ["h", "key", "start", "n", "places"],
                    )

    return run


# --- step 3: stretches and classes ---------------------------------------------------


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a binary column."""
    sizes = ends - starts
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    index = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[index])])


def _stretches(symbols: Symbols, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, bounds = column_bytes(batch.column(1))
            rows = batch.column(2)
            edges = rows.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            h, salt, split, start, n = (rows.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(5))
            for first, last in runs_of(bounds, 1 << 20):
                part, limits = data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
                body, starts, ends, firsts = symbols.read(part, limits)
                for some in range(int(edges[first]), int(edges[last]), 50_000):
                    mine = slice(some, min(some + 50_000, int(edges[last])))
                    text = np.searchsorted(edges, np.arange(mine.start, mine.stop), "right") - 1
                    at = firsts[text - first] + start[mine]
                    low, high = starts[at], ends[at + n[mine] + depth - 2]
                    for i, j in runs_of(np.concatenate(([0], np.cumsum(high - low))), _SHIPPED):
                        part_ = slice(mine.start + i, mine.start + j)
                        yield pa.RecordBatch.from_arrays(
                            [*[pa.array(x[part_]) for x in (h, salt, split)], pa.array(keys[text[i:j]]), pa.array(start[part_]), pa.array(n[part_]), _gather(body, low[i:j], high[i:j])],
                            ["h", "salt", "split", "key", "start", "n", "stretch"],
                        )

    return run


_HITS = "key long, start long, stop long, w1 long, w2 long, twice boolean"
_NAMES = [x.split()[0] for x in _HITS.split(", ")]


def _solve(block: pa.Table, symbols: Symbols, depth: int, solver: Solver) -> Iterator[pa.RecordBatch]:
    data, bounds = column_bytes(block.column("stretch"))
    view = data.tobytes()
    n = block.column("n").to_numpy().astype(np.int64)
    # equal stretches are solved once; a window in two of them starts twice
    seen: dict[bytes, int] = {}
    which = np.array([seen.setdefault(view[a:b], len(seen)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.int64)
    one, first = np.unique(which, return_index=True)
    text = b"".join(seen)
    limits = np.concatenate(([0], np.cumsum([len(x) for x in seen]))).astype(np.int64)
    windows = n[first]
    classes = solver(np.frombuffer(text, np.uint8), limits, windows)
    owner = np.repeat(one, windows)
    times = np.bincount(which, minlength=len(one))
    twice = np.bincount(classes, weights=times[owner])[classes] > 1
    begins = np.concatenate(([0], np.cumsum(windows)))

    # runs of windows found, for each row
    keys, starts = block.column("key").to_numpy(), block.column("start").to_numpy()
    edge = np.diff(np.concatenate(([0], twice.astype(np.int8), [0])))
    rise = (edge[:-1] == 1) | (twice & np.isin(np.arange(len(twice)), begins[:-1]))
    fall = (edge[1:] == -1) | (twice & np.isin(np.arange(len(twice)) + 1, begins[1:]))
    run_from, run_to = np.flatnonzero(rise), np.flatnonzero(fall) + 1
    run_of = owner[run_from]
    low, high = np.searchsorted(run_of, which), np.searchsorted(run_of, which, "right")
    count = high - low
    row = np.repeat(np.arange(len(which)), count)
    run = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    shift = starts[row] - begins[which[row]]
    nothing = pa.nulls(len(row), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[row]), pa.array(shift + run_from[run]), pa.array(shift + run_to[run]), nothing, nothing, pa.nulls(len(row), pa.bool_())], _NAMES
    )

    # of hashes dealt to several tasks, one window of each class
    split = block.column("split").to_numpy(zero_copy_only=False)
    if not split.any():
        return
    someone = np.full(len(one), -1, np.int64)
    someone[which[split]] = np.flatnonzero(split)
    at = np.flatnonzero(someone[owner] >= 0)
    _, pick = np.unique(classes[at], return_index=True)
    at = at[pick]
    offset = at - begins[owner[at]]
    _, s, e, firsts = symbols.read(np.frombuffer(text, np.uint8), limits) if not symbols.words else (None, *word_spans(np.frombuffer(text, np.uint8), limits))
    where = firsts[owner[at]] + offset
    marks = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(s[where].tolist(), e[where + depth - 1].tolist())]
    pair = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
    rows = someone[owner[at]]
    start = starts[rows] + offset
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (keys[rows], start, start + 1, np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1]), twice[at])], _NAMES
    )


def _blocks(symbols: Symbols, depth: int, solver: Solver):
    """Rows come ordered by hash and salt; a block ends between two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h, salt = batch.column("h").to_numpy(), batch.column("salt").to_numpy()
            bounds = column_bytes(batch.column("stretch"))[1]
            change = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1])) + 1
            if held:
                last = held[-1]
                if last.column("h")[-1].as_py() != h[0] or last.column("salt")[-1].as_py() != salt[0]:
                    change = np.concatenate(([0], change))
            done = 0
            for cut in change.tolist():
                if size + bounds[cut] - bounds[done] >= BLOCK:
                    held.append(batch.slice(done, cut - done))
                    yield from _solve(pa.Table.from_batches(held), symbols, depth, solver)
                    held, size, done = [], 0, cut
            held.append(batch.slice(done))
            size += int(bounds[-1] - bounds[done])
        if held:
            yield from _solve(pa.Table.from_batches(held), symbols, depth, solver)

    return run


# --- sorting windows ------------------------------------------------------------------


def sort_windows(at: np.ndarray, depth: int, bits: int, pack: Callable[[np.ndarray, int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions ordered by their next ``depth`` symbols, and where another window begins.

    Most significant symbols first: only positions still equal are sorted on. ``pack(at,
    skip, n)`` gives n symbols of ``bits`` bits each as one number.
    """
    take = min(depth, 64 // bits)
    key = pack(at, 0, take)
    order = np.argsort(key)
    at, key = at[order], key[order]
    begins = np.ones(len(at), bool)
    begins[1:] = key[1:] != key[:-1]
    slots = np.arange(len(at))
    mine = begins
    done = take
    while done < depth and len(slots):
        sizes = np.diff(np.append(np.flatnonzero(mine), len(slots)))
        keep = np.repeat(sizes > 1, sizes)
        slots, mine = slots[keep], mine[keep]
        if not len(slots):
            break
        group = (np.cumsum(mine) - 1).astype(np.uint64)
        take = max(1, min((64 - int(group[-1]).bit_length()) // bits, depth - done))
        key = (group << np.uint64(take * bits)) | pack(at[slots], done, take)
        order = np.argsort(key)
        key = key[order]
        at[slots] = at[slots][order]
        mine = np.ones(len(slots), bool)
        mine[1:] = key[1:] != key[:-1]
        begins[slots] = mine
        done += take
    return at, begins


# --- the whole ------------------------------------------------------------------------


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def repeated_windows(docs: DataFrame, symbols: Symbols, depth: int, gram: int, solver: Solver, doc_id: str, text: str) -> DataFrame:
    """Rows ``key``, ``windows``: for each text that has any, the ranges of starts of windows found elsewhere."""
    spark = docs.sparkSession
    rows = docs.select(row_key(doc_id, text).alias("key"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    found = written(rows.mapInArrow(_anchor_rows(symbols, gram, depth), "h long, key long, start long, n int, places int"), "anchors")

    # written, so that both sides of the join are plain shuffles and Spark splits hot hashes
    often = found.groupBy("h").agg(F.sum("places").alias("places"), F.count(F.lit(1)).alias("times"), F.sum(F.col("n") + depth).alias("symbols"))
    often = written(often.where("places > 1").select("h", F.greatest(F.ceil(F.col("times") / HOT), F.ceil(F.col("symbols") / HOT_SYMBOLS)).alias("parts")), "often")
    parts = F.col("parts")
    salt = F.pmod(F.xxhash64("key", "start"), parts).cast("int")
    again = found.join(often, "h").select(F.struct("h", salt.alias("salt"), (parts > 1).alias("split"), "start", "n").alias("row"), "key")
    # equal documents have equal rows, each of which is wanted once here and once for each copy below
    again = written(again.groupBy("key").agg(F.collect_set("row").alias("rows")), "repeated-anchors")
    discard(found, often)
    release(spark)

    pieces = rows.join(again, "key").select("key", "text", "rows").mapInArrow(
        _stretches(symbols, depth), "h long, salt int, split boolean, key long, start long, n int, stretch binary"
    )
    pieces = pieces.repartition("h", "salt").sortWithinPartitions("h", "salt")
    hits = written(pieces.mapInArrow(_blocks(symbols, depth, solver), _HITS), "windows")
    del pieces
    discard(again)
    release(spark)

    elsewhere = hits.where("w1 is not null").groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("tasks")).where("tasks > 1")
    # every window not found twice is one row for each task, so a hot one is few rows here
    late = hits.where("w1 is not null and not twice").join(elsewhere, ["w1", "w2"]).select("key", "start", "stop")
    every = hits.where("w1 is null").select("key", "start", "stop").unionByName(late)
    return every.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("windows"))


def remove_windows(docs: DataFrame, windows: DataFrame, symbols: Symbols, depth: int, doc_id: str, text: str) -> DataFrame:
    """All columns of ``docs`` with ``n_symbols``, ``kept`` (bytes) and ``removed`` (ranges of symbols)."""
    new = "n_symbols long, kept binary, removed array<struct<start: long, stop: long>>"
    names = ["n_symbols", "kept", "removed"]
    base = [f for f in docs.schema.fields if f.name.lower() not in {*names, "_key", "_text", "_windows"}]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base)
    fed = docs.select(*[F.col(f"`{f.name}`") for f in base], row_key(doc_id, text).alias("_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    fed = fed.join(windows.select(F.col("key").alias("_key"), F.col("windows").alias("_windows")), "_key", "left")
    fed = fed.select(*[F.col(f"`{f.name}`") for f in base], "_text", "_windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = column_bytes(batch.column("_text"))
            for first, last in runs_of(bounds, 1 << 20):
                part, limits = data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
                body, starts, ends, firsts = symbols.read(part, limits)
                sizes = np.diff(firsts)
                view = body.tobytes()
                kept, removed = [], []
                for i, ranges in enumerate(batch.column("_windows").slice(first, last - first).to_pylist()):
                    a, b = int(firsts[i]), int(firsts[i + 1])
                    if a == b:
                        kept.append(b"")
                        removed.append([])
                        continue
                    # windows as ranges of starts become ranges of symbols; touching ones are one
                    spans: list[list[int]] = []
                    for r in sorted((x["start"], x["stop"]) for x in ranges or ()):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], r[1] + depth - 1)
                        else:
                            spans.append([r[0], r[1] + depth - 1])
                    edges = [0, *(x for s in spans for x in s), b - a]
                    pieces = [(a + x, a + y) for x, y in zip(edges[::2], edges[1::2]) if x < y]
                    join = b" " if symbols.words else b""
                    kept.append(join.join(view[starts[x] : ends[y - 1]] for x, y in pieces))
                    removed.append([{"start": x, "stop": y} for x, y in spans])
                rest = [batch.column(i).slice(first, last - first) for i in range(len(base))]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(sizes), pa.array(kept, pa.binary()), pa.array(removed, kind)], [*[f.name for f in base], *names]
                )

    return fed.mapInArrow(run, f"{kinds}, {new}")


def removed_count() -> Column:
    """Number of symbols removed from a text."""
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
