"""Periodic runs of words: stretches that repeat one and the same block at least three times.

A run is a stretch of words with smallest period q (words q apart are identical) that is at
least ``times`` blocks and ``shortest`` words long and that no neighbour extends.

- What can be no run is left out first, exactly: a run of length L holds the window of
  its first L - q words again q words later, and L - q is at least
  ceil(shortest * (times - 1) / times). So every word of a run lies in a window of that many
  words that its document has twice. All other words become one cut between stretches.
- The stretches of many documents make one sequence, each ended by a symbol of its own.
  Its enhanced suffix array is the suffix array, its inverse and the common prefixes of
  neighbours. The LCP intervals of that are the branching places of a suffix tree; no
  node of such a tree is built.
- Branching tandem test: for an interval of depth q, every suffix i of all child
  intervals but the largest asks with ``inverse[i + q]`` and ``inverse[i - q]`` whether
  its neighbour one block on lies in the interval too. If so, and if the next words
  differ, a square of period q begins at i (or i - q) and cannot be moved to the right.
  A place is in the smaller part of at most log2(n) intervals.
- Each such square is rotated to the left as long as the words agree, which gives the
  whole run. Squares of a power of a block end where the block's own run ends; the smallest
  period comes first and the others are dropped.

A document's runs need its own words only, so there is no shuffle: one pass over the texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.common import WORD, column_bytes, gram_hashes, mix, runs_of, word_hashes, word_spans

#: Bytes of text searched together, and places of smaller children tested together.
_TEXT, _TESTED = 8 << 20, 1 << 21
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


# --- the enhanced suffix array -------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes, each suffix's place in it, and the common prefix of neighbours (0 first).

    Prefix doubling: the ranks of all prefixes of 1, 2, 4 .. symbols; the kept ranks then
    give the common prefixes from the longest power down.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1]
    levels, width = [rank.astype(np.int32)], 1
    while n and rank.max() + 1 < n:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        rank = np.unique(rank * np.int64(n + 1) + after, return_inverse=True)[1]
        levels.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    shared = np.zeros(n, np.int64)
    a, b = order[:-1], order[1:]
    same = np.zeros(max(0, n - 1), np.int64)
    for step, level in reversed([(1 << i, x) for i, x in enumerate(levels)]):
        inside = np.flatnonzero(b + same < n) if n else same
        inside = inside[a[inside] + same[inside] < n]
        met = inside[level[a[inside] + same[inside]] == level[b[inside] + same[inside]]]
        same[met] += step
    shared[1:] = same
    return order, rank, shared


def lcp_intervals(shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary k with a common prefix: first and last place of the interval of that depth around it."""
    n = len(shared)
    depths = shared.tolist()
    low, high = [0] * n, [n - 1] * n
    stack: list[int] = []
    for k in range(1, n):
        depth = depths[k]
        while stack and depths[stack[-1]] > depth:
            high[stack.pop()] = k - 1
        if stack and depths[stack[-1]] == depth:
            low[k] = low[stack[-1]]
        else:
            low[k] = stack[-1] if stack else 0
        stack.append(k)
    return np.array(low, np.int64), np.array(high, np.int64)


def smaller_children(shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of all LCP intervals but the largest of each: their first and last place, and the interval's depth, first and last place."""
    first, last = lcp_intervals(shared)
    k = np.flatnonzero(shared > 0)
    k = k[np.lexsort((k, last[k], first[k]))]
    if not len(k):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.concatenate(([True], (first[k][1:] != first[k][:-1]) | (last[k][1:] != last[k][:-1])))
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    lb, rb, depth = first[k][heads], last[k][heads], shared[k][heads]
    tails = np.append(heads[1:], len(k))
    begin, end = np.insert(k, heads, lb), np.insert(k - 1, tails, rb)
    owner = np.insert(group, heads, np.arange(len(heads)))
    size = end - begin + 1
    most = np.maximum.reduceat(size, heads + np.arange(len(heads)))[owner]
    top = np.flatnonzero(size == most)
    top = top[np.concatenate(([True], owner[top][1:] != owner[top][:-1]))]
    keep = np.ones(len(size), bool)
    keep[top] = False
    owner = owner[keep]
    return begin[keep], end[keep], depth[owner], lb[owner], rb[owner]


def branching_squares(symbols: np.ndarray) -> np.ndarray:
    """Columns (start, period) of all squares that the next symbol does not prolong, by period, then start.

    The last symbol must stand nowhere else.
    """
    order, place, shared = suffix_array(symbols)
    begin, end, depth, lb, rb = smaller_children(shared)
    size = end - begin + 1
    edges = np.concatenate(([0], np.cumsum(size)))
    found = [np.zeros((2, 0), np.int64)]
    for i, j in runs_of(edges, _TESTED):
        n = size[i:j]
        at = np.repeat(begin[i:j] - (edges[i:j] - edges[i]), n) + np.arange(n.sum())
        suffix, q, low, high = order[at], *(np.repeat(x[i:j], n) for x in (depth, lb, rb))
        for start, other in ((suffix, suffix + q), (suffix - q, suffix - q)):
            ok = np.flatnonzero((start >= 0) & (other < len(symbols)))
            ok = ok[(place[other[ok]] >= low[ok]) & (place[other[ok]] <= high[ok])]
            # in different children: what follows the two blocks differs
            ok = ok[symbols[start[ok] + q[ok]] != symbols[start[ok] + 2 * q[ok]]]
            found.append(np.stack((start[ok], q[ok])))
    squares = np.unique(np.concatenate(found, axis=1)[::-1], axis=1)[::-1]
    return squares


def find_runs(symbols: np.ndarray, shortest: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs; the last symbol must stand nowhere else."""
    start, period = branching_squares(symbols)
    # a run of three blocks or more goes on to the left of its last two
    before = np.maximum(start - 1, 0)
    fine = (start > 0) & (symbols[before] == symbols[before + period])
    runs: list[tuple[int, int, int]] = []
    ending: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for b, q in zip(start[fine].tolist(), period[fine].tolist()):
        stop = b + 2 * q
        if any(q % p == 0 and s <= b for s, p in ending[stop]):
            continue
        first = rotated(symbols, b, q)
        ending[stop].append((first, q))
        if stop - first >= max(shortest, times * q):
            runs.append((first, stop - first, q))
    return sorted(runs)


def rotated(symbols: np.ndarray, start: int, period: int) -> int:
    """The first place to which the square at ``start`` can be moved, one symbol at a time."""
    step = 32
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(symbols[low:start] != symbols[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, step * 2
    return start


# --- texts ---------------------------------------------------------------------------


def repeated_stretches(words: np.ndarray, firsts: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window that their own text (``firsts`` has the bounds) holds twice."""
    covered = np.zeros(len(words) + 1, np.int64)
    grams = gram_hashes(words, window)
    if len(grams):
        owner = np.searchsorted(firsts, np.arange(len(grams)), "right") - 1
        whole = np.flatnonzero(np.arange(len(grams)) + window <= firsts[owner + 1])
        keys = mix(grams[whole] + owner[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        covered[whole[twice]] += 1
        covered[whole[twice] + window] -= 1
    return np.cumsum(covered[:-1]) > 0


def runs_of_texts(words: np.ndarray, firsts: np.ndarray, shortest: int, times: int) -> list[tuple[int, int, int]]:
    """Runs of all texts, by the number of their first word among all words."""
    window = max(1, -(-shortest * (times - 1) // times))
    covered = repeated_stretches(words, firsts, window)
    at = np.flatnonzero(covered)
    if not len(at):
        return []
    text = np.searchsorted(firsts, at, "right") - 1
    ends = np.append(np.flatnonzero((np.diff(at) > 1) | (np.diff(text) > 0)), len(at) - 1) + 1
    codes = np.unique(words[at], return_inverse=True)[1].astype(np.int64)
    # behind each stretch a symbol that stands nowhere else
    symbols = np.insert(codes, ends, len(codes) + np.arange(len(ends)))
    origin = np.insert(at, ends, -1)
    return [(int(origin[s]), n, q) for s, n, q in find_runs(symbols, shortest, times)]


def _kept_texts(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    take = np.cumsum(edge[:-1]) > 0
    # a word that is not its text's first kept one has a blank of some kind before it
    before = np.concatenate(([0], np.cumsum(kept)))
    text = np.searchsorted(firsts, np.arange(len(starts)), "right") - 1
    blank = starts[kept & (before[:-1] > before[firsts[text]])] - 1
    out = data.copy()
    out[blank] = 32
    take[blank] = True
    offsets = np.concatenate(([0], np.cumsum(take)))[bounds]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[take]))


def _collapse(shortest: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_data, all_bounds = column_bytes(batch.column(1))
            for i, j in runs_of(all_bounds, _TEXT):
                data, bounds = all_data[all_bounds[i] : all_bounds[j]], all_bounds[i : j + 1] - all_bounds[i]
                starts, ends, firsts = word_spans(data, bounds)
                found = runs_of_texts(word_hashes(data, starts, ends), firsts, shortest, times)
                gone = np.zeros(len(starts) + 1, np.int64)
                rows: list[list[tuple[int, int, int]]] = [[] for _ in range(j - i)]
                for s, n, q in found:
                    text = int(np.searchsorted(firsts, s, "right")) - 1
                    rows[text].append((s - int(firsts[text]), n, q))
                    gone[s + q] += 1
                    gone[s + n] -= 1
                kept = np.cumsum(gone[:-1]) == 0
                runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in row] for row in rows], pa.list_(_RUN))
                texts = _kept_texts(data, bounds, starts, ends, firsts, kept)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(firsts)), runs, texts], ["doc_id", "n_words", "runs", "text"]
                )

    return run


def collapse_runs(docs: DataFrame, shortest: int = 24, times: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and the ``text`` without what repeats.

    Words are runs of other characters than blanks and controls 9 to 13. ``runs`` has
    (start, length, period) by start, then period; words count from 0. A word goes if some
    run holds it behind that run's first block; kept words are joined by one blank. Words are
    compared by 64-bit hashes. A null, empty or blank text has no words, no runs and the
    empty text. Rows are documents of their own, so equal rows give equal rows and a null id
    stays null. Without documents the result is empty. Further columns are ignored.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")  # a square alone need not go on to the left
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(_collapse(shortest, times), f"doc_id long, {RESULT}")
    return found.withColumnsRenamed({"doc_id": doc_id, "text": text})


# --- the query -----------------------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents made periodic from some word on, by the crc32 of the id; the others unchanged."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words").cast("long")
    planted = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    rows = docs.select("doc_id", "text", planted.alias("words"), g.alias("g"))
    rows = rows.withColumn("a", F.when(F.size("words") > 0, (F.col("g") % n).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    periodic = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((size(words) - a) / p) as int))), 1, size(words) - a)")
    text = F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.expr("slice(words, 1, a)"), periodic), " "))
    return rows.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``collapse_runs``."""
    strongest = F.reduce(
        "runs", F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)"),
        lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best),
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("top", strongest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("floor(1000 * top.length / top.period)").cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def oracle() -> str:
    """Runs as islands of equal 16-word windows a fixed distance apart."""
    return r"""
WITH RECURSIVE crc(i, j, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT i, j + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE j < 8),
t AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc WHERE j = 8),
d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda s, c: xor(t[1 + (xor(s, c) & 255)], s >> 8)), 4294967295) AS h
  FROM documents, t),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, n,
    CASE WHEN a IS NULL THEN w ELSE [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] END AS w
  FROM p),
g AS MATERIALIZED (SELECT r, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS g FROM (SELECT r, w, unnest(range(n - 15)) AS i FROM x WHERE n >= 24)),
e AS MATERIALIZED (SELECT r, l.i, k.i - l.i AS q FROM g l JOIN g k USING (r, g) WHERE k.i > l.i),
-- an island of windows i .. j at distance q: words i .. j + 15 + q have period q
s AS MATERIALIZED (
  SELECT r, min(i) AS s, max(i) + 16 + q - min(i) AS l, q
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e) GROUP BY r, q, island),
m AS MATERIALIZED (SELECT r, s, l, min(q) AS q FROM s WHERE l >= greatest(24, 3 * q) GROUP BY r, s, l),
b AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
    list(struct_pack(s := s, l := l, q := q) ORDER BY l / q DESC, s, q)[1] AS top
  FROM m GROUP BY r),
f AS (SELECT DISTINCT r, i FROM (SELECT r, unnest(range(s + q, s + l)) AS i FROM m)),
k AS (
  SELECT x.r, string_agg(x.v, ' ' ORDER BY x.i) AS kept
  FROM (SELECT r, unnest(w) AS v, unnest(range(n)) AS i FROM x) x LEFT JOIN f ON f.r = x.r AND f.i = x.i WHERE f.r IS NULL GROUP BY x.r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.l::BIGINT AS length, top.q::BIGINT AS period,
  (1000 * top.l // top.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM x LEFT JOIN b USING (r) LEFT JOIN k USING (r)"""
