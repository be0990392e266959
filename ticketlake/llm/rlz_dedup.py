"""Removal of repeated word windows by relative Lempel-Ziv parsing.

Stretches of text that may share a window meet in one task (see ``repeats``), where they
are a reference block. The block's index is the order of its windows by their words. A
stretch is factored against the block from left to right: a factor is the match with another
place of the block that the index gives, carried on word by word as far as it goes. All windows
inside a factor of at least a window's length are repeats. A greedy parse may cut a repeat in two,
so the windows that cross the boundary between two factors, which begin less than a
window before it, are looked up in the index one by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.common import WORD, word_hashes, word_spans
from ticketlake.llm.repeats import WORDS, remove_windows, removed_count, repeated_windows, sort_windows

_GRAM = 8


def longest_matches(codes: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: the words it shares from its start with some other window, its class, and that other window.

    The best match is a neighbour in the order of the index. ``at`` is in order.
    """
    bits = max(1, int(codes.max(initial=0)).bit_length())

    def pack(x: np.ndarray, skip: int, n: int) -> np.ndarray:
        out = np.zeros(len(x), np.uint64)
        for i in range(n):
            out = (out << np.uint64(bits)) | codes[x + (skip + i)]
        return out

    order, begins = sort_windows(at.copy(), depth, bits, pack)
    shared = np.full(max(0, len(order) - 1), depth, np.int64)
    open_ = np.flatnonzero(begins[1:])
    for length in range(depth):
        same = codes[order[open_] + length] == codes[order[open_ + 1] + length]
        shared[open_[~same]] = length
        open_ = open_[same]
    best = np.zeros(len(order), np.int64)
    best[1:] = shared
    best[:-1] = np.maximum(best[:-1], shared)
    place = np.empty(len(codes) + 1, np.int64)
    place[order] = np.arange(len(order))
    slot = place[at]
    # the neighbour on the side where more words are shared
    after = np.append(shared, -1)[slot] >= np.concatenate(([-1], shared))[slot]
    beside = order[np.clip(slot + np.where(after, 1, -1), 0, len(order) - 1)]
    return best[slot], (np.cumsum(begins) - 1)[slot], np.searchsorted(at, beside)


def carried_on(same: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many windows from a and from b on are equal one by one; ``stop`` is the end of each window's stretch."""
    n = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    while len(open_):
        n[open_] += 1
        x, y = a[open_] + n[open_], b[open_] + n[open_]
        more = (x < stop[a[open_]]) & (y < stop[b[open_]])
        open_, x, y = open_[more], x[more], y[more]
        open_ = open_[same[x] == same[y]]
    return n


def parse(best: np.ndarray, same: np.ndarray, other: np.ndarray, firsts: np.ndarray, windows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors of all stretches at once: the window each begins at and its length in words, however long."""
    at, stop = firsts.copy(), firsts + windows
    ends = np.repeat(stop, windows)
    starts, lengths = [], []
    while len(at):
        length = np.maximum(best[at], 1)
        long = np.flatnonzero(length >= depth)
        length[long] += carried_on(same, ends, at[long], other[at[long]]) - 1
        starts.append(at)
        lengths.append(length)
        more = at + length < stop
        at, stop = (at + length)[more], stop[more]
    return np.concatenate(starts), np.concatenate(lengths)


def inside_factors(factors: np.ndarray, lengths: np.ndarray, n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of n windows: which lie inside a factor, and which cross the boundary behind one and have to be looked up."""
    edge = np.zeros(n + 1, np.int64)
    whole = np.maximum(lengths - depth + 1, 0)
    np.add.at(edge, factors, whole > 0)
    np.add.at(edge, np.minimum(factors + whole, n), -(whole > 0).astype(np.int64))
    inside = np.cumsum(edge[:-1]) > 0
    crossing = ~inside
    crossing[factors] = False
    return inside, crossing


def solver(depth: int):
    def classes(data: np.ndarray, bounds: np.ndarray, windows: np.ndarray) -> np.ndarray:
        starts, ends, firsts = word_spans(data, bounds)
        _, codes = np.unique(word_hashes(data, starts, ends), return_inverse=True)
        begins = np.cumsum(windows) - windows
        at = np.arange(windows.sum()) + np.repeat(firsts[:-1] - begins, windows)
        best, same, other = longest_matches(codes.astype(np.uint64), at, depth)
        factors, lengths = parse(best, same, other, begins, windows, depth)
        repeat, crossing = inside_factors(factors, lengths, len(at), depth)
        repeat[crossing] = best[crossing] >= depth
        # what repeats has the class of its words, all else one of its own
        return np.where(repeat, same, len(at) + np.arange(len(at)))

    return classes


def remove_repeats(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", digest: bool = True) -> DataFrame:
    """Documents without the words covered by a window that also starts elsewhere.

    Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` (of the kept words
    joined by one blank); with ``digest`` false all input columns, ``n_words``, ``kept``
    (the text) and ``removed`` (word ranges) instead. Windows are judged on the input,
    overlapping and inside one document too. Null and empty texts have no words: 0, 0
    and the hash of nothing. Every row is a document of its own, so equal rows are copies
    and lose all windows; shorter texts stay whole. Without documents the result is
    empty. Input columns named like a result are replaced.
    """
    gram = min(_GRAM, max(1, window // 2))
    windows = repeated_windows(docs, WORDS, window, gram, solver(window), doc_id, text)
    base = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")) if digest else docs
    rows = remove_windows(base, windows, WORDS, window, doc_id, text)
    if not digest:
        return rows.withColumnRenamed("n_symbols", "n_words").withColumn("kept", F.col("kept").cast("string"))
    return rows.select(
        F.col(f"`{doc_id}`"), F.col("n_symbols").alias("n_words"), removed_count().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def oracle(window: int = 35) -> str:
    pattern = WORD.replace("\\x20", " ")
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS w FROM documents),
s AS MATERIALIZED (
  SELECT r, i, md5(array_to_string(w[i:i + {window - 1}], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - {window} + 2)) AS i FROM d WHERE len(w) >= {window})),
t AS (SELECT r, i FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
c AS MATERIALIZED (SELECT DISTINCT r, unnest(range(i, i + {window})) AS i FROM t),
x AS MATERIALIZED (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x ANTI JOIN c USING (r, i) GROUP BY x.r),
n AS (SELECT r, count(*) AS n FROM c GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r) LEFT JOIN n USING (r)"""
