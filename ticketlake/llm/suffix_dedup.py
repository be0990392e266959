"""Removal of byte strings that occur more than once, by suffix arrays.

Stretches that may share a string meet in one task (see ``repeats``). There they are one
text, ended by a byte that UTF-8 never has, and its suffix array is built in two stages:
only suffixes smaller than their successors are sorted directly, on as many bytes as a
string has; the others are induced by one scan over the buckets of first bytes, from
small to large. Neighbours in the array whose common prefix is at least a string long
are one class.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ticketlake.llm.repeats import BYTES, remove_windows, removed_count, repeated_windows, sort_windows

_GRAM = 32
_END = 0xFF


def _eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number; zeros stand behind the end."""
    wide = np.zeros(len(text) + 8, np.uint64)
    wide[: len(text)] = text
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | wide[i : i + len(text)]
    return out


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than the next one.

    It is decided by the first byte that differs, so all positions of a run of equal
    bytes go together; the last suffix is larger than the empty one.
    """
    ends = np.flatnonzero(text[1:] != text[:-1])
    grows = np.append(text[ends + 1] > text[ends], False)
    return np.repeat(grows, np.diff(np.concatenate(([-1], ends, [len(text) - 1]))))


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int, eight: np.ndarray) -> np.ndarray:
    """The wanted positions (a mask) ordered by their next ``depth`` bytes at least.

    Wanted positions come in ranges; each range is first carried on to the next directly
    sorted suffix, from which the ones before it are induced.
    """
    direct = _smaller_than_next(text)
    wanted = wanted.copy()
    behind = np.flatnonzero(wanted[:-1] & ~wanted[1:])
    while len(behind := behind[~direct[behind]]):
        behind = behind + 1
        behind = behind[behind < len(text)]
        wanted[behind] = True
    at = np.flatnonzero(wanted & direct)
    pack = lambda x, skip, n: eight[np.minimum(x + skip, len(text) - 1)] >> np.uint64(64 - 8 * n)
    direct_at, _ = sort_windows(at, depth, 8, pack)
    heads = text[direct_at]
    counts = np.bincount(heads, minlength=256)
    edges = np.concatenate(([0], np.cumsum(counts)))
    induced = wanted & ~direct
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in range(256):
        # induced suffixes of this bucket, those of runs of its byte in rounds, then the sorted ones
        here = np.concatenate(pending[byte]) if pending[byte] else np.zeros(0, np.int64)
        rounds = [here]
        while len(here):
            here = here[here > 0] - 1
            here = here[induced[here] & (text[here] == byte)]
            rounds.append(here)
        bucket = np.concatenate([*rounds, direct_at[edges[byte] : edges[byte + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > byte)]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                pending[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefix(order: np.ndarray, depth: int, eight: np.ndarray) -> np.ndarray:
    """Whether each suffix of the array and the next one share ``depth`` bytes."""
    same = np.zeros(max(0, len(order) - 1), bool)
    at = np.arange(len(same))
    for skip in range(0, depth, 8):
        left = np.uint64(8 * max(0, 8 - (depth - skip)))
        a, b = eight[order[at] + skip] >> left, eight[order[at + 1] + skip] >> left
        at = at[a == b]
    same[at] = True
    return same


def solver(depth: int):
    def classes(data: np.ndarray, bounds: np.ndarray, windows: np.ndarray) -> np.ndarray:
        # every stretch and the end byte
        n = len(bounds) - 1
        text = np.full(len(data) + n, _END, np.uint8)
        shift = np.repeat(np.arange(n), np.diff(bounds))
        text[np.arange(len(data)) + shift] = data
        starts = bounds[:-1] + np.arange(n)
        at = np.arange(windows.sum()) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
        wanted = np.zeros(len(text), bool)
        wanted[at] = True
        eight = _eight(text)
        order = suffix_array(text, wanted, depth, eight)
        order = order[wanted[order]]
        number = np.concatenate(([0], np.cumsum(~common_prefix(order, depth, eight))))
        out = np.zeros(len(text), np.int64)
        out[order] = number
        return out[at]

    return classes


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text", digest: bool = True) -> DataFrame:
    """Documents without the bytes covered by a string of ``length`` bytes that also starts elsewhere.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``; with
    ``digest`` false all input columns, ``kept`` (binary) and ``removed`` (byte ranges)
    instead. Strings are judged on the input, overlapping and inside one document too.
    Null texts count as empty: 0, 0, 0 and the hash of nothing. Every row is a document
    of its own, so equal rows are copies and lose all strings; short texts stay whole.
    Without documents the result is empty. Input columns named like a result are replaced.
    """
    if length < 8:
        raise ValueError("strings of fewer than 8 bytes are not supported")
    gram = min(_GRAM, max(4, length // 2))
    windows = repeated_windows(docs, BYTES, length, gram, solver(length), doc_id, text)
    base = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")) if digest else docs
    rows = remove_windows(base, windows, BYTES, length, doc_id, text)
    if not digest:
        return rows.withColumnRenamed("n_symbols", "n_bytes")
    return rows.select(
        F.col(f"`{doc_id}`"), F.col("n_symbols").alias("n_bytes"), removed_count().alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
