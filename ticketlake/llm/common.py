"""What the operators of this folder share: tables, scratch tables, folds and byte arrays."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticketlake.session import scratch_dir

#: Word characters of the contracts: everything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Key values that are sent to all tasks rather than that the rows are shuffled: about 64 bytes each in an executor.
SENT_KEYS = 4_000_000

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, purpose: str, batch: int = 2000, tasks: int | None = None) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, and lineage ends there.

    ``batch`` rows go to Python at once while it is written, fewer where rows are wide. At most
    ``tasks`` tasks write it, where rows are known to be few for as many as shuffles have.
    """
    if tasks is not None:
        df = df.coalesce(tasks)
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    table_ = spark.read.schema(df.schema).parquet(path)
    table_._scratch = path
    return table_


def meeting(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Wide ``rows`` joined with a written table of distinct keys by ``how`` (left_semi or left_anti).

    Up to ``SENT_KEYS`` values go to the tasks that hold the rows, so that no text moves for
    them, however large the corpus is. With more Spark joins as it sees fit.
    """
    few = keys.count() * len(keys.columns) <= SENT_KEYS
    return rows.join(F.broadcast(keys) if few else keys, keys.columns, how)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that no later step reads."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished phases.

    Its cleaner acts when the driver's objects are collected, which on an idle driver
    may be long after the last use. The first round frees what Python still held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def without_clash(df: DataFrame, *names: str) -> DataFrame:
    """Input without columns whose names the operator's own results will take."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


# --- bytes of a column ---------------------------------------------------------


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary column as one byte array, and its bounds.

    Value i is ``data[bounds[i]:bounds[i + 1]]``; null is empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if large else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def runs_of(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring values of about ``limit`` bytes; a longer value is alone."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


# --- hashes ----------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_POWERS.get(name, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        step = 1
        while step < size:
            out[step : 2 * step] = out[:step] * np.uint64(pow(base, step, 2**64))
            step *= 2
        _POWERS[name] = out
    return _POWERS[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers("up", _BASE, len(values)), out=sums[1:])
    return sums


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring 64-bit values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = _prefix(values)
    return mix((sums[k:] - sums[:n]) * _powers("down", _BACK, n))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums, low = _prefix(byte_values(data)), _powers("down", _BACK, len(data) + 1)
    return mix((sums[ends] - sums[starts]) * low[starts] + (ends - starts).astype(np.uint64))


# --- words -----------------------------------------------------------------------


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each value the index of its first word.

    Words are runs of anything but blank and the controls 9 to 13. No word crosses values.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Hash of every word, over stretches of ``step`` bytes so that long texts need little memory."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + step, "right")))
        stop = ends[last - 1]
        out[first:last] = span_hashes(data[base:stop], starts[first:last] - base, ends[first:last] - base)
        first = last
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z made lower-case, all other bytes kept."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def lower_utf8(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case of Latin, basic Greek and basic Cyrillic letters, and where a letter changed.

    Only letters whose lower case is as long in UTF-8 are touched, so positions stay.
    """
    ascii_ = (data >= 65) & (data <= 90)
    out, changed = np.where(ascii_, data + np.uint8(32), data), ascii_
    lead = np.concatenate((np.zeros(min(1, len(data)), np.uint8), data[:-1]))
    if (data >= 0xC3).any():
        near = ((lead == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)) | ((lead == 0xD0) & (data >= 0x90) & (data <= 0x9F))
        near |= (lead == 0xCE) & (data >= 0x91) & (data <= 0x9F)
        far = ((lead == 0xD0) & (data >= 0xA0) & (data <= 0xAF)) | ((lead == 0xCE) & (data >= 0xA0) & (data <= 0xA9))
        out = np.where(near, data + np.uint8(32), np.where(far, data - np.uint8(32), out))
        at = np.flatnonzero(far)
        out[at - 1] += 1
        changed = changed | near | far
    return out, changed
