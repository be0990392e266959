"""Exact top-k search by tiled matrix products.

Queries are cut into blocks of bounded bytes, each scanned by a job of its own whose lists
are written, so that the driver never holds more than two of them. For a block every task multiplies its
shard of the vectors, tile by tile, with the block's matrix, keeps the k best
candidates per query and tile (partial selection), and folds tiles into one list.
The lists of all tasks are merged in a tree: first into a bounded number of lists
per query, then into one. What is shuffled is k rows per query and task.

Scores are inner products of whole numbers, exact in float64 as long as they stay
below 2**53; larger ones are multiplied as 64-bit integers, and the few rows that could
leave those as Python's integers. A score beyond 64 bits is the largest or smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ticketlake.llm.common import written

#: Bytes of one query block, which travels to every task.
BLOCK_BYTES = 16 << 20
TILE_ROWS = 4096
FANIN = 64

_SCHEMA = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _quantised(vectors: np.ndarray, scale: float) -> np.ndarray:
    # a component that becomes infinite is the largest number instead
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(vectors * scale))


def _matrices(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and quantised rows, one pair for each length of vector."""
    ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(vectors.offsets.to_numpy().astype(np.int64))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = flat[starts[at][:, None] + np.arange(size)]
        yield ids[at].astype(np.int64), _quantised(rows, scale)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        reach = queries.shape[1] * (np.abs(queries).max(initial=0) * np.abs(rows).max(axis=1, initial=0))
        if reach.max(initial=0) < 2.0**53:
            return (queries @ rows.T).astype(np.int64)
        far = reach >= 2.0**62
        out = np.empty((len(queries), len(rows)), np.int64)
        out[:, ~far] = queries.astype(np.int64) @ rows[~far].astype(np.int64).T
    if far.any():
        whole = np.frompyfunc(int, 1, 1)
        out[:, far] = np.clip(whole(queries) @ whole(rows[far]).T, _NONE + 1, -(_NONE + 1)).astype(np.int64)
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best by score, ties to the smaller id; columns come ordered by id."""
    if scores.shape[1] > k:
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        # of the rows at the floor the first ones stay: columns are in order of their ids
        spare = k - (scores > floor).sum(axis=1, keepdims=True)
        keep = (scores > floor) | ((scores == floor) & (np.cumsum(scores == floor, axis=1) <= spare))
        columns = np.nonzero(keep)[1].reshape(len(scores), k)
        scores, ids = np.take_along_axis(scores, columns, 1), np.take_along_axis(ids, columns, 1)
    order = np.lexsort((ids, -scores), axis=1)
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


_NONE = np.iinfo(np.int64).min


def _scan(blocks: dict[int, tuple[np.ndarray, np.ndarray]], k: int, scale: float):
    """The task: all its vectors against one query block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for ids, rows in _matrices(batch, scale):
                if rows.shape[1] not in blocks:
                    continue
                names, queries = blocks[rows.shape[1]]
                order = np.argsort(ids, kind="stable")
                ids, rows = ids[order], rows[order]
                for at in range(0, len(ids), TILE_ROWS):
                    tile = ids[at : at + TILE_ROWS]
                    scores = _products(queries, rows[at : at + TILE_ROWS])
                    scores[names[:, None] == tile[None, :]] = _NONE
                    got = _best(scores, np.broadcast_to(tile, scores.shape), k)
                    if (before := lists.get(rows.shape[1])) is not None:
                        both = [np.concatenate(x, axis=1) for x in zip(before, got)]
                        order = np.argsort(both[1], axis=1, kind="stable")
                        got = _best(*[np.take_along_axis(x, order, 1) for x in both], k)
                    lists[rows.shape[1]] = got
        for size, (scores, found) in lists.items():
            names = np.repeat(blocks[size][0], scores.shape[1])
            real = scores.ravel() != _NONE
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[real]) for x in (names, found.ravel(), scores.ravel())], ["query_id", "vec_id", "score"]
            )

    return run


def _query_blocks(queries: DataFrame, scale: float) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Blocks of queries by length of vector, each bounded in bytes; at most one is on the driver besides the one being filled."""
    ids: dict[int, list[int]] = {}
    rows: dict[int, list[np.ndarray]] = {}
    held = 0

    def block():
        return {size: (np.array(ids[size], np.int64), np.stack(rows[size])) for size in rows}

    for row in queries.toLocalIterator():
        vector = _quantised(np.asarray(row[1], np.float64), scale)
        ids.setdefault(len(vector), []).append(row[0])
        rows.setdefault(len(vector), []).append(vector)
        held += vector.nbytes + 64
        if held >= BLOCK_BYTES:
            yield block()
            ids, rows, held = {}, {}, 0
    if rows:
        yield block()


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k best vectors but itself.

    Components become floor(scale * x); a score beyond 64 bits is the nearest number of
    them, so that such ones tie. Vectors that are null or hold null, NaN or
    infinite components, and rows without an id, take no part; neither do vectors of
    another length than the query's. Ties go to the smaller id. Rows with a repeated
    id are candidates of their own and all are skipped for the query with that id.
    With fewer than k candidates all are returned; without queries or vectors the
    result is empty. Further columns are ignored.
    """
    spark: SparkSession = vectors.sparkSession

    def pick(df: DataFrame) -> DataFrame:
        both = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
        return both.where(F.col("vec_id").isNotNull() & usable(F.col("v")))

    wanted = pick(queries).dropDuplicates(["vec_id"])
    lists = None
    for block in _query_blocks(wanted, scale):
        part = written(pick(vectors).mapInArrow(_scan(block, k, scale), _SCHEMA), "lists")
        lists = part if lists is None else lists.unionByName(part)
    if lists is None:
        lists = spark.createDataFrame([], _SCHEMA)
    best = [F.col("score").desc(), F.col("vec_id")]
    # the tree: FANIN lists per query first, then one
    twig = Window.partitionBy("query_id", "twig").orderBy(*best)
    lists = lists.withColumn("twig", F.pmod(F.spark_partition_id(), F.lit(FANIN)))
    lists = lists.withColumn("rank", F.row_number().over(twig)).where(F.col("rank") <= k)
    root = Window.partitionBy("query_id").orderBy(*best)
    lists = lists.withColumn("rank", F.row_number().over(root)).where(F.col("rank") <= k)
    return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle(k: int = 5, every: int = 50) -> str:
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % {every} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""
