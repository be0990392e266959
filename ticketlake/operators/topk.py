"""Best-k search of many queries over a corpus in one scan.

Every task scores its share of the corpus against all queries and keeps its own
best k per query, so what is shuffled is k rows per query and task, not one row
per query and chunk. Several scorers share the scan.

Queries travel to the tasks in blocks of at most ``MAX_QUERIES`` rows and about
``BLOCK_BYTES`` bytes. A query table of several blocks costs one scan for each; the
corpus is never shuffled or copied, whatever the number of queries.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticketlake.session import scratch_dir

# workers get this module with the task, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# rows and bytes of one block of queries
MAX_QUERIES = 2048
BLOCK_BYTES = 32 << 20
# cells of a score matrix held at once, and kept rows per query before a trim
SCORE_CELLS = 1_000_000
TRIM_FACTOR = 16
# word scores are exact sums of parts in this unit, so that ties do not hang on the order of the parts
SCORE_UNIT = 1e-12
# how far a distance from a matrix product may be off, relative to the squared lengths
PRODUCT_SLACK = 1e-9
MERGE_SALTS = 16


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _owners(lists: pa.Array) -> np.ndarray:
    """For each element of the flattened lists, the number of its list."""
    return np.repeat(np.arange(len(lists)), _lengths(lists))


def _with_terms(rows: pa.Table) -> pa.Table:
    """Add the words of the lower-cased text: Arrow splits a column at once, by the same white space."""
    if "lowered" not in rows.column_names:
        return rows
    bare = pc.utf8_trim_whitespace(rows["lowered"])
    # a text without words has no list, where a split would give one empty word
    filled = pc.if_else(pc.equal(bare, ""), pa.scalar(None, pa.string()), bare)
    return rows.append_column("terms", pc.utf8_split_whitespace(filled))


@dataclass(frozen=True)
class QueryTerms:
    """The queries that hold each term of the vocabulary: entries ``ends[t]`` to ``ends[t + 1]``."""

    vocabulary: pa.Array
    ends: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    n_queries: int


@dataclass(frozen=True)
class TermScorer:
    """Scores chunks by the query terms they hold.

    Corpus: ``lowered``, the lower-cased text. Queries: ``terms array<string>``,
    ``weights array<double>``. ``binary`` counts each shared term once plus
    ``bias``; otherwise the term frequency saturates as in Okapi BM25.
    """

    name: str
    k1: float = 1.5
    b: float = 0.75
    avg_len: float = 1.0
    binary: bool = False
    bias: float = 0.0

    columns = ("lowered",)

    def prepare(self, queries: pa.Table) -> QueryTerms:
        terms = queries["terms"].combine_chunks()
        flat = terms.flatten().dictionary_encode()
        term = flat.indices.to_numpy(zero_copy_only=False)
        weight = queries["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        by_term = np.argsort(term, kind="stable")
        return QueryTerms(
            vocabulary=flat.dictionary,
            ends=np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(flat.dictionary)))]).astype(np.int64),
            query=_owners(terms)[by_term],
            weight=weight[by_term],
            n_queries=len(terms),
        )

    def scores(self, rows: pa.Table, asked: QueryTerms) -> np.ndarray:
        n, q, v = rows.num_rows, asked.n_queries, max(1, len(asked.vocabulary))
        terms = rows["terms"].combine_chunks()
        ids = pc.index_in(terms.flatten(), value_set=asked.vocabulary)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        cells = _owners(terms)[known] * v + ids.drop_null().to_numpy(zero_copy_only=False)
        # one entry per chunk and known term, in chunk order
        cells, times = np.unique(cells, return_counts=True)
        row, term = cells // v, cells % v
        if self.binary:
            strength = np.ones(len(row))
        else:
            length = _lengths(terms).astype(np.float64)
            norm = self.k1 * (1 - self.b + self.b * length / self.avg_len)
            strength = times * (self.k1 + 1) / (times + norm[row])
        total = np.zeros(n * q)
        # each entry meets the queries that hold its term; a bounded number at a time
        width = asked.ends[term + 1] - asked.ends[term]
        reach = np.cumsum(width)
        start = 0
        while start < len(row):
            before = reach[start] - width[start]
            stop = max(start + 1, int(np.searchsorted(reach, before + SCORE_CELLS, side="right")))
            part = slice(start, stop)
            entry = np.repeat(np.arange(start, stop), width[part])
            nth = np.arange(len(entry)) + before - (reach - width)[entry]
            held = asked.ends[term[entry]] + nth
            units = np.rint(asked.weight[held] * strength[entry] / SCORE_UNIT)
            total += np.bincount(row[entry] * q + asked.query[held], units, minlength=n * q)
            start = stop
        return (total / (1 / SCORE_UNIT) + self.bias).reshape(n, q)


@dataclass(frozen=True)
class VectorScorer:
    """Scores chunks by nearness: minus the squared Euclidean distance.

    Queries: ``vector array<float>`` of one length. Corpus: the same, or, with
    a ``model`` from word lists to vectors, ``lowered``, embedded as it passes.
    """

    name: str
    model: Callable[[pa.Array], pa.Array] | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return ("lowered",) if self.model else ("vector",)

    @staticmethod
    def _matrix(lists: pa.Array) -> np.ndarray:
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)

    def prepare(self, queries: pa.Table) -> np.ndarray:
        return self._matrix(queries["vector"].combine_chunks())

    def corpus(self, rows: pa.Table) -> np.ndarray:
        lists = self.model(rows["terms"].combine_chunks()) if self.model else rows["vector"].combine_chunks()
        return self._matrix(lists)


def minus_distances(vectors: np.ndarray, queries: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Minus the squared distances of pairs, added up place by place: equal vectors are equally near wherever they stand."""
    total = np.zeros(len(row))
    for place in range(vectors.shape[1]):
        total += (vectors[row, place] - queries[column, place]) ** 2
    return -total


def nearest_cells(vectors: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and score of the k nearest rows of each query; ties go to the lower row. Raises ``floor``."""
    xx, qq = (vectors**2).sum(axis=1), (queries**2).sum(axis=1)
    about = 2 * (vectors @ queries.T) - xx[:, None] - qq[None, :]
    slack = PRODUCT_SLACK * (xx.max(initial=0) + qq.max(initial=0))
    bound = floor - slack
    if len(about) > k:
        bound = np.maximum(bound, np.partition(about, len(about) - k, axis=0)[len(about) - k] - 2 * slack)
    row, column = np.nonzero(about >= bound)
    exact = np.full(about.shape, -np.inf)
    exact[row, column] = minus_distances(vectors, queries, row, column)
    row, column = _best_cells(exact, k, floor)
    return row, column, exact[row, column]


ORDER = ("doc_order", "chunk_offset")


def _best_cells(scores: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best cells per column; ties go to the lower row.

    ``floor`` holds, per column, a score that k cells are known to reach; lower
    cells are left out, and the floor rises with what this block holds.
    """
    n = scores.shape[0]
    # what is not a number has no place and takes none
    scores = np.where(np.isnan(scores), -np.inf, scores)
    keep = (scores >= floor) & (scores > -np.inf)
    if n > k:
        bound = np.partition(scores, n - k, axis=0)[n - k]
        above = scores > bound
        level = scores == bound
        room = k - above.sum(axis=0)
        keep &= above | (level & (np.cumsum(level, axis=0) <= room))
        np.maximum(floor, bound, out=floor)
    return np.nonzero(keep)


def _score_batch(
    rows: pa.Table, scorer, query_ids: np.ndarray, state, floor: np.ndarray, k: int, carry: list[str]
) -> Iterator[pa.Table]:
    """The batch's own best k per query. ``rows`` is in document order."""
    height = max(1, SCORE_CELLS // len(query_ids))
    for start in range(0, rows.num_rows, height):
        part = rows.slice(start, height)
        if isinstance(scorer, VectorScorer):
            row, column, best = nearest_cells(scorer.corpus(part), state, k, floor)
        else:
            scores = scorer.scores(part, state) + 0.0
            row, column = _best_cells(scores, k, floor)
            best = scores[row, column]
        kept = part.select([*ORDER, *carry]).take(pa.array(row))
        yield pa.table(
            {
                "method": pa.array([scorer.name] * len(row), pa.string()),
                "query_id": pa.array(query_ids[column], pa.int64()),
                "score": pa.array(best, pa.float64()),
                **{name: kept[name] for name in kept.column_names},
            }
        )


def _trim(found: list[pa.Table], k: int) -> pa.Table:
    """The best k rows per method and query, by score and then document order."""
    table = pa.concat_tables(found).combine_chunks()
    keys = [("method", "ascending"), ("query_id", "ascending"), ("score", "descending")]
    table = table.sort_by(keys + [(name, "ascending") for name in ORDER])
    if table.num_rows == 0:
        return table
    method = table["method"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    query = table["query_id"].to_numpy()
    starts = np.ones(len(query), dtype=bool)
    starts[1:] = (method[1:] != method[:-1]) | (query[1:] != query[:-1])
    first = np.maximum.accumulate(np.where(starts, np.arange(len(query)), 0))
    return table.filter(pa.array(np.arange(len(query)) - first < k))


def _search(
    batches: Iterable[pa.Table], scorers, queries: dict[str, pa.Table], k: int, carry: list[str]
) -> pa.Table | None:
    """The best k per scorer and query over all batches of one task."""
    plans = []
    for scorer in scorers:
        table = queries[scorer.name]
        if table.num_rows:
            ids = table["query_id"].to_numpy()
            plans.append((scorer, ids, scorer.prepare(table), np.full(len(ids), -np.inf)))
    limit = TRIM_FACTOR * k * sum(len(ids) for _, ids, _, _ in plans)
    found: list[pa.Table] = []
    for rows in batches:
        if rows.num_rows == 0:
            continue
        ordered = rows.sort_by([(name, "ascending") for name in ORDER])
        ordered = _with_terms(ordered).combine_chunks()
        for scorer, ids, state, floor in plans:
            found.extend(_score_batch(ordered, scorer, ids, state, floor, k, carry))
        if sum(t.num_rows for t in found) > limit:
            found = [_trim(found, k)]
    return _trim(found, k) if found else None


def _result_schema(corpus: DataFrame, carry: list[str]) -> T.StructType:
    kept = [corpus.schema[name] for name in (*ORDER, *carry)]
    return T.StructType(
        [
            T.StructField("method", T.StringType()),
            T.StructField("query_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            *[T.StructField(f.name, f.dataType) for f in kept],
        ]
    )


def _keep_best(found: DataFrame, k: int) -> DataFrame:
    """Merge the tasks' lists. A salted first round spreads a query with very many lists."""
    by_score = [F.desc("score"), *ORDER]
    salt = F.pmod(F.xxhash64(*ORDER), F.lit(MERGE_SALTS))
    first = Window.partitionBy("method", "query_id", "_salt").orderBy(*by_score)
    last = Window.partitionBy("method", "query_id").orderBy(*by_score)
    spread = found.withColumn("_salt", salt).withColumn("rank", F.row_number().over(first))
    best = spread.where(F.col("rank") <= k).drop("_salt", "rank")
    return best.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def search(
    corpus: DataFrame,
    queries: dict[str, DataFrame],
    scorers: list,
    k: int,
    carry: list[str],
    max_queries: int = MAX_QUERIES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The best ``k`` chunks per scorer and query: ``method, query_id, score, rank`` and ``carry``.

    ``corpus`` needs ``doc_order``, ``chunk_offset``, the scorers' columns and
    ``carry``; ``queries`` maps a scorer's name to its query table.
    """
    needed = dict.fromkeys([*ORDER, *[c for s in scorers for c in s.columns], *carry])
    corpus = corpus.select(*needed)
    schema = _result_schema(corpus, carry)
    # the scorers' blocks go together, so that they share a scan
    blocks = zip_longest(*[_query_blocks(queries[s.name], max_queries, block_bytes) for s in scorers])

    def scan(block: tuple[pa.Table | None, ...]) -> DataFrame:
        asked = [(scorer, table) for scorer, table in zip(scorers, block) if table is not None]
        small = {scorer.name: table for scorer, table in asked}

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _search((pa.Table.from_batches([b]) for b in batches), [s for s, _ in asked], small, k, carry)
            if best is not None:
                yield from best.to_batches()

        return _keep_best(corpus.mapInArrow(task, schema), k)

    block = next(blocks, None)
    if block is None:
        return corpus.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))
    following = next(blocks, None)
    if following is None:
        return scan(block)
    # more than one block: each one's lists are written, so that the driver holds two blocks at most
    found = _written(scan(block), "found")
    while following is not None:
        found = found.unionByName(_written(scan(following), "found"))
        following = next(blocks, None)
    return found


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _weight(value) -> int:
    """Bytes that a query's cell takes, about."""
    if isinstance(value, (list, tuple)):
        return sum(map(_weight, value))
    return len(value) * 4 if isinstance(value, str) else 8


def _query_blocks(queries: DataFrame, max_queries: int, block_bytes: int) -> Iterator[pa.Table]:
    """The queries in blocks of bounded rows and bytes, read one by one."""
    schema = to_arrow_schema(queries.schema)
    # written once: reading partition by partition must not repeat the work behind them
    held, size = [], 0
    for row in _written(queries, "queries").toLocalIterator():
        held.append(row.asDict())
        size += _weight(row)
        if len(held) >= max_queries or size >= block_bytes:
            yield pa.Table.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.Table.from_pylist(held, schema)
