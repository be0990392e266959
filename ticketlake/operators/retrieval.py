"""Hybrid retrieval for batches of queries: search, fusion, rerank, citations, answers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake.functions.models import pair_scorer, text_embedder
from ticketlake.functions.text import plain_number, shared_words, tokens, words
from ticketlake.functions.vectors import embedding, hashing_model
from ticketlake.operators import topk
from ticketlake.operators.bm25 import Bm25Index, build_index
from ticketlake.operators.index import RetrievalIndex
from ticketlake.session import scratch_dir

# --- fixed values: retrieval settings and the answer template ----------------
TOP_K, RRF_K = 5, 60
FUSED_K = 2 * TOP_K
NO_RANK = 999
LEXICAL_BIAS, OVERLAP_WEIGHT = 0.1, 0.1
DEFAULT_RELEVANCE, RELEVANCE_DIGITS = 0.5, 4
CONTEXT_CHARS = 250
ANSWER = (
    "Based on historical resolution data for query '%s':\n\n"
    "Relevant support cases were identified under Category '%s' "
    "handled by Agent %s. Key context: \"%s...\"\n\n"
    "Source Citations:\n%s"
)
CITATION = "  - %s Ticket ID: %s | Category: %s | Agent: %s (Relevance Score: %s)"

# what an answer tells of each of its documents
DOCUMENT = ["id", "text", "rrf_score", "dense_rank", "bm25_rank", "cross_encoder_score"]
CARRY = ["id", "ticket_id", "customer_name", "issue_category", "assigned_agent", "text"]


def with_terms(chunks: DataFrame) -> DataFrame:
    """Chunks with their words in order and the number of words."""
    return chunks.withColumn("terms", tokens(F.col("text"))).withColumn("n_terms", F.size("terms"))


def searchable(chunks: DataFrame) -> DataFrame:
    """Chunks with their lower-cased text and every column of ``CARRY``."""
    have = set(chunks.columns)
    missing = {c: F.lit(None).cast("string") for c in CARRY if c not in have}
    return chunks.withColumns(missing | {"lowered": F.lower("text")})


def vector_index(chunks: DataFrame, model: Callable | None = None) -> DataFrame:
    """Chunks with their embedding and the metadata kept for look-ups."""
    listed = chunks.withColumn("_terms", tokens(F.col("text")))
    return listed.withColumn("vector", embedding(F.col("_terms"), model)).drop("_terms")


def embedded(rows: DataFrame, text: str, make_model: Callable) -> DataFrame:
    """Rows with ``vector`` from a model of texts that is loaded once for each Python worker.

    Where chunks have a ``vector`` it is used as it is, and so are the vectors of queries given to a dense search.
    """
    return rows.withColumn("vector", text_embedder(make_model)(text))


def query_vectors(queries: DataFrame, model: Callable | None = None) -> DataFrame:
    return queries.select("query_id", embedding(tokens(F.col("query")), model).alias("vector"))


def _query_words(queries: DataFrame) -> DataFrame:
    said = queries.select("query_id", words(F.col("query")).alias("terms"))
    return said.withColumn("weights", F.transform("terms", lambda _: F.lit(1.0)))


def bm25_topk(
    chunks: DataFrame, queries: DataFrame, k: int = FUSED_K, index: Bm25Index | None = None, **limits
) -> DataFrame:
    """The k best chunks by BM25; ties and zero scores fill up in document order."""
    index = index or build_index(chunks)
    return topk.search(
        searchable(chunks), {"bm25": index.query_weights(queries)}, [index.scorer()], k, CARRY, **limits
    )


def lexical_topk(chunks: DataFrame, queries: DataFrame, k: int = FUSED_K, **limits) -> DataFrame:
    """The k best chunks by distinct shared words, plus a fixed bias."""
    scorer = topk.TermScorer("lexical", binary=True, bias=LEXICAL_BIAS)
    return topk.search(
        searchable(chunks), {"lexical": _query_words(queries)}, [scorer], k, CARRY, **limits
    )


def _measurable(vector: str) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~odd


def dense_topk(vectors: DataFrame, queries: DataFrame, k: int = FUSED_K, carry: list[str] | None = None, **limits) -> DataFrame:
    """The k nearest vectors by squared Euclidean distance, returned as ``distance``.

    Vectors and queries that are null or hold null, NaN or infinite places take no part.
    """
    carry = CARRY if carry is None else carry
    vectors, queries = (df.where(_measurable("vector")) for df in (vectors, queries))
    found = topk.search(vectors, {"dense": queries}, [topk.VectorScorer("dense")], k, carry, **limits)
    return found.withColumn("distance", -F.col("score")).drop("score")


def hybrid_ranks(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = FUSED_K,
    model: Callable | None = None,
    index: Bm25Index | None = None,
    **limits,
) -> DataFrame:
    """Dense and BM25 rank lists from one scan of the corpus, told apart by ``method``.

    A ``vector`` column of ``chunks`` is used as it is; without one the chunks
    are embedded within the scan.
    """
    index = index or build_index(chunks)
    embed = None if "vector" in chunks.columns else model or hashing_model()
    return topk.search(
        searchable(chunks),
        {"dense": query_vectors(queries, model), "bm25": index.query_weights(queries)},
        [topk.VectorScorer("dense", embed), index.scorer()],
        k,
        CARRY,
        **limits,
    )


def _best(df: DataFrame, score: str, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc(score), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fuse(ranks: DataFrame, k: int = FUSED_K, rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of the lists in ``ranks`` (``method, query_id, id, rank``).

    Lists are at most k long per query, so one grouping pairs them up. Ties go
    to the smaller chunk id.
    """

    def rank_in(method: str) -> Column:
        return F.max(F.when(F.col("method") == method, F.col("rank")))

    kept = [c for c in CARRY if c != "id"]
    paired = ranks.groupBy("query_id", "id").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in kept],
        rank_in("dense").alias("dense_rank"),
        rank_in("bm25").alias("bm25_rank"),
    )

    def share(rank: str) -> Column:
        return F.coalesce(1.0 / (rrf_k + F.col(rank)), F.lit(0.0))

    scored = paired.withColumn("rrf_score", share("dense_rank") + share("bm25_rank"))
    shown = {r: F.coalesce(r, F.lit(NO_RANK)) for r in ("dense_rank", "bm25_rank")}
    return _best(scored.withColumns(shown), "rrf_score", k)


def lexical_candidates(chunks: DataFrame, queries: DataFrame, k: int = FUSED_K, **limits) -> DataFrame:
    """The fallback without vectors and BM25: the lexical list as fused candidates."""
    return lexical_topk(chunks, queries, k, **limits).withColumnRenamed("score", "rrf_score")


def rerank_overlap(candidates: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """Fused score plus a tenth per distinct word shared with the query."""
    shared = shared_words(F.col("query"), F.col("text"))
    scored = candidates.drop("rank").join(queries, "query_id")
    scored = scored.withColumn("cross_encoder_score", F.col("rrf_score") + shared * OVERLAP_WEIGHT)
    return _best(scored, "cross_encoder_score", k)


def word_coverage(query: Column, text: Column) -> Column:
    """The built-in pair score: the share of the query's distinct words found in the text."""
    asked = F.size(words(query))
    return F.when(asked == 0, 0.0).otherwise(shared_words(query, text) / asked)


def rerank_model(
    candidates: DataFrame,
    queries: DataFrame,
    model: Callable[[pd.Series, pd.Series], pd.Series] | None = None,
    k: int = TOP_K,
    make_model: Callable | None = None,
) -> DataFrame:
    """Rerank with a pair model that maps query texts and chunk texts to scores.

    Without one the share of shared words is the score, as a column expression. A model sees the few
    fused candidates of each query only, in Arrow batches. ``make_model`` loads one that is costly, once for
    each Python worker, and returns a function of two arrays.
    """

    @F.pandas_udf("double")
    def predict(query: pd.Series, text: pd.Series) -> pd.Series:
        return model(query, text)

    scored = candidates.drop("rank").join(queries, "query_id")
    if make_model is not None:
        score = pair_scorer(make_model)("query", "text")
    else:
        score = word_coverage(F.col("query"), F.col("text")) if model is None else predict("query", "text")
    scored = scored.withColumn("cross_encoder_score", score)
    return _best(scored, "cross_encoder_score", k)


def first_chunks(chunks: DataFrame, k: int = TOP_K) -> DataFrame:
    """The first k chunks in document order, numbered."""
    head = chunks.orderBy(*topk.ORDER).limit(k)
    order = Window.orderBy(*topk.ORDER)
    return head.withColumn("rank", F.row_number().over(order))


def fill_unanswered(reranked: DataFrame, queries: DataFrame, chunks: DataFrame, k: int = TOP_K) -> DataFrame:
    """Queries without a candidate get the first k chunks, without a score."""
    unanswered = queries.join(reranked.select("query_id"), "query_id", "left_anti")
    if unanswered.isEmpty():
        return reranked
    slots = unanswered.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    filled = slots.join(first_chunks(searchable(chunks), k), "rank").select(
        "query_id", "query", "rank", *CARRY, F.lit(None).cast("double").alias("cross_encoder_score")
    )
    return reranked.unionByName(filled, allowMissingColumns=True)


def citations(top: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per cited chunk, numbered ``[1]``, ``[2]``, ... per query."""
    relevance = F.coalesce(
        F.col("cross_encoder_score"),
        F.col("rrf_score") if "rrf_score" in top.columns else F.lit(None).cast("double"),
        F.lit(DEFAULT_RELEVANCE),
    )
    return top.select(
        "query_id",
        F.col("rank"),
        F.concat(F.lit("["), F.col("rank"), F.lit("]")).alias("citation_id"),
        "ticket_id",
        "customer_name",
        "issue_category",
        "assigned_agent",
        F.round(relevance, RELEVANCE_DIGITS).alias("relevance_score"),
        *keep,
    )


def answers(top: DataFrame) -> DataFrame:
    """One row per query: the answer text, its documents with scores and ranks, and their citations.

    ``top`` holds at most k ranked rows per query, so the arrays are short.
    """
    kinds = {"rrf_score": "double", "dense_rank": "int", "bm25_rank": "int", "cross_encoder_score": "double"}
    top = top.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in top.columns})
    cited = citations(top, keep=("query", *DOCUMENT))
    fields = ["citation_id", "ticket_id", "customer_name", "issue_category", "assigned_agent", "relevance_score"]
    grouped = cited.groupBy("query_id").agg(
        F.first("query").alias("query"),
        F.sort_array(F.collect_list(F.struct("rank", *fields, *DOCUMENT))).alias("top"),
    )
    best = F.element_at("top", 1)
    lines = F.transform(
        "top",
        lambda c: F.format_string(
            CITATION,
            c["citation_id"],
            c["ticket_id"],
            c["issue_category"],
            c["assigned_agent"],
            plain_number(c["relevance_score"], RELEVANCE_DIGITS),
        ),
    )
    answer = F.format_string(
        ANSWER,
        F.col("query"),
        best["issue_category"],
        best["assigned_agent"],
        F.left(best["text"], F.lit(CONTEXT_CHARS)),
        F.array_join(lines, "\n"),
    )
    without_text = F.transform("top", lambda c: F.struct(*[c[f].alias(f) for f in fields]))
    documents = F.transform("top", lambda c: F.struct(*[c[f].alias(f) for f in DOCUMENT]))
    return grouped.select("query_id", "query", answer.alias("answer"), documents.alias("top_documents"), without_text.alias("citations"))


def top_documents(
    chunks: DataFrame | RetrievalIndex,
    queries: DataFrame,
    lists: str = "hybrid",
    pair_model: Callable | None = None,
    make_pair_model: Callable | None = None,
    **options,
) -> DataFrame:
    """Search, fuse, rerank and fill: the ranked chunks behind each answer, from chunks or a stored index.

    The reranked rows, at most k per query, are written to the scratch folder:
    they are read more than once and the corpus scan must not be repeated.
    """
    if lists == "hybrid" and isinstance(chunks, RetrievalIndex):
        candidates = fuse(chunks.hybrid_ranks(queries, FUSED_K))
    elif lists == "hybrid":
        candidates = fuse(hybrid_ranks(chunks, queries, **options))
    elif lists == "lexical":
        candidates = lexical_candidates(chunks, queries, **options)
    else:
        raise ValueError(f"unknown lists: {lists}")
    if pair_model or make_pair_model:
        reranked = rerank_model(candidates, queries, pair_model, make_model=make_pair_model)
    else:
        reranked = rerank_overlap(candidates, queries)
    spark = queries.sparkSession
    path = scratch_dir(spark, "reranked")
    reranked.write.parquet(path)
    return fill_unanswered(spark.read.parquet(path), queries, chunks.chunks() if isinstance(chunks, RetrievalIndex) else chunks)


def answer_queries(chunks: DataFrame | RetrievalIndex, queries: DataFrame, **options) -> DataFrame:
    """End to end: one answer with citations per query."""
    return answers(top_documents(chunks, queries, **options))


