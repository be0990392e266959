"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticketlake.llm import decontamination, exact_search, language_id, license_scan, mixing, ngram_join, periodic_runs, pii, pivot_join, prefix_trie, rlz_dedup, suffix_dedup, toxicity
from ticketlake.llm.common import fold, table


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf, "documents"))
    return found.select("doc_id", "n_sentences", "sentence_ids", "licenses", "n_unmatched")


def op2_rlz_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return rlz_dedup.remove_repeats(table(spark, sf, "documents"), window=35)


def op3_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return exact_search.exact_topk(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


def op4_poisson_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents")).drop("shuffle_key")


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels.where(fold(F.col("doc_id"), 4) != 2))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    held_out = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.find_pii(docs, pii.train(docs)).drop("text")


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language_id.train(docs.where(fold(F.col("doc_id"), 5) != 0))
    held_out = fold(F.col("doc_id"), 5) == 0
    rows = language_id.identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"), length=200)


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.components(table(spark, sf, "documents"), shingle=4, percent=85).drop("n_links")


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf, "documents"))
    return periodic_runs.digests(periodic_runs.collapse_runs(docs, shortest=24, times=3))


def op12_pivot_join(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_join.near_duplicates(table(spark, sf, "embeddings"), cosine=0.9)


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    talks = prefix_trie.rebuilt(prefix_trie.sequences(table(spark, sf, "conversations")))
    return prefix_trie.digests(*prefix_trie.trie(talks))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_rlz_dedup, op3_exact_topk, op4_poisson_mix, op5_toxicity,
        op6_pii, op7_language_id, op8_suffix_dedup, op9_decontamination, op10_ngram_join,
        op11_periodic_runs, op12_pivot_join, op13_prefix_trie,
    )
}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.oracle(),
        "op2_rlz_dedup": rlz_dedup.oracle(),
        "op3_exact_topk": exact_search.oracle(),
        "op4_poisson_mix": mixing.oracle(),
        "op10_ngram_join": ngram_join.oracle(),
        "op11_periodic_runs": periodic_runs.oracle(),
        "op12_pivot_join": pivot_join.oracle(),
        "op13_prefix_trie": prefix_trie.oracle(),
    }
