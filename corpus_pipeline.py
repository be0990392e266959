"""The corpus pipeline: language, near copies, benchmark leaks, personal data, source mix.

Every stage takes (spark, docs, sf_dir) and gives the documents it keeps; ``run`` writes
each stage's rows as Parquet and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketlake.llm import decontamination, language_id, mixing, ngram_join, pii
from ticketlake.llm.common import DOC_COLUMNS, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that look like text of a language learned from the labelled ones."""
    model = language_id.train(docs)
    return language_id.identify(docs, model).where("accepted").select(*DOC_COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles."""
    return ngram_join.keep_first(docs, shingle=5, percent=80).select(*DOC_COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor one with other numbers, names or units."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*DOC_COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and their new lengths."""
    found = pii.find_pii(docs, pii.train(docs), mask=True)
    return found.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents, with the same weight for every source, shuffled."""
    return mixing.mix_sources(docs).select(*DOC_COLUMNS, "copy")


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_leaks),
    ("personal_data", mask_personal_data),
    ("mix", mix),
]

#: Language models, random fields and component searches are not SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
