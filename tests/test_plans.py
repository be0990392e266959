"""Physical plans: what must and must not be in them at scale."""

import pytest

from ticketlake.operators import layers, quality, retrieval
from ticketlake.operators.bm25 import term_frequencies
from ticketlake.operators.merge import merge_upsert
from ticketlake.plans import queries as Q
from ticketlake.sources import testdata


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_reads_only_its_columns(spark, sf):
    text = plan(Q.gold_category(spark, sf))
    assert "documents" not in text and "o_totalprice" not in text
    assert "PythonUDF" not in text and "ArrowEval" not in text


def test_dedup_cuts_hot_keys_before_the_shuffle(spark, sf):
    text = plan(Q.silver(spark, sf))
    assert "row_number(), 1, Partial" in text


def test_quality_is_one_scan(spark, sf):
    rows = testdata.table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) Ticket_ID", "c_name Customer_Name", "c_acctbal Satisfaction_Score"
    )
    assert plan(quality.report(rows)).count("FileScan") == 1


def test_term_counts_fold_before_the_shuffle(spark, sf):
    text = plan(term_frequencies(Q.document_chunks(spark, sf)))
    assert "partial_count" in text and "Python" not in text


@pytest.mark.parametrize(
    "build",
    [
        lambda spark, sf: retrieval.bm25_topk(Q.document_chunks(spark, sf), testdata.benchmark_queries(spark, sf)),
        lambda spark, sf: layers.gold_sla(Q.silver(spark, sf)),
        lambda spark, sf: merge_upsert(Q.unvalidated(spark, sf), Q.unvalidated(spark, sf), "Ticket_ID", "seq"),
        lambda spark, sf: Q.answer_fallback(spark, sf),
        lambda spark, sf: Q.rerank_overlap(spark, sf),
        lambda spark, sf: Q.lineage_edges(spark, sf),
    ],
)
def test_no_cross_joins(spark, sf, build):
    text = plan(build(spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_search_shuffles_best_rows_only(spark, sf):
    found = retrieval.bm25_topk(Q.document_chunks(spark, sf), testdata.benchmark_queries(spark, sf))
    text = plan(found)
    assert "MapInArrow" in text
    # the only exchange below the scan is the one that spreads a single test file
    below = text[text.index("MapInArrow") :]
    assert below.count("Exchange") <= 1 and "hashpartitioning" not in below
