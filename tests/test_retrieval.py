"""Chunks, scores against brute force, fusion, rerank and answers."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketlake.functions.text import plain_number, tokens
from ticketlake.functions.vectors import hashing_model
from ticketlake.operators import chunking, retrieval, topk
from ticketlake.operators.bm25 import build_index


def chunks_of(spark, texts):
    rows = [(i, 0, f"c{i:03d}", f"T{i}", "n", "cat", "agent", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows,
        "doc_order bigint, chunk_offset int, id string, ticket_id string, customer_name string, "
        "issue_category string, assigned_agent string, text string",
    )


def queries_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "query_id bigint, query string")


@pytest.fixture(scope="module")
def corpus():
    """Skewed on purpose: one word in every text, copies, and an empty text."""
    pick = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    texts = ["the " + " ".join(pick.choices(words, weights=range(1, 41), k=pick.randint(1, 30))) for _ in range(150)]
    return texts + [texts[3]] * 60 + ["", "the the the W1 w1"]


QUESTIONS = ["the w1 w2 w2", "w39 w38 unknown", "nothing here", "", "THE w5\tw5 w5"]


def bm25_reference(texts, question):
    docs = [t.lower().split() for t in texts]
    n, avg = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    raw = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: floor if v < 0 else v for w, v in raw.items()}
    scores = []
    for d in docs:
        tf = Counter(d)
        scores.append(sum(idf.get(w, 0) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(d) / avg)) for w in question.lower().split()))
    return scores


def best(scores, k):
    order = sorted(range(len(scores)), key=lambda i: (-round(scores[i], 6), i))[:k]
    return [(i, round(scores[i], 6)) for i in order]


def found(df):
    rows = df.orderBy("query_id", "rank").collect()
    result = {}
    for r in rows:
        result.setdefault(r.query_id, []).append((int(r.id[1:]), pytest.approx(r.score, abs=2e-6)))
    return result


PATHS = [{}, {"max_queries": 2}]


@pytest.mark.parametrize("limits", PATHS)
@pytest.mark.parametrize("k", [1, 10, 500])
def test_bm25_against_brute_force(spark, corpus, limits, k):
    got = found(retrieval.bm25_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), k, **limits))
    assert got == {i: best(bm25_reference(corpus, q), k) for i, q in enumerate(QUESTIONS, 1)}


@pytest.mark.parametrize("limits", PATHS)
def test_lexical_against_brute_force(spark, corpus, limits):
    got = found(retrieval.lexical_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), 10, **limits))
    for i, q in enumerate(QUESTIONS, 1):
        shared = [len(set(q.lower().split()) & set(t.lower().split())) + 0.1 for t in corpus]
        assert got[i] == best(shared, 10)


@pytest.mark.parametrize("limits", PATHS)
def test_dense_against_brute_force(spark, limits):
    pick = random.Random(1)
    vectors = [[pick.choice([0.0, 0.5, 1.0]) for _ in range(4)] for _ in range(300)]
    asked = [[pick.random() for _ in range(4)] for _ in range(5)]
    corpus = spark.createDataFrame(
        [(i, 0, v) for i, v in enumerate(vectors)], "doc_order bigint, chunk_offset int, vector array<float>"
    ).repartition(7)
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, vector array<double>")
    rows = retrieval.dense_topk(corpus, queries, 10, carry=[], **limits).orderBy("query_id", "rank").collect()
    for q, a in enumerate(asked):
        far = [sum((x - y) ** 2 for x, y in zip(v, a)) for v in vectors]
        expected = sorted(range(300), key=lambda i: (round(far[i], 6), i))[:10]
        assert [r.doc_order for r in rows if r.query_id == q] == expected
        assert [r.distance for r in rows if r.query_id == q] == pytest.approx([far[i] for i in expected], abs=2e-6)


def test_many_batches_and_trims(spark, corpus, monkeypatch):
    """Tiny Arrow batches and score blocks change nothing."""
    whole = found(retrieval.bm25_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), 3))
    monkeypatch.setattr(topk, "SCORE_CELLS", 20)
    monkeypatch.setattr(topk, "TRIM_FACTOR", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(retrieval.bm25_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), 3)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_queries_fill_a_block(spark, corpus):
    whole = found(retrieval.bm25_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), 3))
    assert found(retrieval.bm25_topk(chunks_of(spark, corpus), queries_of(spark, *QUESTIONS), 3, block_bytes=40)) == whole


def test_blocks_of_two_scorers_share_scans(spark, corpus):
    chunks, queries = chunks_of(spark, corpus), queries_of(spark, *QUESTIONS)
    whole = retrieval.hybrid_ranks(chunks, queries).orderBy("method", "query_id", "rank").collect()
    blocks = retrieval.hybrid_ranks(chunks, queries, max_queries=2).orderBy("method", "query_id", "rank").collect()
    assert blocks == whole


def test_empty_corpus_and_empty_queries(spark):
    chunks, queries = chunks_of(spark, []), queries_of(spark, "a")
    assert retrieval.bm25_topk(chunks, queries).count() == 0
    assert retrieval.bm25_topk(chunks_of(spark, ["a"]), queries.limit(0)).count() == 0
    assert retrieval.answer_queries(chunks, queries).count() == 0


def test_index_numbers(spark):
    index = build_index(chunks_of(spark, ["a b b", "", "a"]))
    assert (index.n_chunks, index.avg_len) == (3, pytest.approx(4 / 3))
    assert {r.term: r.doc_freq for r in index.terms.collect()} == {"a": 2, "b": 1}


@pytest.mark.parametrize("length, n", [(0, 0), (1, 1), (320, 1), (321, 2), (640, 2), (641, 3), (5000, 16)])
def test_chunk_counts(spark, length, n):
    df = spark.createDataFrame([(1, "T", "x" * length)], "doc_order bigint, ticket_id string, full_text string")
    assert chunking.chunk(df).count() == n


@pytest.mark.parametrize("size, overlap", [(400, 80), (10, 3), (10, 9), (10, 10), (7, 0), (5, 4)])
def test_chunks_are_the_slices_of_the_text(spark, size, overlap):
    text = "Zürich \U0001f600\n\r\n" + "".join(random.Random(3).choices("abc é\U0001f680\n", k=101))
    df = spark.createDataFrame([(1, "T", text)], "doc_order bigint, ticket_id string, full_text string")
    step = max(1, size - overlap)
    got = {r.chunk_offset: (r.id, r.text) for r in chunking.chunk(df, size, overlap).collect()}
    assert got == {j: (f"doc_T_chunk_{j}", text[j : j + size]) for j in range(0, len(text), step)}
    assert "".join(got[j][1][:step] for j in sorted(got)) == text


def test_ticket_text_fallbacks(spark):
    df = spark.createDataFrame(
        [(3, None, "", 0.0), (4, "A", "sub", 4.0)],
        "`row` int, `Ticket ID` string, Ticket_Subject string, `Satisfaction score` double",
    )
    rows = chunking.ticket_text(df, order="row", row_number="row").orderBy("doc_order").collect()
    assert rows[0].full_text == (
        "Ticket ID: TKT-3 | Customer: Unknown | Category: General Inquiry | Subject: General Support | "
        "Agent: Unassigned | Satisfaction: 5 | Description: No description provided."
    )
    assert rows[1].full_text.startswith("Ticket ID: A |") and "Satisfaction: 4.0" in rows[1].full_text


def test_tokens_follow_unicode_white_space(spark):
    text = " A b　C\x1cd\x85e f\tg\n\x0bh  "
    df = spark.createDataFrame([(text,), ("",), ("  ",)], "t string")
    assert [r[0] for r in df.select(tokens(F.col("t"))).collect()] == [text.lower().split(), [], []]


def ranks(spark, *rows):
    kept = "ticket_id string, customer_name string, issue_category string, assigned_agent string, text string"
    filled = [(q, m, i, r, i, "n", "c", "a", f"text {i}") for q, m, i, r in rows]
    return spark.createDataFrame(filled, f"query_id bigint, method string, id string, rank int, {kept}")


def test_fusion(spark):
    lists = ranks(spark, (1, "dense", "x", 1), (1, "bm25", "x", 1), (1, "dense", "z", 2), (1, "bm25", "y", 2))
    got = [(r.id, r.dense_rank, r.bm25_rank, r.rrf_score) for r in retrieval.fuse(lists).orderBy("rank").collect()]
    assert got == [
        ("x", 1, 1, pytest.approx(2 / 61)),
        ("y", 999, 2, pytest.approx(1 / 62)),
        ("z", 2, 999, pytest.approx(1 / 62)),
    ]
    assert retrieval.fuse(lists, k=1).count() == 1


def test_rerank_with_a_model(spark):
    lists = ranks(spark, (1, "dense", "x", 1), (1, "bm25", "y", 1))
    top = retrieval.rerank_model(
        retrieval.fuse(lists), queries_of(spark, "q"), lambda query, text: text.str.endswith("y").astype(float)
    )
    assert [r.id for r in top.orderBy("rank").collect()] == ["y", "x"]


def test_sample_answer(spark):
    """The fallback chain: four shared words, 4.1 from the list and 0.4 from the rerank."""
    rows = [
        (f"TKT-{100000 + i}", "George Simon", "General Inquiry", "Hours of operation inquiry", "David Kim", 4.0, "When?")
        for i in range(3)
    ]
    tickets = spark.createDataFrame(
        rows,
        "Ticket_ID string, Customer_Name string, Issue_Category string, Ticket_Subject string, "
        "Assigned_Agent string, Satisfaction_Score double, Ticket_Description string",
    )
    chunks = chunking.chunk(chunking.ticket_text(tickets))
    answer = retrieval.answer_queries(chunks, queries_of(spark, "Hours of operation inquiry"), lists="lexical").first()
    assert answer.answer == (
        "Based on historical resolution data for query 'Hours of operation inquiry':\n\n"
        "Relevant support cases were identified under Category 'General Inquiry' handled by Agent David Kim. "
        'Key context: "Ticket ID: TKT-100000 | Customer: George Simon | Category: General Inquiry | '
        "Subject: Hours of operation inquiry | Agent: David Kim | Satisfaction: 4.0 | Description: When?...\"\n\n"
        "Source Citations:\n"
        "  - [1] Ticket ID: TKT-100000 | Category: General Inquiry | Agent: David Kim (Relevance Score: 4.5)\n"
        "  - [2] Ticket ID: TKT-100001 | Category: General Inquiry | Agent: David Kim (Relevance Score: 4.5)\n"
        "  - [3] Ticket ID: TKT-100002 | Category: General Inquiry | Agent: David Kim (Relevance Score: 4.5)"
    )
    assert [c.relevance_score for c in answer.citations] == [4.5] * 3


def test_unanswered_queries_get_the_first_chunks(spark, corpus):
    chunks, queries = chunks_of(spark, corpus), queries_of(spark, "w1", "zzz")
    hits = retrieval.lexical_candidates(chunks, queries).where("rrf_score > 0.1")
    top = retrieval.fill_unanswered(retrieval.rerank_overlap(hits, queries), queries, chunks)
    filled = retrieval.citations(top, keep=("id",)).where("query_id = 2").orderBy("rank").collect()
    assert [(r.id, r.relevance_score) for r in filled] == [(f"c{i:03d}", 0.5) for i in range(5)]


def test_vector_column_is_used(spark, corpus):
    chunks, queries = chunks_of(spark, corpus), queries_of(spark, *QUESTIONS[:2])
    within = retrieval.hybrid_ranks(chunks, queries).orderBy("method", "query_id", "rank").collect()
    stored = retrieval.hybrid_ranks(retrieval.vector_index(chunks), queries)
    assert stored.orderBy("method", "query_id", "rank").collect() == within


def test_model_slot(spark):
    import pyarrow as pa

    def lengths(lists):
        return pa.array([[float(len(words)), 0.0] for words in lists.to_pylist()], pa.list_(pa.float32()))

    chunks = chunks_of(spark, ["a b c", "a", "a b"])
    got = retrieval.hybrid_ranks(chunks, queries_of(spark, "one two"), model=lengths).where("method = 'dense'")
    assert [r.id for r in got.orderBy("rank").collect()] == ["c002", "c000", "c001"]


def test_hashing_model_is_unit_length():
    import pyarrow as pa

    vectors = hashing_model(16)(pa.array([["a", "b", "a"], [], ["c"]], pa.list_(pa.string()))).to_pylist()
    assert [round(sum(x * x for x in v), 5) for v in vectors] == [1.0, 0.0, 1.0]


def test_plain_number(spark):
    values = [4.5, 4.0, 0.0328, 0.00005, 2.67500001, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(plain_number(F.col("v"), 4)).collect()] == ["4.5", "4.0", "0.0328", "0.0001", "2.675", None]


def test_models_are_loaded_once_for_each_worker(spark, folder):
    """More batches than workers, but no more loads than workers."""
    from pathlib import Path

    loads = folder + "/loads"

    def make_pairs():
        with open(loads, "a") as log:
            log.write("load\n")
        return lambda queries, texts: np.array([float(len(q) + len(t)) for q, t in zip(queries, texts)])

    rows = [(q, f"c{i}", "t" * (i % 7), 0.1) for q in range(50) for i in range(60)]
    candidates = spark.createDataFrame(rows, "query_id bigint, id string, text string, rrf_score double").withColumn("rank", F.lit(1)).repartition(16)
    queries = spark.createDataFrame([(q, "q" * (q % 3)) for q in range(50)], "query_id bigint, query string")
    top = retrieval.rerank_model(candidates, queries, make_model=make_pairs, k=2).collect()
    assert len(top) == 100 and all(r.cross_encoder_score == r.query_id % 3 + 6 for r in top)
    assert 1 <= len(Path(loads).read_text().split()) <= 8 < 50

    def make_texts():
        return lambda texts: np.array([[len(t), t.count("t")] for t in texts], np.float32)

    vectors = retrieval.embedded(candidates.select("text").distinct(), "text", make_texts).collect()
    assert all(r.vector == [len(r.text), len(r.text)] for r in vectors) and len(vectors) == 7


def test_scores_of_a_batch_take_little_memory():
    """A batch of 10,000 vectors and 1,000 queries: a bounded part of the scores is held at once."""
    import tracemalloc

    rng = np.random.default_rng(3)
    queries, vectors = rng.normal(size=(1000, 8)).astype(np.float32), rng.normal(size=(10_000, 8)).astype(np.float32)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * 8), pa.array(x.ravel()))
    corpus = pa.table({"doc_order": pa.array(range(10_000)), "chunk_offset": pa.array([0] * 10_000, pa.int32()), "vector": lists(vectors)})
    asked = pa.table({"query_id": pa.array(range(1000)), "vector": lists(queries)})
    tracemalloc.start()
    found = topk._search([corpus], [topk.VectorScorer("dense")], {"dense": asked}, 3, [])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6
    got = np.array(found.sort_by([("query_id", "ascending"), ("score", "descending")])["doc_order"].to_pylist()).reshape(1000, 3)
    far = ((queries[:, None, :].astype(np.float64) - vectors[None, :, :]) ** 2).sum(axis=2)
    assert (got == np.argsort(far, axis=1)[:, :3]).all()
