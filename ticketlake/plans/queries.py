"""The registered queries: one per operator, over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticketlake.functions.contract import NOT_A_RECORD, RULES, RawField
from ticketlake.functions.models import coverage_model
from ticketlake.operators import chunking, layers, lineage, quality, retrieval, topk, validate
from ticketlake.operators.bm25 import build_index
from ticketlake.operators.index import RetrievalIndex
from ticketlake.operators.merge import dedup_keep_last, keep_last_late
from ticketlake.plans.pipeline import run_pipeline, summary_frame
from ticketlake.schema import COLUMNS, NUMERIC
from ticketlake.session import scratch_dir
from ticketlake.sources import synthetic, testdata
from ticketlake.sources.csv import read_tickets_csv, write_tickets_csv
from ticketlake.sources.tables import SchemaMismatchError, VersionedTable
from ticketlake.sources.topics import COMPRESSION, LARGEST, Topic, as_messages, produce, read_topic
from ticketlake.streaming import ingest

KEY = "Ticket_ID"
NOW = dt.datetime(2025, 1, 1)
# the upsert batches overlap from the second to the first date
TARGET_BEFORE, SOURCE_FROM = "1998-01-01", "1996-01-01"
FAULT_FRACTION = 0.05
# scores are shown with so many digits; ranks come from whole ones
SCORE_DIGITS = 6


# --- shared inputs -----------------------------------------------------------


def judged(spark: SparkSession, sf: str, description: bool = False) -> DataFrame:
    return validate.validate_table(testdata.tickets(spark, sf, description), keep=("seq",))


def silver(spark: SparkSession, sf: str, description: bool = False) -> DataFrame:
    """Validated tickets, the last one per id."""
    return dedup_keep_last(validate.valid_tickets(judged(spark, sf, description)), KEY, "seq")


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver with descriptions as a written table, which retrieval scans more than once."""
    rows = validate.valid_tickets(judged(spark, sf, True))
    return VersionedTable(spark, scratch_dir(spark, "silver"), KEY, shared=layers.TEXTS).overwrite(rows, "seq")


def unvalidated(spark: SparkSession, sf: str, description: bool = False) -> DataFrame:
    """Typed tickets straight from the source, faults included."""
    raw = testdata.tickets(spark, sf, description)
    return raw.withColumns({c: F.col(c).try_cast("double") for c in NUMERIC})


def document_index(spark: SparkSession, sf: str) -> RetrievalIndex:
    index = RetrievalIndex(spark, scratch_dir(spark, "index"))
    index.update(testdata.corpus(spark, sf))
    return index


def ticket_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk(chunking.ticket_text(silver_table(spark, sf)))


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk(testdata.corpus(spark, sf))


# --- sources, sinks and streams ----------------------------------------------


def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_tickets_csv(testdata.tickets(spark, sf), path)
    return read_tickets_csv(spark, path, extra="seq bigint")


def produce_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A topic that refuses messages above 2,000 bytes: they are counted, the others go out."""
    topic = Topic(scratch_dir(spark, "topic"), options={LARGEST: "2000"})
    sent = produce(as_messages(testdata.tickets(spark, sf), order="seq"), topic)
    return spark.createDataFrame([tuple(sent.values())], "produced bigint, failed bigint, status string")


def _ingested(spark: SparkSession, sf: str) -> ingest.IngestPaths:
    root = scratch_dir(spark, "stream")
    topic, paths = Topic(f"{root}/raw"), ingest.IngestPaths.under(root)
    produce(testdata.ticket_messages(spark, sf), topic)
    ingest.ingest_available(spark, topic, paths)
    return paths


def stream_validate_valid(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.read_valid(spark, _ingested(spark, sf)).withColumnRenamed("_seq", "seq")


def stream_validate_dlq(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.read_quarantine_lines(spark, _ingested(spark, sf))


def _headed(names: str):
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([names])], ["line"])
        # with the header's schema, in which a line may be null
        yield from (pa.RecordBatch.from_arrays(batch.columns, ["line"]) for batch in batches)

    return run


def scan_csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a surplus or a missing cell among sound ones: they come back whole, the others parsed."""
    path = scratch_dir(spark, "csv")
    cells = ["seq", "Ticket_ID", "Issue_Category", "Priority_Level"]
    rows = testdata.tickets(spark, sf, description=False).select(*cells)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells])
    short = F.regexp_replace(line, ",[^,]*$", "")
    bent = F.when(F.col("seq") % 10 == 3, F.concat(line, F.lit(",EXTRA"))).when(F.col("seq") % 10 == 7, short).otherwise(line)
    # one file for each task, headed by the names
    rows.select(bent.alias("line")).mapInArrow(_headed(",".join(cells)), "line string").write.text(path)
    read = read_tickets_csv(spark, path, extra="seq bigint", multi_line=False, malformed="malformed")
    sound = F.col("malformed").isNull()
    return read.select("malformed", *[F.when(sound, F.col(c)).alias(c) for c in cells])


def ingest_fallback_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs without a topic and one with it: every third of the tickets arrives once."""
    root = scratch_dir(spark, "runs")
    topic, paths = Topic(f"{root}/raw"), ingest.IngestPaths.under(root)
    thirds = [as_messages(testdata.tickets(spark, sf).where(F.col("seq") % 3 == i), "seq") for i in range(3)]
    ingest.ingest_or_fallback(spark, topic, thirds[0], paths)
    ingest.ingest_or_fallback(spark, topic, thirds[1], paths)
    produce(thirds[2], topic)
    ingest.ingest_or_fallback(spark, topic, thirds[0], paths)
    return ingest.read_valid(spark, paths).withColumnRenamed("_seq", "seq")


def ingest_run_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs with a third of the tickets each: every run has its own totals."""
    root = scratch_dir(spark, "totals")
    topic, paths = Topic(f"{root}/raw"), ingest.IngestPaths.under(root)
    tickets, totals = testdata.tickets(spark, sf), None
    for i in range(3):
        produce(as_messages(tickets.where(F.col("seq") % 3 == i), "seq"), topic)
        run = ingest.ingest_or_fallback(spark, topic, None, paths)
        own = ingest.ingest_summary(spark, paths, run).withColumn("run", F.lit(run).cast("bigint"))
        totals = own if totals is None else totals.unionByName(own)
    return totals


def pipeline_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Both topics of a run whose last batch is replayed, as after a crash before its checkpoint."""
    root = scratch_dir(spark, "topics")
    topic, paths = Topic(f"{root}/raw"), ingest.IngestPaths.under(root)
    sinks = {"valid": Topic(f"{root}/valid"), "dlq": Topic(f"{root}/dlq")}
    produce(testdata.ticket_messages(spark, sf), topic)
    ingest.ingest_available(spark, topic, paths, **sinks)
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{paths.checkpoint}/commits")
    system = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in system.listStatus(commits) if f.getPath().getName().isdigit()]
    system.delete(max(done, key=lambda path: int(path.getName())), False)
    ingest.ingest_available(spark, topic, paths, **sinks)
    value, nothing = F.col("value"), F.lit(None).cast("string")
    valid, dlq = (read_topic(spark, sinks[name]).withColumn("topic", F.lit(name)) for name in ("valid", "dlq"))
    valid = valid.select("topic", F.get_json_object(value, "$.Ticket_ID").alias("ticket_id"), nothing.alias("rejection_reason"))
    return valid.unionByName(dlq.select("topic", nothing.alias("ticket_id"), F.get_json_object(value, "$.rejection_reason").alias("rejection_reason")))


def pipeline_csv_faults(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job over CSV files with two headers, and with surplus and missing cells in some lines."""
    root = scratch_dir(spark, "csv-job")
    rows = testdata.tickets(spark, sf, description=False)
    for odd, cells in enumerate((["Ticket_ID", "Customer_Name", "Issue_Category", "Priority_Level"], ["Priority_Level", "Ticket_ID", "Customer_Name"])):
        line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in cells])
        short = F.regexp_replace(line, ",[^,]*$", "")
        bent = F.when((F.col("seq") % 10).isin(2, 3), F.concat(line, F.lit(",EXTRA"))).when((F.col("seq") % 10).isin(6, 7), short).otherwise(line)
        lines = rows.where(F.col("seq") % 2 == odd).select(bent.alias("line")).mapInArrow(_headed(",".join(cells)), "line string")
        lines.write.mode("append").text(f"{root}/in")
    run_pipeline(spark, f"{root}/job", csv_path=f"{root}/in", now=NOW)
    routed = ingest.read_routed(spark, ingest.IngestPaths.under(f"{root}/job/ingest"))
    valid, malformed = F.col("outcome") == ingest.VALID, F.col(validate.REASON) == NOT_A_RECORD
    cells = ["Ticket_ID", "Customer_Name", "Issue_Category", "Priority_Level"]
    return routed.select(
        "outcome", *[F.when(valid, F.col(c)).alias(c) for c in cells], F.when(malformed, F.col(validate.RAW)).alias("line"), validate.REASON
    )


def inject_faults(spark: SparkSession, sf: str) -> DataFrame:
    return synthetic.inject_faults(testdata.tickets(spark, sf), FAULT_FRACTION)


# --- contract ----------------------------------------------------------------


def contract_rename(spark: SparkSession, sf: str) -> DataFrame:
    raw = testdata.tickets(spark, sf)
    mixed = raw.select(
        "seq",
        F.col("Ticket_ID").alias("id_as_column"),
        F.concat(F.lit("ALT-"), F.col("seq")).alias("id_as_field"),
        F.col("Customer_Name").alias("customer_name"),
        F.col("Priority_Level").alias("priority_level"),
        *[c for c in raw.columns if c not in ("seq", "Ticket_ID", "Customer_Name", "Priority_Level")],
        F.lit("x").alias("not_in_contract"),
    )
    spelled = ["seq", "Ticket_ID", "ticket_id", *mixed.columns[3:]]
    return validate.rename_to_contract(mixed.toDF(*spelled), keep=("seq",))


def _rule(column: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        cases = testdata.contract_cases(spark, sf)
        field, rule = RawField(F.col(column), F.lit(True), F.lit("STRING")), RULES[column]
        valued = cases.select("seq", column, rule.value(field).alias("value"))
        return valued.select("seq", "value", rule.error(field, F.col("value")).alias("error"))

    return run


contract_required = _rule("Ticket_ID")
contract_priority = _rule("Priority_Level")
contract_hours = _rule("Resolution_Time_Hours")
contract_score = _rule("Satisfaction_Score")


def contract_types(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_json(testdata.typed_messages(spark, sf), keep=("seq",)).select(
        "seq", KEY, "Customer_Name", "Customer_Email", "Priority_Level", *NUMERIC, validate.REASON
    )


def contract_reasons(spark: SparkSession, sf: str) -> DataFrame:
    cases = testdata.contract_cases(spark, sf)
    return validate.validate_table(cases, keep=("seq",)).select("seq", validate.REASON)


def validate_valid(spark: SparkSession, sf: str) -> DataFrame:
    return validate.valid_tickets(judged(spark, sf, description=True))


def validate_dlq(spark: SparkSession, sf: str) -> DataFrame:
    return validate.quarantine(judged(spark, sf, description=True), keep=("seq",))


def validate_dlq_extra_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected records with two columns that the contract does not know."""
    tickets = testdata.tickets(spark, sf).withColumns({"note": F.concat(F.lit("n"), F.col("seq") % 7), "size": F.col("seq") % 5})
    return validate.quarantine(validate.validate_table(tickets, keep=("seq",)), keep=("seq",))


def validate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return validate.summary(judged(spark, sf))


def dlq_sample(spark: SparkSession, sf: str) -> DataFrame:
    return validate.dlq_sample(validate.quarantine(judged(spark, sf), keep=("seq",)), "seq")


# --- layers ------------------------------------------------------------------


def _as_text(df: DataFrame, *stamps: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    table = VersionedTable(spark, scratch_dir(spark, "bronze"))
    rows = validate.valid_tickets(judged(spark, sf, description=True))
    return _as_text(table.overwrite(layers.bronze(rows, NOW)), "_ingestion_time")


def silver_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    table = VersionedTable(spark, scratch_dir(spark, "silver"), KEY, shared=layers.TEXTS)
    rows = layers.bronze(validate.valid_tickets(judged(spark, sf, description=True)), NOW)
    made = layers.merge_silver(table, rows, "seq", NOW)
    return _as_text(made, "_ingestion_time", "_processed_time")


def silver_merge(spark: SparkSession, sf: str) -> DataFrame:
    table = VersionedTable(spark, scratch_dir(spark, "silver"), KEY, shared=layers.TEXTS)
    rows = unvalidated(spark, sf, description=True)
    table.overwrite(rows.where(F.col("Submission_Date") < TARGET_BEFORE))
    late = rows.where(F.col("Submission_Date") >= SOURCE_FROM)
    return table.merge(late.withColumn("Satisfaction_Score", 6 - F.col("Satisfaction_Score")), KEY, "seq")


def dedup(spark: SparkSession, sf: str) -> DataFrame:
    return keep_last_late(testdata.tickets(spark, sf), KEY, "seq")


def pipeline_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Silver after two runs; the second sends every other ticket again, changed, under smaller arrival numbers."""
    root = scratch_dir(spark, "rerun")
    # the topic keeps all messages of both runs: half the bytes of the default compression
    topic, paths = Topic(f"{root}/raw", options={COMPRESSION: "gzip"}), ingest.IngestPaths.under(root)
    table = VersionedTable(spark, f"{root}/silver", KEY, shared=layers.TEXTS)
    tickets = testdata.tickets(spark, sf)
    score = F.when(F.col("Satisfaction_Score").between("1", "5"), (6 - F.col("Satisfaction_Score").cast("int")).cast("string"))
    changed = tickets.where(F.col("seq") % 2 == 0).withColumns({"Satisfaction_Score": score, "seq": F.col("seq") - 10**9})
    for sent in (tickets, changed):
        produce(as_messages(sent, "seq"), topic)
        run = ingest.ingest_or_fallback(spark, topic, None, paths)
        newest = layers.bronze(ingest.arrived_valid(spark, paths, run), NOW)
        layers.merge_silver(table, newest, F.struct(*ingest.ARRIVAL), NOW, drop=("batch_id",))
    return _as_text(table.read().withColumnRenamed("_seq", "seq"), "_ingestion_time", "_processed_time")


def schema_enforcement(spark: SparkSession, sf: str) -> DataFrame:
    table = VersionedTable(spark, scratch_dir(spark, "enforced"), KEY, shared=layers.TEXTS)
    rows = table.overwrite(validate.valid_tickets(judged(spark, sf, description=True)), "seq")
    attempts = {
        "extra_column": rows.withColumn("unexpected_extra_column", F.lit(1)),
        "changed_type": rows.withColumn("Satisfaction_Score", F.col("Satisfaction_Score").cast("string")),
        "missing_column": rows.drop("Assigned_Agent"),
        "same_columns": rows,
    }
    outcomes = []
    for name, df in attempts.items():
        try:
            table.append(df)
            refused = False
        except SchemaMismatchError:
            refused = True
        outcomes.append((name, refused, table.read([KEY]).count()))
    return spark.createDataFrame(outcomes, "attempt string, refused boolean, rows_after bigint")


def gold_category(spark: SparkSession, sf: str) -> DataFrame:
    return layers.gold_category(silver(spark, sf))


def gold_agent(spark: SparkSession, sf: str) -> DataFrame:
    return layers.gold_agent(silver(spark, sf))


def gold_sla(spark: SparkSession, sf: str) -> DataFrame:
    return layers.gold_sla(silver(spark, sf))


def gold_category_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return layers.ranked("gold_category", gold_category(spark, sf))


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "layers")
    table = {n: VersionedTable(spark, f"{root}/{n}") for n in ("bronze", *layers.GOLD)}
    table["silver"] = VersionedTable(spark, f"{root}/silver", KEY, shared=layers.TEXTS)
    judged_rows = judged(spark, sf, description=True)
    bronze = table["bronze"].overwrite(layers.bronze(validate.valid_tickets(judged_rows), NOW))
    layers.merge_silver(table["silver"], bronze, "seq", NOW)
    made = table["silver"].read(layers.MEASURED)
    for name, build in layers.GOLD.items():
        table[name].overwrite(build(made))
    counted = {name: t.read([KEY]) if name in ("bronze", "silver") else t.read() for name, t in table.items()}
    return layers.row_counts({"quarantine": validate.quarantine(judged_rows)} | counted)


# --- quality -----------------------------------------------------------------


def _both(spark: SparkSession, sf: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same check over the unvalidated tickets and over silver."""
    raw = build(unvalidated(spark, sf)).withColumn("dataset", F.lit("unvalidated"))
    return raw.unionByName(build(silver(spark, sf)).withColumn("dataset", F.lit("silver")))


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, quality.report)


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, quality.summarize).drop("evaluations", "status")


def _gate_row(name: str, df: DataFrame) -> tuple[str, str]:
    try:
        return name, quality.run_gate(df)["status"]
    except quality.QualityGateError:
        return name, "HALTED"


def quality_gate_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = [_gate_row("unvalidated", unvalidated(spark, sf)), _gate_row("silver", silver(spark, sf))]
    return spark.createDataFrame(rows, "dataset string, gate string")


def quality_gate_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets that were never submitted: none."""
    none = unvalidated(spark, sf).where(F.col("Submission_Date").isNull())
    return spark.createDataFrame([_gate_row("empty", none)], "dataset string, gate string")


# --- lineage -----------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.events(testdata.stage_runs(spark, sf))


def lineage_events(spark: SparkSession, sf: str) -> DataFrame:
    def names(column: str) -> Column:
        return F.array_join(F.transform(column, lambda d: F.concat(d["namespace"], F.lit("/"), d["name"])), ",")

    return _events(spark, sf).select(
        F.col("eventType").alias("event_type"),
        F.col("eventTime").alias("event_time"),
        F.col("run.runId").alias("run_id"),
        F.concat("job.namespace", F.lit("/"), "job.name").alias("job"),
        names("inputs").alias("inputs"),
        names("outputs").alias("outputs"),
        "producer",
    )


def lineage_states(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).groupBy(F.col("eventType").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


def lineage_run_status(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.run_status(_events(spark, sf))


def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.edges(_events(spark, sf))


# --- retrieval ---------------------------------------------------------------


def rag_ticket_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = testdata.tickets(spark, sf)
    return chunking.ticket_text(raw, order="seq", row_number="seq")


def rag_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return document_chunks(spark, sf)


def rag_tokens(spark: SparkSession, sf: str) -> DataFrame:
    listed = retrieval.with_terms(document_chunks(spark, sf))
    return listed.select("id", "n_terms", F.array_join("terms", " ").alias("terms"))


def bm25_term_stats(spark: SparkSession, sf: str) -> DataFrame:
    terms = build_index(document_chunks(spark, sf)).terms
    return terms.select("term", "doc_freq", F.round("idf", 6).alias("idf"))


def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = retrieval.bm25_topk(document_chunks(spark, sf), testdata.benchmark_queries(spark, sf))
    return found.select("query_id", "rank", "id", F.round("score", SCORE_DIGITS).alias("score"))


def lexical_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = retrieval.lexical_topk(document_chunks(spark, sf), testdata.benchmark_queries(spark, sf))
    return found.select("query_id", "rank", "id", F.round("score", SCORE_DIGITS).alias("score"))


def _vector_digest(df: DataFrame, *keep: str) -> DataFrame:
    """A vector as its number of filled places, its squared length and a weighted sum."""
    vector = F.col("vector")
    zero = F.lit(0.0)
    weighed = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return df.select(
        *keep,
        F.size(F.filter(vector, lambda x: x > 0)).cast("bigint").alias("n_filled"),
        F.round(F.aggregate(vector, zero, lambda a, x: a + x.cast("double") * x), 4).alias("squares"),
        F.round(F.aggregate(weighed, zero, lambda a, x: a + x), 4).alias("weighed"),
    )


def embed_hashing(spark: SparkSession, sf: str) -> DataFrame:
    return _vector_digest(retrieval.vector_index(document_chunks(spark, sf)), "id")


def vector_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index as a table, built twice: a rebuild replaces what was there."""
    table = VersionedTable(spark, scratch_dir(spark, "vectors"))
    built = retrieval.vector_index(document_chunks(spark, sf)).select(
        "id", "ticket_id", "issue_category", "assigned_agent", "vector"
    )
    table.overwrite(built)
    return _vector_digest(table.overwrite(built), "id", "ticket_id", "issue_category", "assigned_agent")


def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors nearest to the mean vector of each label."""
    embeddings = testdata.table(spark, sf, "embeddings")
    places = embeddings.select("label", F.posexplode("embedding").alias("place", "x"))
    means = places.groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    queries = means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda p: p["x"]).alias("vector")
    )
    corpus = embeddings.select(
        F.col("vec_id").alias("doc_order"), F.lit(0).alias("chunk_offset"), F.col("embedding").alias("vector")
    )
    found = retrieval.dense_topk(corpus, queries, carry=[])
    return found.select("query_id", "rank", F.col("doc_order").alias("vec_id"), F.round("distance", SCORE_DIGITS).alias("distance"))


def dense_topk_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Some vectors are null, hold a null or are not numbers; the ten best of the others are found."""
    place, rows = F.col("vec_id"), testdata.table(spark, sf, "embeddings")
    odd = F.when(place % 17 == 0, F.lit(None)).when(place % 19 == 0, F.transform("embedding", lambda x: x * float("nan")))
    odd = odd.when(place % 23 == 0, F.transform("embedding", lambda x, i: F.when(i > 0, x))).otherwise(F.col("embedding"))
    corpus = rows.select(place.alias("doc_order"), F.lit(0).alias("chunk_offset"), odd.alias("vector"))
    queries = rows.where(place % 100 == 1).select(place.alias("query_id"), F.col("embedding").alias("vector"))
    found = retrieval.dense_topk(corpus, queries, carry=[])
    return found.select("query_id", "rank", F.col("doc_order").alias("vec_id"), F.round("distance", SCORE_DIGITS).alias("distance"))


def bm25_topk_many(spark: SparkSession, sf: str) -> DataFrame:
    """Three queries from the text of every document, against the stored index."""
    index = document_index(spark, sf)
    found = index.bm25_topk(testdata.slice_queries(spark, sf), retrieval.FUSED_K)
    return index.with_texts(found).select("query_id", "rank", "id", F.round("score", SCORE_DIGITS).alias("score"))


def index_dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest chunks by the stored vectors, whose blocks are skipped by the triangle inequality."""
    index = document_index(spark, sf)
    found = index.dense_topk(testdata.benchmark_queries(spark, sf), retrieval.FUSED_K)
    return index.with_texts(found).select("query_id", "rank", "id", F.round(-F.col("score"), SCORE_DIGITS).alias("distance"))


def index_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    """Both lists after an update in which every tenth document is new, changed or gone."""
    index, corpus = RetrievalIndex(spark, scratch_dir(spark, "index")), testdata.corpus(spark, sf)
    index.update(testdata.corpus_before(corpus))
    index.update(corpus)
    ranks = index.hybrid_ranks(testdata.benchmark_queries(spark, sf), retrieval.FUSED_K)
    return ranks.select("method", "query_id", "rank", "id")


def _fused(spark: SparkSession, sf: str) -> DataFrame:
    chunks, queries = document_chunks(spark, sf), testdata.benchmark_queries(spark, sf)
    return retrieval.fuse(retrieval.hybrid_ranks(chunks, queries))


def rrf_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return _fused(spark, sf).select(
        "query_id", "rank", "id", "dense_rank", "bm25_rank", F.round("rrf_score", 6).alias("rrf_score")
    )


def _reranked(top: DataFrame) -> DataFrame:
    score = F.round("cross_encoder_score", SCORE_DIGITS).alias("cross_encoder_score")
    return top.select("query_id", "rank", "id", score)


def rerank_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return _reranked(retrieval.rerank_overlap(_fused(spark, sf), testdata.benchmark_queries(spark, sf)))


def rerank_udf(spark: SparkSession, sf: str) -> DataFrame:
    """Rerank by a model that each Python worker loads once."""
    return _reranked(retrieval.rerank_model(_fused(spark, sf), testdata.benchmark_queries(spark, sf), make_model=coverage_model))


def answer_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Only chunks that share a word are candidates; queries without one get the first chunks."""
    chunks, queries = document_chunks(spark, sf), testdata.subject_queries(spark)
    hits = retrieval.lexical_candidates(chunks, queries).where(F.col("rrf_score") > retrieval.LEXICAL_BIAS)
    top = retrieval.rerank_overlap(hits, queries)
    filled = retrieval.fill_unanswered(top, queries, chunks)
    return retrieval.citations(filled, keep=("id",)).select(
        "query_id", "citation_id", "id", "ticket_id", "relevance_score"
    )


def citations(spark: SparkSession, sf: str) -> DataFrame:
    top = retrieval.top_documents(ticket_chunks(spark, sf), testdata.subject_queries(spark), lists="lexical")
    return retrieval.citations(top).drop("rank")


def _answers(spark: SparkSession, sf: str, lists: str) -> DataFrame:
    answered = retrieval.answer_queries(ticket_chunks(spark, sf), testdata.subject_queries(spark), lists=lists)
    return answered.select("query_id", "query", "answer", F.size("citations").cast("bigint").alias("n_citations"))


def grounded_answer(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf, "lexical")


def hybrid_answer(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf, "hybrid")


def answer_top_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of each answer with their fused scores and ranks."""
    answered = retrieval.answer_queries(document_index(spark, sf), testdata.benchmark_queries(spark, sf))
    each = answered.select("query_id", F.posexplode("top_documents").alias("place", "d"))
    return each.select(
        "query_id", F.col("place").cast("bigint").alias("place"), "d.id", "d.text", F.round("d.rrf_score", SCORE_DIGITS).alias("rrf_score"),
        "d.dense_rank", "d.bm25_rank", F.round("d.cross_encoder_score", SCORE_DIGITS).alias("cross_encoder_score"),
    )


# --- pipeline ----------------------------------------------------------------


def pipeline_summary(spark: SparkSession, sf: str) -> DataFrame:
    result = run_pipeline(
        spark,
        scratch_dir(spark, "pipeline"),
        tickets=testdata.tickets(spark, sf),
        queries=testdata.subject_queries(spark),
        now=NOW,
    )
    return summary_frame(spark, result)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        scan_csv_roundtrip, produce_counts, stream_validate_valid, stream_validate_dlq,
        scan_csv_malformed, ingest_fallback_runs, inject_faults, pipeline_rerun,
        ingest_run_totals, pipeline_topics, pipeline_csv_faults,
        validate_dlq_extra_columns, dense_topk_gaps,
        contract_rename, contract_types, contract_reasons,
        validate_valid, validate_dlq, validate_summary, dlq_sample,
        bronze_load, silver_bootstrap, silver_merge, schema_enforcement,
        gold_category, gold_agent, gold_sla, gold_category_ranked, layer_counts,
        quality_report, quality_score, quality_gate_status, quality_gate_empty,
        lineage_events, lineage_states, lineage_run_status, lineage_edges,
        rag_ticket_text, rag_chunks, rag_tokens, bm25_term_stats, bm25_topk, lexical_topk,
        embed_hashing, vector_index, dense_topk, rrf_fusion, rerank_overlap, rerank_udf,
        bm25_topk_many, index_dense_topk, index_upkeep, answer_top_documents,
        answer_fallback, citations, grounded_answer, hybrid_answer,
        pipeline_summary,
    )
} | {
    "contract_required": contract_required,
    "contract_priority": contract_priority,
    "contract_hours": contract_hours,
    "contract_score": contract_score,
    "dedup_keep_last": dedup,
}
