"""Ticket-shaped views over the TPC-H-like test tables.

The formulas plant the fault classes of the contract; every row of the source
tables is used and descriptions are whole document texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticketlake.schema import AGENTS, CATEGORIES, CHANNELS, COLUMNS, SUBJECTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows spread over the cores: a test table is one file with one row group, hence one task."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _nth(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]


def tickets(spark: SparkSession, sf_dir: str, description: bool = True) -> DataFrame:
    """Raw tickets, one per order: ``seq`` (arrival order) and the twelve text columns.

    ``description=False`` leaves the documents table out for jobs that never
    read the text.
    """
    orders = spread(table(spark, sf_dir, "orders").select(*ORDER_COLUMNS))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    base = orders.join(customers, orders.o_custkey == customers.c_custkey)
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    if description:
        documents = table(spark, sf_dir, "documents").select("doc_id", "text")
        base = base.join(documents, k % documents.count() == F.col("doc_id"), "left")

    def when_multiple(of: int, then: Column, otherwise: Column) -> Column:
        return F.when(k % of == 0, then).otherwise(otherwise)

    null = F.lit(None).cast("string")
    number = F.when(k % 50 == 1, k - 1).otherwise(k) + 100000
    level = F.col("o_orderpriority")
    priority = (
        F.when(level == "1-URGENT", "Critical")
        .when(level == "2-HIGH", "High")
        .when(level == "3-MEDIUM", "Medium")
        .when(level == "5-LOW", "Low")
        .otherwise("")
    )
    values = {
        "Ticket_ID": when_multiple(97, null, F.concat(F.lit("TKT-"), number)),
        "Customer_Name": when_multiple(101, F.lit("  "), F.col("c_name")),
        "Customer_Email": F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")
        ),
        "Ticket_Subject": _nth(SUBJECTS, k % 5),
        "Ticket_Description": F.col("text") if description else null,
        "Issue_Category": _nth(CATEGORIES, c % 5),
        "Priority_Level": when_multiple(103, F.lit("Urgent_NonStandard"), priority),
        "Ticket_Channel": _nth(CHANNELS, c % 4),
        "Submission_Date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "Resolution_Time_Hours": when_multiple(89, null, ((k * 7 + c) % 73).cast("string")),
        "Assigned_Agent": _nth(AGENTS, (k * 3 + c) % 5),
        "Satisfaction_Score": F.when(k % 107 == 0, "99").otherwise(
            when_multiple(13, null, ((k * 11 + c) % 5 + 1).cast("string"))
        ),
    }
    return base.select(k.alias("seq"), *[values[name].alias(name) for name in COLUMNS])


def ticket_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tickets as JSON text in a ``value`` column; every 211th message is cut in half."""
    fields = F.struct(*COLUMNS, F.col("seq").alias("_seq"))
    whole = F.to_json(fields, {"ignoreNullFields": "false"})
    half = F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))
    return tickets(spark, sf_dir).select(
        "seq", F.when(F.col("seq") % 211 == 0, half).otherwise(whole).alias("value")
    )


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pipeline stage run per event: stage, start, outcome and declared datasets."""
    from ticketlake.operators.lineage import STAGES

    events = table(spark, sf_dir, "events")
    names = list(STAGES)
    stage = _nth(names, F.col("event_id") % len(names))
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        stage.alias("stage"),
        F.col("ts").cast("timestamp").alias("started"),
        F.when(F.col("event_type") == "error", "fail")
        .when(F.col("event_type") == "view", "aborted")
        .otherwise("complete")
        .alias("outcome"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a retrieval corpus."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("doc_order"),
        F.concat(F.lit("TKT-"), F.col("doc_id") + 100000).alias("ticket_id"),
        F.col("lang").alias("issue_category"),
        F.col("source").alias("assigned_agent"),
        F.col("text").alias("full_text"),
    )


def corpus_before(documents: DataFrame) -> DataFrame:
    """The corpus as it was: of each ten documents one not yet there and one with another text, and for every tenth one that is gone since."""
    n = F.col("doc_order")
    then = documents.where(n % 10 != 3).withColumn("full_text", F.when(n % 10 == 6, F.concat(F.lit("Before "), "full_text")).otherwise(F.col("full_text")))
    since = documents.where(n % 10 == 9).withColumns({"doc_order": -1 - n, "ticket_id": F.concat(F.lit("OLD-"), n)})
    return then.unionByName(since)


def slice_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stretches of 40 characters from the start of every document, as queries."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(F.array(*map(F.lit, range(3)))).alias("i"))
    query = F.substring(F.coalesce("text", F.lit("")), 1 + 40 * F.col("i"), F.lit(40))
    return documents.select((F.col("doc_id") * 3 + F.col("i")).alias("query_id"), query.alias("query"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items as search queries."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def subject_queries(spark: SparkSession) -> DataFrame:
    """The five subject lines as search queries."""
    return spark.createDataFrame(list(enumerate(SUBJECTS, 1)), "query_id bigint, query string")


def contract_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order whose fields walk through the edge cases of each rule."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    base = orders.join(customers, orders.o_custkey == customers.c_custkey)
    k, name = F.col("o_orderkey"), F.col("c_name")

    def walk(every: int, cases: list[str | None], otherwise: Column) -> Column:
        result = F.when(k % every == 0, F.lit(cases[0]).cast("string"))
        for i, case in enumerate(cases[1:], 1):
            result = result.when(k % every == i, F.lit(case).cast("string"))
        return result.otherwise(otherwise)

    return base.select(
        k.alias("seq"),
        walk(11, EDGE_IDS, F.concat(F.lit("\t "), name, F.lit(" \n"))).alias("Ticket_ID"),
        walk(13, EDGE_IDS, name).alias("Customer_Name"),
        walk(9, EDGE_PRIORITIES, F.lit("Medium")).alias("Priority_Level"),
        walk(17, EDGE_HOURS, (k % 100).cast("string")).alias("Resolution_Time_Hours"),
        walk(19, EDGE_SCORES, (k % 6).cast("string")).alias("Satisfaction_Score"),
    )


EDGE_IDS = [None, "", "  ", "None", "NaN", " nan "]
EDGE_PRIORITIES = [None, "", " ", "high", "URGENT", " Low ", "Critical"]
EDGE_HOURS = [None, "", "abc", "-3", "12", " 7.5 ", "nan", "1_0", "4d", "1e1", ".5"]
EDGE_SCORES = [None, "", "nan", " 4 ", "0.999", "5.001", "abc", "  ", "1", "5.0", "4d", "1e0", "-inf"]
EDGE_JSON = ["null", "7", "true", '["x"]', '{"y": 1}', '"text"']


def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records per order whose values are not always strings, or are missing."""
    k = F.col("o_orderkey")

    def value(every: int) -> Column:
        return F.element_at(F.array(*map(F.lit, EDGE_JSON)), (k % every % len(EDGE_JSON) + 1).cast("int"))

    text = F.concat(
        F.lit('{"Ticket_ID": '), k, F.lit(', "customer_name": "C'), F.col("o_custkey"),
        F.lit('", "Customer_Email": '), value(7),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(', "Priority_Level": '), value(17))),
        F.lit(', "Resolution_Time_Hours": '), value(11),
        F.lit(', "Satisfaction_Score": '), value(13),
        F.lit(', "unknown": 1}'),
    )
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return orders.select(k.alias("seq"), text.alias("value"))
