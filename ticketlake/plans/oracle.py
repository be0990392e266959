"""DuckDB SQL for the registered queries, written from the rules, not from the Spark code.

``queries()`` joins shared table expressions (``WITH`` parts) to one statement
per query. Only those that a query needs, directly or not, are put in front.
"""

from __future__ import annotations

import re

from ticketlake.schema import AGENTS, CATEGORIES, CHANNELS, SUBJECTS
from ticketlake.sources import testdata

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def nth(values: list[str], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values))
    return f"(CASE {index} {cases} END)"


def walk(every: int, values: list[str | None], otherwise: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values))
    return f"(CASE k % {every} {cases} ELSE {otherwise} END)"


def strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^{SPACE}+', ''), '{SPACE}+$', '')"


NUMBER = r"'^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$'"


def number(expr: str) -> str:
    bare = strip(expr)
    return (
        f"(CASE WHEN regexp_matches({bare}, {NUMBER}) THEN TRY_CAST(replace({bare}, '_', '') AS DOUBLE) "
        f"WHEN lower({bare}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
        f"WHEN lower({bare}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) END)"
    )


def nan(expr: str) -> str:
    return f"(lower({strip(expr)}) IN ('nan', '+nan', '-nan'))"


def required_error(column: str, field: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR {strip(column)} = '' OR lower({column}) IN ('none', 'nan') "
        f"THEN 'Value error, Field ''{field}'' cannot be empty or null' END"
    )


def priority_value(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {strip(column)} = '' THEN 'Medium' ELSE {strip(column)} END"


def priority_error(value: str) -> str:
    return (
        f"CASE WHEN {value} NOT IN ('Low', 'Medium', 'High', 'Critical') THEN 'Value error, Priority_Level ''' "
        f"|| {value} || ''' not in allowed values: [''Low'', ''Medium'', ''High'', ''Critical'']' END"
    )


def hours_error(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NOT NULL AND {number(column)} IS NULL AND NOT {nan(column)} "
        "THEN 'Input should be a valid number, unable to parse string as a number' END"
    )


def score_value(column: str) -> str:
    return f"CASE WHEN {number(column)} BETWEEN 1 AND 5 THEN {number(column)} END"


def score_error(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NOT NULL AND {column} <> '' AND NOT {nan(column)} "
        f"AND NOT coalesce({number(column)} BETWEEN 1 AND 5, false) "
        f"THEN 'Value error, Invalid satisfaction score: ' || {column} END"
    )


def reason(errors: dict[str, str]) -> str:
    joined = ", ".join(f"'{column}: ' || ({error})" for column, error in errors.items())
    return f"nullif(concat_ws(' | ', {joined}), '')"


RAW_COLUMNS = (
    '"Ticket_ID", "Customer_Name", "Customer_Email", "Ticket_Subject", "Ticket_Description", '
    '"Issue_Category", "Priority_Level", "Ticket_Channel", "Submission_Date", '
    '"Resolution_Time_Hours", "Assigned_Agent", "Satisfaction_Score"'
)
ENVELOPE = "json_object(" + ", ".join(f"'{c[1:-1]}', {c}" for c in RAW_COLUMNS.split(", ")) + ")::VARCHAR"
MESSAGE = ENVELOPE.replace(")::VARCHAR", ", '_seq', seq)::VARCHAR")

# --- shared table expressions ------------------------------------------------

PARTS: dict[str, str] = {}

PARTS["base"] = """
SELECT o_orderkey AS k, c_custkey AS c, c_name, o_orderpriority AS level, o_orderdate AS day
FROM orders JOIN customer ON o_custkey = c_custkey"""

PARTS["tickets"] = f"""
SELECT k AS seq,
  CASE WHEN k % 97 = 0 THEN NULL
       ELSE 'TKT-' || CAST(100000 + CASE WHEN k % 50 = 1 THEN k - 1 ELSE k END AS VARCHAR) END AS "Ticket_ID",
  CASE WHEN k % 101 = 0 THEN '  ' ELSE c_name END AS "Customer_Name",
  lower(replace(c_name, '#', '.')) || '@example.com' AS "Customer_Email",
  {nth(SUBJECTS, 'k % 5')} AS "Ticket_Subject",
  documents.text AS "Ticket_Description",
  {nth(CATEGORIES, 'c % 5')} AS "Issue_Category",
  CASE WHEN k % 103 = 0 THEN 'Urgent_NonStandard' WHEN level = '1-URGENT' THEN 'Critical'
       WHEN level = '2-HIGH' THEN 'High' WHEN level = '3-MEDIUM' THEN 'Medium'
       WHEN level = '5-LOW' THEN 'Low' ELSE '' END AS "Priority_Level",
  {nth(CHANNELS, 'c % 4')} AS "Ticket_Channel",
  strftime(day, '%Y-%m-%d') AS "Submission_Date",
  CASE WHEN k % 89 = 0 THEN NULL ELSE CAST((7 * k + c) % 73 AS VARCHAR) END AS "Resolution_Time_Hours",
  {nth(AGENTS, '(3 * k + c) % 5')} AS "Assigned_Agent",
  CASE WHEN k % 107 = 0 THEN '99' WHEN k % 13 = 0 THEN NULL
       ELSE CAST(1 + (11 * k + c) % 5 AS VARCHAR) END AS "Satisfaction_Score"
FROM base LEFT JOIN documents ON documents.doc_id = k % (SELECT count(*) FROM documents)"""

TICKET_REASON = reason(
    {
        "Ticket_ID": required_error('"Ticket_ID"', "ticket_id"),
        "Customer_Name": required_error('"Customer_Name"', "customer_name"),
        "Priority_Level": priority_error(f"({priority_value(chr(34) + 'Priority_Level' + chr(34))})"),
        "Satisfaction_Score": score_error('"Satisfaction_Score"'),
    }
)
# of CSV files without a score
CSV_REASON = reason(
    {
        "Ticket_ID": required_error('"Ticket_ID"', "ticket_id"),
        "Customer_Name": required_error('"Customer_Name"', "customer_name"),
        "Priority_Level": priority_error(f"({priority_value(chr(34) + 'Priority_Level' + chr(34))})"),
    }
)
PARTS["judged"] = f"SELECT *, {TICKET_REASON} AS rejection_reason FROM tickets"

TYPED = """seq, "Ticket_ID", "Customer_Name", "Customer_Email", "Ticket_Subject", "Ticket_Description",
  "Issue_Category", CASE WHEN "Priority_Level" = '' THEN 'Medium' ELSE "Priority_Level" END AS "Priority_Level",
  "Ticket_Channel", "Submission_Date", CAST("Resolution_Time_Hours" AS DOUBLE) AS "Resolution_Time_Hours",
  "Assigned_Agent", CAST("Satisfaction_Score" AS DOUBLE) AS "Satisfaction_Score\""""
PARTS["valid"] = f"SELECT {TYPED} FROM judged WHERE rejection_reason IS NULL"
# in the second of two runs a faulty score is null, so it is no reason
PARTS["judged_again"] = f"""SELECT *, {TICKET_REASON} AS rejection_reason
FROM (SELECT * REPLACE (CASE WHEN "Satisfaction_Score" BETWEEN '1' AND '5' THEN "Satisfaction_Score" END AS "Satisfaction_Score")
  FROM tickets WHERE seq % 2 = 0)"""
PARTS["silver"] = (
    'SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY "Ticket_ID" ORDER BY seq DESC) = 1'
)
PARTS["unvalidated"] = """
SELECT * REPLACE (CAST("Resolution_Time_Hours" AS DOUBLE) AS "Resolution_Time_Hours",
                  CAST("Satisfaction_Score" AS DOUBLE) AS "Satisfaction_Score") FROM tickets"""

PARTS["cases"] = f"""
SELECT k AS seq,
  {walk(11, testdata.EDGE_IDS, "chr(9) || ' ' || c_name || ' ' || chr(10)")} AS "Ticket_ID",
  {walk(13, testdata.EDGE_IDS, 'c_name')} AS "Customer_Name",
  {walk(9, testdata.EDGE_PRIORITIES, "'Medium'")} AS "Priority_Level",
  {walk(17, testdata.EDGE_HOURS, 'CAST(k % 100 AS VARCHAR)')} AS "Resolution_Time_Hours",
  {walk(19, testdata.EDGE_SCORES, 'CAST(k % 6 AS VARCHAR)')} AS "Satisfaction_Score"
FROM base"""


def json_value(every: int) -> str:
    return nth(testdata.EDGE_JSON, f"((k % {every}) % {len(testdata.EDGE_JSON)})")


PARTS["typed_values"] = f"""
SELECT o_orderkey AS k, o_custkey AS c, {json_value(7)} AS email, {json_value(11)} AS spent,
  {json_value(13)} AS score, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {json_value(17)} END AS level
FROM (SELECT *, o_orderkey AS k FROM orders)""".replace("SELECT o_orderkey AS k, o_custkey", "SELECT k, o_custkey")

PARTS["checks"] = """
SELECT dataset, total, unnest(['expect_column_values_to_not_be_null(Ticket_ID)',
    'expect_column_values_to_not_be_null(Customer_Name)',
    'expect_column_values_to_be_unique(Ticket_ID)',
    'expect_column_values_to_be_between(Satisfaction_Score, 1, 5)']) AS expectation,
  unnest([no_id, no_name, repeated, out_of_range]) AS unexpected_count
FROM (
  SELECT dataset, count(*) AS total,
    count(*) FILTER ("Ticket_ID" IS NULL) AS no_id,
    count(*) FILTER ("Customer_Name" IS NULL) AS no_name,
    count(*) - count(DISTINCT coalesce("Ticket_ID", '<null>')) AS repeated,
    count(*) FILTER ("Satisfaction_Score" < 1 OR "Satisfaction_Score" > 5) AS out_of_range
  FROM (SELECT 'unvalidated' AS dataset, * FROM unvalidated UNION ALL SELECT 'silver', * FROM silver)
  GROUP BY dataset)"""

# --- fixed values: the seven stages with what they read and write
PARTS["stage_names"] = """
SELECT * FROM (VALUES
  (0, 'produce', 'raw_crm_dataset', 'support-tickets-raw'),
  (1, 'consume_validate', 'support-tickets-raw', 'support-tickets-valid,support-tickets-dlq,quarantine_jsonl'),
  (2, 'bronze', 'support-tickets-valid', 'delta_bronze'),
  (3, 'silver', 'delta_bronze', 'delta_silver'),
  (4, 'quality_gate', 'delta_silver', 'quality_audit_metrics'),
  (5, 'gold', 'delta_silver', 'delta_gold_category,delta_gold_agent,delta_gold_sla'),
  (6, 'rag', 'delta_silver', 'chroma_vector_db,bm25_index,rag_answer')
) AS s(i, stage, ins, outs)"""
PARTS["runs"] = f"""
SELECT CAST(event_id AS VARCHAR) AS run_id, stage, ins, outs,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS happened,
  CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'view' THEN 'OTHER' ELSE 'COMPLETE' END AS ended
FROM events JOIN stage_names ON i = event_id % 7"""
PARTS["run_events"] = """
SELECT 'START' AS event_type, * FROM runs UNION ALL SELECT ended, * FROM runs"""

PARTS["doc_chunks"] = """
SELECT doc_id AS doc_order, CAST(o AS INTEGER) AS chunk_offset,
  'doc_TKT-' || (100000 + doc_id) || '_chunk_' || o AS id, 'TKT-' || (100000 + doc_id) AS ticket_id,
  NULL::VARCHAR AS customer_name, lang AS issue_category, source AS assigned_agent,
  substring(text, CAST(o + 1 AS BIGINT), 400) AS text
FROM (SELECT *, unnest(range(0, length(text), 320)) AS o FROM documents)"""

PARTS["ticket_texts"] = """
SELECT "Ticket_ID" AS doc_order, "Ticket_ID" AS ticket_id, "Customer_Name" AS customer_name,
  "Issue_Category" AS issue_category, "Assigned_Agent" AS assigned_agent,
  'Ticket ID: ' || "Ticket_ID" || ' | Customer: ' || "Customer_Name" || ' | Category: ' || "Issue_Category"
  || ' | Subject: ' || "Ticket_Subject" || ' | Agent: ' || "Assigned_Agent" || ' | Satisfaction: '
  || coalesce(CAST("Satisfaction_Score" AS VARCHAR), '5') || ' | Description: '
  || coalesce(nullif("Ticket_Description", ''), 'No description provided.') AS full_text
FROM silver"""
PARTS["ticket_chunks"] = """
SELECT doc_order, CAST(o AS INTEGER) AS chunk_offset, 'doc_' || ticket_id || '_chunk_' || o AS id,
  ticket_id, customer_name, issue_category, assigned_agent,
  substring(full_text, CAST(o + 1 AS BIGINT), 400) AS text
FROM (SELECT *, unnest(range(0, length(full_text), 320)) AS o FROM ticket_texts)"""

PARTS["subject_queries"] = "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i} AS BIGINT), {text(s)})" for i, s in enumerate(SUBJECTS, 1)
) + ") AS q(query_id, query)"
PARTS["slice_queries"] = """
SELECT doc_id * 3 + i AS query_id, substr(coalesce(text, ''), 1 + 40 * i, 40) AS query FROM (SELECT doc_id, text, unnest([0, 1, 2]) AS i FROM documents)"""
PARTS["benchmark_queries"] = "SELECT item_id AS query_id, text AS query FROM benchmark"


def tokens(expr: str) -> str:
    return f"regexp_split_to_array(lower({expr}), '{SPACE}+')"


def retrieval_parts(chunks: str, queries: str) -> dict[str, str]:
    """Word counts, BM25, lexical and dense lists, fusion and rerank over one corpus."""
    return {
        "chunks": f"SELECT * FROM {chunks}",
        "queries": f"SELECT * FROM {queries}",
        "words": f"""
SELECT id, t AS term, count(*) AS tf FROM (SELECT id, unnest({tokens('text')}) AS t FROM chunks)
WHERE t <> '' GROUP BY ALL""",
        "asked": f"""
SELECT query_id, t AS term, count(*) AS qtf FROM (SELECT query_id, unnest({tokens('query')}) AS t FROM queries)
WHERE t <> '' GROUP BY ALL""",
        "lengths": """
SELECT chunks.id, coalesce(sum(tf), 0) AS len FROM chunks LEFT JOIN words USING (id) GROUP BY ALL""",
        "corpus_stats": "SELECT count(*) AS n, avg(len) AS avg_len FROM lengths",
        "raw_idf": """
SELECT term, count(*) AS doc_freq, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS raw
FROM words, corpus_stats GROUP BY term, n""",
        "idf": """
SELECT term, doc_freq, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw_idf) ELSE raw END AS idf
FROM raw_idf""",
        "bm25_scores": """
SELECT query_id, words.id,
  sum(CAST(round(qtf * idf * (tf * 2.5 / (tf + 1.5 * (1 - CAST(0.75 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len / avg_len))) / CAST(1e-12 AS DOUBLE)) AS HUGEINT)) / CAST(1e12 AS DOUBLE) AS score
FROM asked JOIN words USING (term) JOIN idf USING (term) JOIN lengths ON lengths.id = words.id, corpus_stats
GROUP BY ALL""",
        "bm25_list": """
SELECT query_id, id, round(coalesce(score, 0), 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY coalesce(score, 0) DESC, doc_order, chunk_offset) AS rank
FROM (SELECT query_id, id, doc_order, chunk_offset FROM queries, chunks) LEFT JOIN bm25_scores USING (query_id, id)
QUALIFY rank <= 10""",
        "shared": """
SELECT query_id, words.id, count(*) AS shared FROM asked JOIN words USING (term) GROUP BY ALL""",
        "lexical_list": """
SELECT query_id, id, coalesce(shared, 0) + CAST(0.1 AS DOUBLE) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY coalesce(shared, 0) DESC, doc_order, chunk_offset) AS rank
FROM (SELECT query_id, id, doc_order, chunk_offset FROM queries, chunks) LEFT JOIN shared USING (query_id, id)
QUALIFY rank <= 10""",
        "buckets": """
SELECT term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS bucket
FROM (SELECT DISTINCT term FROM words UNION SELECT DISTINCT term FROM asked)""",
        "chunk_counts": "SELECT id, bucket, sum(tf) AS cnt FROM words JOIN buckets USING (term) GROUP BY ALL",
        "chunk_vectors": """
SELECT id, bucket, CAST(CAST(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS x
FROM chunk_counts""",
        "query_vectors": """
SELECT query_id, bucket, CAST(CAST(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY query_id)) AS FLOAT) AS DOUBLE) AS y
FROM (SELECT query_id, bucket, sum(qtf) AS cnt FROM asked JOIN buckets USING (term) GROUP BY ALL)""",
        "chunk_lists": """
SELECT p.id, doc_order, chunk_offset, list(coalesce(x, 0) ORDER BY place) AS xs
FROM (SELECT id, doc_order, chunk_offset, unnest(range(64)) AS place FROM chunks) p
LEFT JOIN chunk_vectors v ON v.id = p.id AND v.bucket = p.place GROUP BY ALL""",
        "query_lists": """
SELECT p.query_id, list(coalesce(y, 0) ORDER BY place) AS ys FROM (SELECT query_id, unnest(range(64)) AS place FROM queries) p
LEFT JOIN query_vectors v ON v.query_id = p.query_id AND v.bucket = p.place GROUP BY ALL""",
        "apart": "SELECT query_id, id, doc_order, chunk_offset, xs, ys, list_distance(xs, ys) AS d FROM chunk_lists, query_lists",
        "reach": "SELECT query_id, max(d) AS far FROM (SELECT query_id, d FROM apart QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d) <= 10) GROUP BY query_id",
        "distances": """
SELECT query_id, id, doc_order, chunk_offset, list_sum(list_transform(range(1, 65), lambda i: (xs[i] - ys[i]) * (xs[i] - ys[i]))) AS distance
FROM apart JOIN reach USING (query_id) WHERE d <= far + CAST(0.000001 AS DOUBLE)""",
        "dense_list": """
SELECT query_id, id, distance,
  row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_order, chunk_offset) AS rank
FROM distances QUALIFY rank <= 10""",
        "paired": """
SELECT query_id, id, d.rank AS d_rank, b.rank AS b_rank,
  coalesce(CAST(1 AS DOUBLE) / (60 + d.rank), 0) + coalesce(CAST(1 AS DOUBLE) / (60 + b.rank), 0) AS rrf_score
FROM dense_list d FULL JOIN bm25_list b USING (query_id, id)""",
        "fused": """
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, id) AS rank
FROM paired QUALIFY rank <= 10""",
    }


RERANK = """
SELECT query_id, id, f.rrf_score + coalesce(shared, 0) * 0.1 AS cross_encoder_score,
  row_number() OVER (PARTITION BY query_id
    ORDER BY f.rrf_score + coalesce(shared, 0) * CAST(0.1 AS DOUBLE) DESC, id) AS rank
FROM {} f LEFT JOIN shared USING (query_id, id) QUALIFY rank <= 5"""
RETRIEVAL_EXTRA = {
    "reranked": RERANK.format("(SELECT query_id, id, rrf_score FROM fused)"),
    "lexical_candidates": "SELECT query_id, id, score AS rrf_score FROM lexical_list",
    "lexical_hits": "SELECT * FROM lexical_candidates WHERE rrf_score > CAST(0.1 AS DOUBLE)",
    "lexical_reranked": RERANK.format("lexical_candidates"),
    "hits_reranked": RERANK.format("lexical_hits"),
}


def plain(expr: str) -> str:
    return rf"regexp_replace(CAST(CAST({expr} AS DECIMAL(20, 4)) AS VARCHAR), '(\.\d+?)0+$', '\1')"


def answer_sql(top: str) -> str:
    return f"""
SELECT query_id, query,
  'Based on historical resolution data for query ''' || query || ''':' || chr(10) || chr(10)
  || 'Relevant support cases were identified under Category ''' || any_value(issue_category) FILTER (rank = 1)
  || ''' handled by Agent ' || any_value(assigned_agent) FILTER (rank = 1) || '. Key context: "'
  || left(any_value(text) FILTER (rank = 1), 250) || '..."' || chr(10) || chr(10) || 'Source Citations:' || chr(10)
  || string_agg('  - [' || rank || '] Ticket ID: ' || ticket_id || ' | Category: ' || issue_category
      || ' | Agent: ' || assigned_agent || ' (Relevance Score: ' || {plain('round(cross_encoder_score, 4)')} || ')',
      chr(10) ORDER BY rank) AS answer,
  count(*) AS n_citations
FROM {top} JOIN chunks USING (id) JOIN queries USING (query_id) GROUP BY query_id, query"""


def digest(keep: str, source: str = "chunks") -> str:
    return f"""
SELECT {keep}, count(bucket) AS n_filled, round(coalesce(sum(x * x), 0), 4) AS squares,
  round(coalesce(sum(x * (bucket + 1)), 0), 4) AS weighed
FROM {source} LEFT JOIN chunk_vectors USING (id) GROUP BY ALL"""


STAMP = "'2025-01-01 00:00:00'"
GOLD_CATEGORY = """
SELECT "Issue_Category", "Priority_Level", count("Ticket_ID") AS total_tickets,
  round(avg("Satisfaction_Score"), 2) AS avg_satisfaction_score,
  round(avg("Resolution_Time_Hours"), 1) AS avg_resolution_hours
FROM silver GROUP BY ALL"""
BY_DOCUMENTS = ("doc_chunks", "benchmark_queries")
BY_TICKETS = ("ticket_chunks", "subject_queries")


def _final() -> dict[str, tuple[str, tuple[str, str] | None]]:
    """The last SELECT of each query, and the corpus and queries it searches."""
    plain_sql = {
        "scan_csv_roundtrip": "SELECT seq, "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS.split(", "))
        + " FROM tickets",
        "produce_counts": f"""
SELECT count(*) FILTER (strlen(m) <= 2000) AS produced, count(*) FILTER (strlen(m) > 2000) AS failed, 'success' AS status
FROM (SELECT {MESSAGE} AS m FROM tickets)""",
        "pipeline_topics": """
SELECT 'valid' AS topic, "Ticket_ID" AS ticket_id, NULL AS rejection_reason FROM valid WHERE seq % 211 <> 0
UNION ALL
SELECT 'dlq', NULL, CASE WHEN seq % 211 = 0 THEN 'Record is not a JSON object' ELSE rejection_reason END
FROM judged WHERE rejection_reason IS NOT NULL OR seq % 211 = 0""",
        "ingest_run_totals": """
SELECT CAST(1 + seq % 3 AS BIGINT) AS run, count(*) AS total_processed, count(*) FILTER (rejection_reason IS NULL) AS valid_count,
  count(rejection_reason) AS invalid_count FROM judged GROUP BY ALL""",
        "pipeline_csv_faults": f"""
WITH cells AS (SELECT *, coalesce("Ticket_ID", '') AS id, "Priority_Level" AS level FROM tickets),
lines AS (SELECT *, CASE WHEN seq % 2 = 0 THEN id || ',' || "Customer_Name" || ',' || "Issue_Category" || ',' || level
  ELSE level || ',' || id || ',' || "Customer_Name" END AS line, {CSV_REASON} AS reason FROM cells),
bent AS (SELECT *, CASE WHEN seq % 10 IN (2, 3) THEN line || ',EXTRA' WHEN seq % 10 IN (6, 7) THEN regexp_replace(line, ',[^,]*$', '') END AS malformed FROM lines)
SELECT CASE WHEN malformed IS NULL AND reason IS NULL THEN 'VALID' ELSE 'QUARANTINED' END AS outcome,
  CASE WHEN malformed IS NULL AND reason IS NULL THEN "Ticket_ID" END AS "Ticket_ID",
  CASE WHEN malformed IS NULL AND reason IS NULL THEN "Customer_Name" END AS "Customer_Name",
  CASE WHEN malformed IS NULL AND reason IS NULL AND seq % 2 = 0 THEN "Issue_Category" END AS "Issue_Category",
  CASE WHEN malformed IS NULL AND reason IS NULL THEN CASE WHEN level = '' THEN 'Medium' ELSE level END END AS "Priority_Level",
  malformed AS line, CASE WHEN malformed IS NOT NULL THEN 'Record is not a JSON object' ELSE reason END AS rejection_reason
FROM bent""",
        "stream_validate_valid": "SELECT * FROM valid WHERE seq % 211 <> 0",
        "stream_validate_dlq": f"""
SELECT raw_record, CASE WHEN seq % 211 = 0 THEN 'Record is not a JSON object' ELSE rejection_reason END
  AS rejection_reason, 'QUARANTINED' AS status
FROM (SELECT seq, rejection_reason, CASE WHEN seq % 211 = 0 THEN left(m, length(m) // 2) ELSE m END AS raw_record
      FROM (SELECT *, {MESSAGE} AS m FROM judged))
WHERE rejection_reason IS NOT NULL OR seq % 211 = 0""",
        "scan_csv_malformed": """
SELECT CASE WHEN seq % 10 = 3 THEN line || ',EXTRA' WHEN seq % 10 = 7 THEN regexp_replace(line, ',[^,]*$', '') END AS malformed,
  CASE WHEN seq % 10 NOT IN (3, 7) THEN seq END AS seq,
  CASE WHEN seq % 10 NOT IN (3, 7) THEN "Ticket_ID" END AS "Ticket_ID",
  CASE WHEN seq % 10 NOT IN (3, 7) THEN "Issue_Category" END AS "Issue_Category",
  CASE WHEN seq % 10 NOT IN (3, 7) THEN nullif("Priority_Level", '') END AS "Priority_Level"
FROM (SELECT *, seq || ',' || coalesce("Ticket_ID", '') || ',' || "Issue_Category" || ',' || "Priority_Level" AS line FROM tickets)""",
        "ingest_fallback_runs": "SELECT * FROM valid",
        "inject_faults": f"""
WITH drawn AS (SELECT *, md5(seq || ':42') AS m FROM tickets),
spoilt AS (SELECT *, CASE WHEN ('0x' || m[1:8])::BIGINT % 10000 < 500 THEN
  CASE ('0x' || m[9:16])::BIGINT % 4 WHEN 0 THEN 'missing_id' WHEN 1 THEN 'missing_name' WHEN 2 THEN 'bad_score'
    ELSE 'invalid_priority' END END AS fault FROM drawn)
SELECT seq, fault, {RAW_COLUMNS} FROM (SELECT * REPLACE (
  CASE WHEN fault = 'missing_id' THEN NULL ELSE "Ticket_ID" END AS "Ticket_ID",
  CASE WHEN fault = 'missing_name' THEN NULL ELSE "Customer_Name" END AS "Customer_Name",
  CASE WHEN fault = 'bad_score' THEN '99' ELSE "Satisfaction_Score" END AS "Satisfaction_Score",
  CASE WHEN fault = 'invalid_priority' THEN 'Urgent_NonStandard' ELSE "Priority_Level" END AS "Priority_Level") FROM spoilt)""",
        "pipeline_rerun": f"""
WITH late AS (SELECT * REPLACE (seq - 1000000000 AS seq, 6 - "Satisfaction_Score" AS "Satisfaction_Score")
  FROM (SELECT {TYPED} FROM judged_again WHERE rejection_reason IS NULL)
  QUALIFY row_number() OVER (PARTITION BY "Ticket_ID" ORDER BY seq DESC) = 1)
SELECT *, {STAMP} AS _ingestion_time, 'kaggle_crm_customer_tickets' AS _data_source, {STAMP} AS _processed_time
FROM (SELECT * FROM silver WHERE "Ticket_ID" NOT IN (SELECT "Ticket_ID" FROM late) UNION ALL SELECT * FROM late)""",
        "validate_dlq_extra_columns": f"""
SELECT seq, {MESSAGE.replace("'_seq', seq", "'note', 'n' || (seq % 7), 'size', seq % 5")} AS raw_record, rejection_reason, 'QUARANTINED' AS status
FROM judged WHERE rejection_reason IS NOT NULL""",
        "dense_topk_gaps": """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings),
far AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list((c.x - q.x) * (c.x - q.x) ORDER BY place)) AS d
  FROM parts q JOIN parts c USING (place)
  WHERE q.vec_id % 100 = 1 AND c.vec_id % 17 <> 0 AND c.vec_id % 19 <> 0 AND c.vec_id % 23 <> 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS INTEGER) AS rank,
  vec_id, round(d, 6) AS distance FROM far QUALIFY rank <= 10""",
        "contract_rename": f"""
SELECT seq, {RAW_COLUMNS} FROM tickets""",
        "contract_required": f"""
SELECT seq, {strip('"Ticket_ID"')} AS value, {required_error('"Ticket_ID"', 'ticket_id')} AS error FROM cases""",
        "contract_priority": f"""
SELECT seq, value, {priority_error('value')} AS error
FROM (SELECT seq, {priority_value('"Priority_Level"')} AS value FROM cases)""",
        "contract_hours": f"""
SELECT seq, {number('"Resolution_Time_Hours"')} AS value, {hours_error('"Resolution_Time_Hours"')} AS error
FROM cases""",
        "contract_score": f"""
SELECT seq, {score_value('"Satisfaction_Score"')} AS value, {score_error('"Satisfaction_Score"')} AS error
FROM cases""",
        "contract_reasons": "SELECT seq, "
        + reason(
            {
                "Ticket_ID": required_error('"Ticket_ID"', "ticket_id"),
                "Customer_Name": required_error('"Customer_Name"', "customer_name"),
                "Priority_Level": priority_error(f"({priority_value(chr(34) + 'Priority_Level' + chr(34))})"),
                "Resolution_Time_Hours": hours_error('"Resolution_Time_Hours"'),
                "Satisfaction_Score": score_error('"Satisfaction_Score"'),
            }
        )
        + " AS rejection_reason FROM cases",
        "contract_types": """
SELECT k AS seq, CAST(k AS VARCHAR) AS "Ticket_ID", 'C' || c AS "Customer_Name",
  CASE WHEN email = '"text"' THEN 'text' END AS "Customer_Email",
  CASE level WHEN 'null' THEN 'Medium' WHEN 'true' THEN 'True' WHEN '"text"' THEN 'text' WHEN '{"y": 1}' THEN '{"y":1}' ELSE level END AS "Priority_Level",
  CASE spent WHEN '7' THEN 7.0::DOUBLE WHEN 'true' THEN 1.0 END AS "Resolution_Time_Hours",
  CASE score WHEN 'true' THEN 1.0::DOUBLE END AS "Satisfaction_Score",
  nullif(concat_ws(' | ',
    CASE WHEN email IN ('7', 'true', '["x"]', '{"y": 1}') THEN 'Customer_Email: Input should be a valid string' END,
    CASE WHEN level <> 'null' THEN 'Priority_Level: Value error, Priority_Level '''
      || CASE level WHEN 'true' THEN 'True' WHEN '"text"' THEN 'text' WHEN '{"y": 1}' THEN '{"y":1}' ELSE level END
      || ''' not in allowed values: [''Low'', ''Medium'', ''High'', ''Critical'']' END,
    CASE WHEN spent IN ('["x"]', '{"y": 1}') THEN 'Resolution_Time_Hours: Input should be a valid number'
      WHEN spent = '"text"' THEN
      'Resolution_Time_Hours: Input should be a valid number, unable to parse string as a number' END,
    CASE WHEN score NOT IN ('null', 'true') THEN 'Satisfaction_Score: Value error, Invalid satisfaction score: '
      || CASE score WHEN '"text"' THEN 'text' WHEN '{"y": 1}' THEN '{"y":1}' ELSE score END END
  ), '') AS rejection_reason
FROM typed_values""",
        "validate_valid": "SELECT * FROM valid",
        "validate_dlq": f"""
SELECT seq, {ENVELOPE} AS raw_record, rejection_reason, 'QUARANTINED' AS status
FROM judged WHERE rejection_reason IS NOT NULL""",
        "validate_summary": """
SELECT count(*) AS total_processed, count(*) FILTER (rejection_reason IS NULL) AS valid_count,
  count(rejection_reason) AS invalid_count FROM judged""",
        "dlq_sample": """
SELECT seq, coalesce("Ticket_ID", 'N/A') AS ticket_id, rejection_reason
FROM judged WHERE rejection_reason IS NOT NULL ORDER BY seq LIMIT 5""",
        "bronze_load": f"""
SELECT *, {STAMP} AS _ingestion_time, 'kaggle_crm_customer_tickets' AS _data_source FROM valid""",
        "silver_bootstrap": f"""
SELECT seq, {RAW_COLUMNS}, {STAMP} AS _ingestion_time, 'kaggle_crm_customer_tickets' AS _data_source,
  {STAMP} AS _processed_time FROM silver""",
        "silver_merge": f"""
WITH target AS (SELECT seq, {RAW_COLUMNS} FROM unvalidated WHERE "Submission_Date" < '1998-01-01'),
late AS (SELECT seq, {RAW_COLUMNS} FROM (SELECT * REPLACE (6 - "Satisfaction_Score" AS "Satisfaction_Score")
  FROM unvalidated) WHERE "Submission_Date" >= '1996-01-01'),
source AS (SELECT * FROM late QUALIFY "Ticket_ID" IS NULL
  OR row_number() OVER (PARTITION BY "Ticket_ID" ORDER BY seq DESC) = 1)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s."Ticket_ID" = t."Ticket_ID")
UNION ALL SELECT * FROM source""",
        "dedup_keep_last": f"""
SELECT seq, {RAW_COLUMNS} FROM tickets
QUALIFY row_number() OVER (PARTITION BY "Ticket_ID" ORDER BY seq DESC) = 1""",
        "schema_enforcement": """
SELECT attempt, refused, n * times AS rows_after FROM (SELECT count(*) AS n FROM silver),
(VALUES ('extra_column', true, 1), ('changed_type', true, 1), ('missing_column', false, 2),
  ('same_columns', false, 3)) AS a(attempt, refused, times)""",
        "gold_category": GOLD_CATEGORY,
        "gold_category_ranked": GOLD_CATEGORY
        + ' ORDER BY total_tickets DESC, "Issue_Category", "Priority_Level"',
        "gold_agent": """
SELECT "Assigned_Agent", count("Ticket_ID") AS total_assigned,
  round(avg("Satisfaction_Score"), 2) AS avg_satisfaction,
  round(avg("Resolution_Time_Hours"), 1) AS avg_resolution_hours
FROM silver GROUP BY ALL""",
        "gold_sla": """
SELECT "Issue_Category", count("Ticket_ID") AS total_tickets,
  count(*) FILTER ("Resolution_Time_Hours" > 24) AS sla_breached_tickets,
  round(count(*) FILTER ("Resolution_Time_Hours" > 24) / CAST(nullif(count("Ticket_ID"), 0) AS DOUBLE) * 100, 1)
    AS sla_breach_pct
FROM silver GROUP BY ALL""",
        "layer_counts": """
SELECT 'bronze' AS layer, count(*) AS row_count FROM valid
UNION ALL SELECT 'quarantine', count(*) FROM judged WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_category', count(*) FROM (SELECT DISTINCT "Issue_Category", "Priority_Level" FROM silver)
UNION ALL SELECT 'gold_agent', count(DISTINCT "Assigned_Agent") FROM silver
UNION ALL SELECT 'gold_sla', count(DISTINCT "Issue_Category") FROM silver""",
        "quality_report": "SELECT dataset, expectation, unexpected_count = 0 AS success, unexpected_count FROM checks",
        "quality_score": """
SELECT dataset, count(*) FILTER (unexpected_count = 0) / CAST(count(*) AS DOUBLE) AS quality_score,
  any_value(total) AS total_records, count(*) FILTER (unexpected_count = 0) AS passed_checks,
  count(*) AS total_checks FROM checks GROUP BY dataset""",
        "quality_gate_status": """
SELECT dataset, CASE WHEN avg(CASE WHEN unexpected_count = 0 THEN 1 ELSE 0 END) < 0.8
  THEN 'HALTED' ELSE 'PASSED' END AS gate FROM checks GROUP BY dataset""",
        "quality_gate_empty": """
SELECT 'empty' AS dataset, CASE WHEN count(*) = 0 THEN 'HALTED' ELSE 'PASSED' END AS gate
FROM tickets WHERE "Submission_Date" IS NULL""",
        "lineage_events": """
SELECT event_type, happened AS event_time, run_id, 'ticketlake-pipeline/job_' || stage AS job,
  'ticketlake/' || replace(ins, ',', ',ticketlake/') AS inputs,
  'ticketlake/' || replace(outs, ',', ',ticketlake/') AS outputs, 'ticketlake' AS producer
FROM run_events""",
        "lineage_states": "SELECT event_type, count(*) AS n FROM run_events GROUP BY event_type",
        "lineage_run_status": "SELECT run_id, 'job_' || stage AS job, happened AS started, ended AS status FROM runs",
        "lineage_edges": """
SELECT 'job_' || stage AS job, input, output, count(*) AS runs
FROM (SELECT stage, input, unnest(string_split(outs, ',')) AS output
      FROM (SELECT stage, outs, unnest(string_split(ins, ',')) AS input FROM runs WHERE ended = 'COMPLETE'))
GROUP BY ALL""",
        "rag_ticket_text": """
SELECT doc_order, ticket_id, customer_name, issue_category, assigned_agent, satisfaction_score,
  'Ticket ID: ' || ticket_id || ' | Customer: ' || customer_name || ' | Category: ' || issue_category
  || ' | Subject: ' || subject || ' | Agent: ' || assigned_agent || ' | Satisfaction: ' || satisfaction_score
  || ' | Description: ' || description AS full_text
FROM (SELECT seq AS doc_order, coalesce("Ticket_ID", 'TKT-' || seq) AS ticket_id,
    coalesce(nullif("Customer_Name", ''), 'Unknown') AS customer_name,
    coalesce(nullif("Issue_Category", ''), 'General Inquiry') AS issue_category,
    coalesce(nullif("Ticket_Subject", ''), 'General Support') AS subject,
    coalesce(nullif("Ticket_Description", ''), 'No description provided.') AS description,
    coalesce(nullif("Assigned_Agent", ''), 'Unassigned') AS assigned_agent,
    coalesce(nullif("Satisfaction_Score", ''), '5') AS satisfaction_score FROM tickets)""",
        "rag_chunks": """
SELECT id, doc_order, ticket_id, issue_category, assigned_agent, chunk_offset, text,
  'Delta_Gold_Layer' AS source FROM doc_chunks""",
        "rag_tokens": f"""
SELECT id, CAST(len(list_filter(t, lambda x: x <> '')) AS INTEGER) AS n_terms,
  array_to_string(list_filter(t, lambda x: x <> ''), ' ') AS terms
FROM (SELECT id, {tokens('text')} AS t FROM doc_chunks)""",
        "dense_topk": """
WITH means AS (
  SELECT label, place, avg(x) AS y
  FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings)
  GROUP BY label, place),
parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings),
far AS (
  SELECT means.label, vec_id, list_sum(list((x - y) * (x - y) ORDER BY place)) AS d
  FROM parts JOIN means USING (place) GROUP BY ALL)
SELECT CAST(label AS BIGINT) AS query_id, CAST(row_number() OVER (PARTITION BY label ORDER BY d, vec_id) AS INTEGER) AS rank,
  vec_id, round(d, 6) AS distance FROM far QUALIFY rank <= 10""",
    }
    listed = "SELECT query_id, CAST(rank AS INTEGER) AS rank, id, {} FROM {}"
    reranked = listed.format("round(cross_encoder_score, 6) AS cross_encoder_score", "{}")
    searches = {
        "bm25_term_stats": ("SELECT term, doc_freq, round(idf, 6) AS idf FROM idf", BY_DOCUMENTS),
        "bm25_topk": (listed.format("score", "bm25_list"), BY_DOCUMENTS),
        "bm25_topk_many": (listed.format("score", "bm25_list"), ("doc_chunks", "slice_queries")),
        "index_dense_topk": (listed.format("round(distance, 6) AS distance", "dense_list"), BY_DOCUMENTS),
        "index_upkeep": (
            """
SELECT 'dense' AS method, query_id, CAST(rank AS INTEGER) AS rank, id FROM dense_list
UNION ALL SELECT 'bm25', query_id, CAST(rank AS INTEGER), id FROM bm25_list""",
            BY_DOCUMENTS,
        ),
        "answer_top_documents": (
            """
SELECT query_id, rank - 1 AS place, id, text, round(rrf_score, 6) AS rrf_score, CAST(coalesce(d_rank, 999) AS INTEGER) AS dense_rank,
  CAST(coalesce(b_rank, 999) AS INTEGER) AS bm25_rank, round(cross_encoder_score, 6) AS cross_encoder_score
FROM reranked JOIN (SELECT query_id, id, rrf_score, d_rank, b_rank FROM fused) USING (query_id, id) JOIN chunks USING (id)""",
            BY_DOCUMENTS,
        ),
        "lexical_topk": (listed.format("round(score, 6) AS score", "lexical_list"), BY_DOCUMENTS),
        "embed_hashing": (digest("id"), BY_DOCUMENTS),
        "vector_index": (digest("id, ticket_id, issue_category, assigned_agent"), BY_DOCUMENTS),
        "rrf_fusion": (
            listed.format(
                "CAST(coalesce(d_rank, 999) AS INTEGER) AS dense_rank, "
                "CAST(coalesce(b_rank, 999) AS INTEGER) AS bm25_rank, round(rrf_score, 6) AS rrf_score",
                "fused",
            ),
            BY_DOCUMENTS,
        ),
        "rerank_overlap": (reranked.format("reranked"), BY_DOCUMENTS),
        "rerank_udf": (
            """
SELECT query_id, id, round(s, 6) AS cross_encoder_score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER) AS rank
FROM (SELECT query_id, id, coalesce(shared, 0) / CAST(n AS DOUBLE) AS s FROM fused LEFT JOIN shared USING (query_id, id)
      JOIN (SELECT query_id, count(*) AS n FROM asked GROUP BY query_id) USING (query_id))
QUALIFY rank <= 5""",
            BY_DOCUMENTS,
        ),
        "answer_fallback": (
            """
SELECT query_id, '[' || rank || ']' AS citation_id, id, ticket_id, round(score, 4) AS relevance_score
FROM (SELECT query_id, rank, id, cross_encoder_score AS score FROM hits_reranked
      UNION ALL
      SELECT query_id, rank, id, CAST(0.5 AS DOUBLE) FROM queries,
        (SELECT id, row_number() OVER (ORDER BY doc_order, chunk_offset) AS rank FROM chunks QUALIFY rank <= 5)
      WHERE query_id NOT IN (SELECT query_id FROM hits_reranked))
JOIN chunks USING (id)""",
            ("doc_chunks", "subject_queries"),
        ),
        "citations": (
            """
SELECT query_id, '[' || rank || ']' AS citation_id, ticket_id, customer_name, issue_category, assigned_agent,
  round(cross_encoder_score, 4) AS relevance_score FROM lexical_reranked JOIN chunks USING (id)""",
            BY_TICKETS,
        ),
        "grounded_answer": (answer_sql("lexical_reranked"), BY_TICKETS),
        "hybrid_answer": (answer_sql("reranked"), BY_TICKETS),
        "pipeline_summary": (
            """
SELECT (SELECT count(*) FROM tickets) AS produced, (SELECT count(*) FROM tickets) AS total_processed,
  (SELECT count(*) FROM valid) AS valid_count,
  (SELECT count(rejection_reason) FROM judged) AS invalid_count,
  (SELECT count(*) FROM valid) AS bronze_count, (SELECT count(*) FROM silver) AS silver_count,
  true AS schema_enforcement_verified, 'PASSED' AS quality_status, CAST(1 AS DOUBLE) AS quality_score,
  (SELECT count(*) FROM (SELECT DISTINCT "Issue_Category", "Priority_Level" FROM silver)) AS gold_category_count,
  (SELECT count(DISTINCT "Assigned_Agent") FROM silver) AS gold_agent_count,
  (SELECT count(DISTINCT "Issue_Category") FROM silver) AS gold_sla_count,
  (SELECT count(*) FROM chunks) AS documents_count, 5 * (SELECT count(*) FROM queries) AS citations_count""",
            BY_TICKETS,
        ),
    }
    return {name: (sql, None) for name, sql in plain_sql.items()} | searches


SHARED = {"words", "raw_idf", "judged", "tickets"}


def _needed(sql: str, parts: dict[str, str], found: dict[str, None]) -> None:
    """Collect the parts a statement names, each after the parts it builds on."""
    for name in parts:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(parts[name], {k: v for k, v in parts.items() if k != name}, found)
            found[name] = None


def queries() -> dict[str, str]:
    result = {}
    for name, (sql, corpus) in _final().items():
        parts = dict(PARTS)
        if corpus:
            parts |= retrieval_parts(*corpus) | RETRIEVAL_EXTRA
        found: dict[str, None] = {}
        _needed(sql, parts, found)
        # what several parts build on is computed once
        heads = [f"{part} AS {'MATERIALIZED ' if part in SHARED else ''}({parts[part]})" for part in found]
        sql = sql.strip()
        if sql.startswith("WITH "):
            heads.append(sql[len("WITH "):])
            result[name] = "WITH " + ",\n".join(heads)
        else:
            result[name] = ("WITH " + ",\n".join(heads) + "\n" if heads else "") + sql
    return result
