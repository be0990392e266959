"""Rule tables of the ticket contract."""

import json

import pytest
from pyspark.sql import functions as F

from ticketlake.functions.contract import RULES, RawField
from ticketlake.operators import validate as V
from ticketlake.schema import COLUMNS, RAW_TICKET

EMPTY_ID = "Value error, Field 'ticket_id' cannot be empty or null"
BAD_NUMBER = "Input should be a valid number, unable to parse string as a number"


def levels(value):
    return f"Value error, Priority_Level '{value}' not in allowed values: ['Low', 'Medium', 'High', 'Critical']"


def bad_score(value):
    return f"Value error, Invalid satisfaction score: {value}"


CASES = {
    "Ticket_ID": [
        (" x ", "x", None), ("\t　TKT-1\n", "TKT-1", None), (" nan ", "nan", None),
        ("", "", EMPTY_ID), ("  ", "", EMPTY_ID), (None, None, EMPTY_ID),
        ("NaN", "NaN", EMPTY_ID), ("none", "none", EMPTY_ID),
    ],
    "Satisfaction_Score": [
        ("1", 1.0, None), ("5", 5.0, None), (" 4 ", 4.0, None), ("1.0", 1.0, None), ("1_0e-1", 1.0, None),
        (None, None, None), ("", None, None), ("nan", None, None), (" NaN ", None, None),
        ("0.999", None, bad_score("0.999")), ("5.001", None, bad_score("5.001")), ("99", None, bad_score("99")),
        ("abc", None, bad_score("abc")), ("  ", None, bad_score("  ")), ("4d", None, bad_score("4d")),
        ("inf", None, bad_score("inf")),
    ],
    "Priority_Level": [
        (None, "Medium", None), ("", "Medium", None), (" ", "Medium", None), (" Low ", "Low", None),
        ("Critical", "Critical", None), ("high", "high", levels("high")), ("URGENT", "URGENT", levels("URGENT")),
        ("nan", "nan", levels("nan")),
    ],
    "Resolution_Time_Hours": [
        ("12", 12.0, None), ("-3", -3.0, None), ("1_0", 10.0, None), (".5", 0.5, None), (None, None, None),
        ("nan", None, None), ("inf", float("inf"), None), ("-Infinity", float("-inf"), None),
        ("abc", None, BAD_NUMBER), ("", None, BAD_NUMBER), ("4d", None, BAD_NUMBER), ("1__0", None, BAD_NUMBER),
    ],
    "Ticket_Subject": [("any text", "any text", None), (None, None, None), ("", "", None)],
}


@pytest.mark.parametrize("column", CASES)
def test_rule(spark, column):
    rows = [(i, case[0]) for i, case in enumerate(CASES[column])]
    df = spark.createDataFrame(rows, "i int, raw string")
    rule, field = RULES[column], RawField(F.col("raw"), F.lit(True), F.lit("STRING"))
    valued = df.withColumn("value", rule.value(field))
    got = valued.withColumn("error", rule.error(field, F.col("value"))).orderBy("i").collect()
    assert [(r.raw, r.value, r.error) for r in got] == CASES[column]


def judge_json(spark, *values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return V.validate_json(df, keep=("i",), **options).orderBy("i").collect()


def test_json_absent_and_null_priority(spark):
    absent, null = judge_json(
        spark,
        '{"Ticket_ID": "a", "Customer_Name": "b"}',
        '{"Ticket_ID": "a", "Customer_Name": "b", "Priority_Level": null}',
    )
    assert absent.Priority_Level is None and absent.rejection_reason is None
    assert null.Priority_Level == "Medium" and null.rejection_reason is None


def test_json_missing_key_and_either_spelling(spark):
    missing, field_name, both = judge_json(
        spark,
        '{"Ticket_ID": "a"}',
        '{"ticket_id": "a", "customer_name": "b"}',
        '{"Ticket_ID": null, "ticket_id": "a", "Customer_Name": "b"}',
    )
    assert missing.rejection_reason == "Customer_Name: Field required"
    assert field_name.Ticket_ID == "a" and field_name.rejection_reason is None
    assert both.rejection_reason == f"Ticket_ID: {EMPTY_ID}"


def test_json_value_kinds(spark):
    start = '{"Ticket_ID": 5, "Customer_Name": "b", '
    number, truth, nested, score = judge_json(
        spark,
        start + '"Customer_Email": 7, "Resolution_Time_Hours": 1.50}',
        start + '"Resolution_Time_Hours": true, "Satisfaction_Score": true}',
        start + '"Ticket_Subject": {"a": 1}, "Resolution_Time_Hours": [1]}',
        start + '"Satisfaction_Score": 9.50}',
    )
    assert number.Ticket_ID == "5" and number.Resolution_Time_Hours == 1.5
    assert number.rejection_reason == "Customer_Email: Input should be a valid string"
    assert truth.rejection_reason is None and truth.Satisfaction_Score == 1.0
    assert nested.rejection_reason == (
        "Ticket_Subject: Input should be a valid string | "
        "Resolution_Time_Hours: Input should be a valid number"
    )
    assert score.rejection_reason == "Satisfaction_Score: " + bad_score("9.5")


@pytest.mark.parametrize("text", ["{bad", "[1, 2]", '"text"', "12", ""])
def test_json_that_is_no_record(spark, text):
    [row] = judge_json(spark, text)
    assert row.rejection_reason == "Record is not a JSON object" and row.raw_record == text


def test_bare_nan(spark):
    text = '{"Ticket_ID": "a", "Customer_Name": "b", "Ticket_Subject": NaN, "Priority_Level": NaN, "Satisfaction_Score": NaN}'
    [lenient] = judge_json(spark, text)
    assert lenient.rejection_reason is None and lenient.Priority_Level == "Medium"
    [compat] = judge_json(spark, text, nan_compat=True)
    assert compat.rejection_reason == (
        f"Ticket_Subject: Input should be a valid string | Priority_Level: {levels('nan')}"
    )


def ticket(**changes):
    row = dict.fromkeys(COLUMNS, "x") | {
        "Priority_Level": "Low", "Resolution_Time_Hours": "1", "Satisfaction_Score": "3",
        "Customer_Email": "a@b.c", "Issue_Category": "Billing", "Submission_Date": "2025-01-31",
    }
    return tuple((row | changes).values())


def test_empty_cells_of_a_table(spark):
    df = spark.createDataFrame([ticket(Ticket_Channel=None)], RAW_TICKET)
    assert V.validate_table(df).first().rejection_reason is None
    compat = V.validate_table(df, nan_compat=True).first()
    assert compat.rejection_reason == "Ticket_Channel: Input should be a valid string"


def test_absent_columns_of_a_table(spark):
    df = spark.createDataFrame([("a",)], "Ticket_ID string")
    row = V.validate_table(df).first()
    assert row.rejection_reason == "Customer_Name: Field required" and row.Priority_Level is None


def test_strict_is_opt_in(spark):
    odd = ticket(
        Customer_Email="nobody", Issue_Category="Other", Submission_Date="2025-02-30", Resolution_Time_Hours="-1"
    )
    df = spark.createDataFrame([odd, ticket()], RAW_TICKET)
    assert V.valid_tickets(V.validate_table(df)).count() == 2
    strict = V.validate_table(df, strict=True)
    assert V.valid_tickets(strict).count() == 1
    assert V.quarantine(strict).first().rejection_reason == (
        "Customer_Email: not an e-mail address | Issue_Category: not a known category | "
        "Submission_Date: not an ISO date | Resolution_Time_Hours: must not be negative"
    )


def test_split_is_complete(spark, sf):
    from ticketlake.plans.queries import judged

    rows = judged(spark, sf)
    counts = V.summary(rows).first()
    assert counts.valid_count + counts.invalid_count == counts.total_processed == rows.count()
    assert V.valid_tickets(rows).count() == counts.valid_count
    assert V.quarantine(rows).count() == counts.invalid_count


def test_quarantine_keeps_the_raw_record(spark):
    df = spark.createDataFrame([ticket(Ticket_ID=None)], RAW_TICKET)
    envelope = V.quarantine(V.validate_table(df)).first()
    assert envelope.status == "QUARANTINED"
    assert json.loads(envelope.raw_record) == dict(zip(COLUMNS, ticket(Ticket_ID=None)))
