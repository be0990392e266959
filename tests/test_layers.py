"""Gold measures, the quality gate, lineage and the whole pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import layers, lineage, quality
from ticketlake.plans.pipeline import run_pipeline, summary_frame
from ticketlake.sources.synthetic import generate_tickets
from ticketlake.sources.tables import VersionedTable

TICKETS = (
    "Ticket_ID string, Customer_Name string, Issue_Category string, Priority_Level string, "
    "Assigned_Agent string, Resolution_Time_Hours double, Satisfaction_Score double"
)


@pytest.fixture
def silver(spark):
    rows = [
        ("1", "a", "Billing", "Low", "x", 24.0, 1.0),
        ("2", "b", "Billing", "Low", "x", 24.5, 2.0),
        ("3", "c", "Billing", "High", None, None, None),
        (None, "d", None, "Low", "y", 100.0, 4.0),
    ]
    return spark.createDataFrame(rows, TICKETS)


def test_gold(silver):
    category = {(r[0], r[1]): tuple(r)[2:] for r in layers.gold_category(silver).collect()}
    # a null id is not counted, a null category is a group, half rounds up
    assert category == {
        ("Billing", "Low"): (2, 1.5, 24.3),
        ("Billing", "High"): (1, None, None),
        (None, "Low"): (0, 4.0, 100.0),
    }
    sla = {r[0]: tuple(r)[1:] for r in layers.gold_sla(silver).collect()}
    # exactly 24 hours is no breach, and a group without ids has no percentage
    assert sla == {"Billing": (3, 1, 33.3), None: (0, 1, None)}
    agents = {r[0]: r.total_assigned for r in layers.gold_agent(silver).collect()}
    assert agents == {"x": 2, None: 1, "y": 0}


def test_ranked(silver):
    assert [r.total_tickets for r in layers.ranked("gold_category", layers.gold_category(silver)).collect()] == [2, 1, 0]


def test_bronze_and_silver_stamps(spark, folder, silver):
    now = dt.datetime(2025, 5, 1)
    rows = layers.bronze(silver.withColumn("seq", F.lit(1)), now)
    made = layers.merge_silver(VersionedTable(spark, folder + "/s"), rows, "seq", now).first()
    assert made._ingestion_time == made._processed_time == now
    assert made._data_source == "kaggle_crm_customer_tickets"
    assert layers.schema_enforced(VersionedTable(spark, folder + "/s"))


def checks(df):
    return [(r.success, r.unexpected_count) for r in quality.report(df).collect()]


def test_quality_counts(spark, silver):
    assert checks(silver) == [(False, 1), (True, 0), (True, 0), (True, 0)]
    double = silver.unionByName(silver).withColumn("Satisfaction_Score", F.lit(9.0))
    # four repeats: three ids and the null, which counts as one value
    assert checks(double) == [(False, 2), (True, 0), (False, 4), (False, 8)]
    assert checks(silver.drop("Satisfaction_Score"))[3] == (True, 0)


def test_gate(silver):
    clean = silver.where("Ticket_ID is not null")
    passed = quality.run_gate(clean)
    assert (passed["status"], passed["quality_score"], passed["total_records"]) == ("PASSED", 1.0, 3)
    with pytest.raises(quality.QualityGateError, match="75.00%"):
        quality.run_gate(silver)
    assert quality.run_gate(silver, threshold=0.75)["passed_checks"] == 3
    with pytest.raises(quality.QualityGateError, match="empty"):
        quality.run_gate(silver.limit(0))


def test_lineage_log_keeps_failures(spark, folder):
    log = lineage.LineageLog(spark, folder + "/l")
    with log.stage("silver"):
        pass
    with pytest.raises(ValueError):
        with log.stage("gold"):
            raise ValueError("no gold")
    log.emit("extra", "paused")
    log.flush()
    with log.stage("rag", ["a"], ["b", "c"]):
        pass
    log.flush()
    status = {r.job: r.status for r in lineage.run_status(log.read()).collect()}
    assert status == {"job_silver": "COMPLETE", "job_gold": "FAIL", "job_extra": "OTHER", "job_rag": "COMPLETE"}
    edges = {(r.input, r.output) for r in lineage.edges(log.read()).collect()}
    assert edges == {("delta_bronze", "delta_silver"), ("a", "b"), ("a", "c")}


def test_run_without_an_end(spark):
    runs = spark.createDataFrame([("1", "gold", dt.datetime(2025, 1, 1), "fail")], "run_id string, stage string, started timestamp, outcome string")
    started = lineage.events(runs).where("eventType = 'START'")
    assert lineage.run_status(started).first().status == "RUNNING"


def test_pipeline_runs_and_runs_again(spark, folder):
    tickets = generate_tickets(spark, 200, 0.1).drop("fault")
    first = run_pipeline(spark, folder, tickets=tickets)
    assert first["produce"] == {"produced": 200, "failed": 0, "status": "success"}
    assert first["validate"]["valid_count"] == 180 and first["validate"]["invalid_count"] == 20
    assert first["silver"]["silver_count"] == 180 and first["silver"]["schema_enforcement_verified"]
    assert first["quality"]["status"] == "PASSED"
    assert first["gold"]["gold_agent_count"] == 5
    assert first["rag"]["citations_count"] == 5
    assert "Hours of operation inquiry" in first["rag"]["answers"].first().answer
    assert summary_frame(spark, first).first().documents_count == 180
    # the same tickets again: upserted, not added
    second = run_pipeline(spark, folder, tickets=tickets)
    # a run's totals are its own
    assert second["validate"]["total_processed"] == 200 and second["bronze"]["bronze_count"] == 180
    assert first["rag"]["index_changes"] == {"new": 180, "changed": 0, "gone": 0, "chunked": 180}
    assert second["rag"]["index_changes"] == {"new": 0, "changed": 0, "gone": 0, "chunked": 0}
    assert second["silver"]["silver_count"] == 180
    log = lineage.LineageLog(spark, folder + "/lineage").read()
    assert lineage.run_status(log).groupBy("status").count().collect() == [("COMPLETE", 14)]


def test_silver_is_made_from_the_bronze_table(spark, folder, monkeypatch):
    """What bronze does not hold is not in silver, gold and the index either, and its stamps come from bronze."""
    given = VersionedTable.overwrite

    def overwrite(self, df, *options, **more):
        if self.path.endswith("/bronze"):
            df = df.where("Assigned_Agent <> 'David Kim'").withColumn("_data_source", F.lit("bronze"))
        return given(self, df, *options, **more)

    monkeypatch.setattr(VersionedTable, "overwrite", overwrite)
    result = run_pipeline(spark, folder, tickets=generate_tickets(spark, 100, 0.0).drop("fault"))
    tables = {n: VersionedTable(spark, f"{folder}/tables/{n}").read() for n in ("bronze", "silver", "gold_agent")}
    assert 0 < result["bronze"]["bronze_count"] == tables["bronze"].count() < result["validate"]["valid_count"]
    assert result["silver"]["silver_count"] == result["rag"]["documents_count"] == tables["bronze"].select("Ticket_ID").distinct().count()
    assert {r._data_source for r in tables["silver"].collect()} == {"bronze"} and "batch_id" not in tables["silver"].columns
    assert "David Kim" not in {r.Assigned_Agent for r in tables["gold_agent"].collect()}


def test_pipeline_takes_records_and_generates_by_default(spark, folder):
    records = [r.asDict() for r in generate_tickets(spark, 20, 0.0).drop("fault", "seq").collect()]
    assert run_pipeline(spark, folder + "/a", tickets=records)["silver"]["silver_count"] == 20
    assert run_pipeline(spark, folder + "/b", csv_path=folder + "/none.csv")["validate"]["valid_count"] == 95


def test_malformed_csv_lines_are_dead_letters_of_the_job(spark, folder):
    from pathlib import Path

    Path(folder, "in").mkdir()
    lines = ["Ticket_ID,Customer_Name,Priority_Level", *[f"T{i},Name {i},Low" for i in range(20)], "B1,Bob,Low,EXTRA", "B2", '{"Ticket_ID": "B3"}']
    Path(folder, "in", "a.csv").write_text("\n".join(lines) + "\n")
    result = run_pipeline(spark, folder + "/job", csv_path=folder + "/in")
    assert (result["validate"]["valid_count"], result["validate"]["invalid_count"]) == (20, 3)
    dead = spark.read.json(folder + "/job/ingest/quarantine").collect()
    assert {r.raw_record for r in dead} == {"B1,Bob,Low,EXTRA", "B2", '["{\\"Ticket_ID\\": \\"B3\\"}"]'}
    assert {r.rejection_reason for r in dead} == {"Record is not a JSON object"}


def test_gate_halts_the_pipeline(spark, folder):
    """All records rejected: silver is empty, nothing after the gate runs."""
    tickets = generate_tickets(spark, 10, 1.0).drop("fault")
    with pytest.raises(quality.QualityGateError):
        run_pipeline(spark, folder, tickets=tickets)
    status = {
        r.job: r.status for r in lineage.run_status(lineage.LineageLog(spark, folder + "/lineage").read()).collect()
    }
    assert status["job_quality_gate"] == "FAIL" and "job_gold" not in status
    assert not VersionedTable(spark, folder + "/tables/gold_sla").exists()
