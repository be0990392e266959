"""Bronze, silver and gold."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.operators.merge import dedup_keep_last
from ticketlake.schema import DATA_SOURCE
from ticketlake.sources.tables import SchemaMismatchError, VersionedTable

KEY = "Ticket_ID"
# long texts that tickets may have in common, and the columns that gold and the gate look at
TEXTS = ("Ticket_Description",)
MEASURED = [KEY, "Customer_Name", "Issue_Category", "Priority_Level", "Resolution_Time_Hours", "Assigned_Agent", "Satisfaction_Score"]

# --- fixed values: gold measures ---------------------------------------------
SLA_HOURS = 24
SCORE_DIGITS, HOURS_DIGITS, PERCENT_DIGITS = 2, 1, 1


def _clock(now: dt.datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now)


def bronze(tickets: DataFrame, now: dt.datetime | None = None, data_source: str = DATA_SOURCE) -> DataFrame:
    """Tickets with load time and source."""
    return tickets.withColumns({"_ingestion_time": _clock(now), "_data_source": F.lit(data_source)})


def stamp_silver(bronze_rows: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return bronze_rows.withColumn("_processed_time", _clock(now))


def merge_silver(
    silver: VersionedTable, bronze_rows: DataFrame, order: str | Column, now: dt.datetime | None = None, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Create silver from bronze, or upsert bronze into it by ticket id; ``drop`` names columns that only ``order`` needs."""
    incoming = stamp_silver(bronze_rows, now)
    if silver.exists():
        return silver.merge(incoming, KEY, order, drop=drop)
    if silver.key == KEY:
        return silver.overwrite(incoming, order, drop)
    return silver.overwrite(dedup_keep_last(incoming, KEY, order).drop(*drop))


def schema_enforced(table: VersionedTable) -> bool:
    """True when the table refuses rows with a column it does not know."""
    odd = table.read().withColumn("unexpected_extra_column", F.current_timestamp())
    try:
        table.append(odd)
        return False
    except SchemaMismatchError:
        return True


def _average(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def gold_category(silver: DataFrame) -> DataFrame:
    """Volume, score and hours per category and priority."""
    return silver.groupBy("Issue_Category", "Priority_Level").agg(
        F.count(KEY).alias("total_tickets"),
        _average("Satisfaction_Score", SCORE_DIGITS).alias("avg_satisfaction_score"),
        _average("Resolution_Time_Hours", HOURS_DIGITS).alias("avg_resolution_hours"),
    )


def gold_agent(silver: DataFrame) -> DataFrame:
    """Volume, score and hours per agent."""
    return silver.groupBy("Assigned_Agent").agg(
        F.count(KEY).alias("total_assigned"),
        _average("Satisfaction_Score", SCORE_DIGITS).alias("avg_satisfaction"),
        _average("Resolution_Time_Hours", HOURS_DIGITS).alias("avg_resolution_hours"),
    )


def gold_sla(silver: DataFrame) -> DataFrame:
    """Share of tickets per category that took longer than the agreed hours."""
    total = F.count(KEY)
    breached = F.count_if(F.col("Resolution_Time_Hours") > SLA_HOURS)
    return silver.groupBy("Issue_Category").agg(
        total.alias("total_tickets"),
        breached.alias("sla_breached_tickets"),
        F.round(F.try_divide(breached, total) * 100, PERCENT_DIGITS).alias("sla_breach_pct"),
    )


GOLD = {"gold_category": gold_category, "gold_agent": gold_agent, "gold_sla": gold_sla}
GOLD_ORDER = {
    "gold_category": ["total_tickets", "Issue_Category", "Priority_Level"],
    "gold_agent": ["total_assigned", "Assigned_Agent"],
    "gold_sla": ["total_tickets", "Issue_Category"],
}


def ranked(name: str, gold: DataFrame) -> DataFrame:
    """A gold table in report order, largest first. Sorted on reading: files keep no order."""
    measure, *keys = GOLD_ORDER[name]
    return gold.orderBy(F.desc(measure), *keys)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
