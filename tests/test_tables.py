"""Versioned tables, dedup, upsert and schema enforcement."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticketlake.operators.merge import DuplicateKeyError, dedup_keep_last, keep_last_late, merge_upsert
from ticketlake.sources.tables import SchemaMismatchError, VersionedTable

SCHEMA = "Ticket_ID string, v int, seq bigint"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, 1), ("b", 1, 2), (None, 1, 3)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", 2, 4), ("c", 2, 5), ("c", 3, 6), (None, 2, 7)], SCHEMA)


def test_dedup_keeps_the_last_row(spark, source):
    double = source.unionByName(spark.createDataFrame([(None, 9, 9)], SCHEMA))
    assert rows(dedup_keep_last(double, "Ticket_ID", "seq")) == [("b", 2, 4), ("c", 3, 6), (None, 9, 9)]


def test_merge(target, source):
    merged = rows(merge_upsert(target, source, "Ticket_ID", "seq"))
    assert merged == [("a", 1, 1), ("b", 2, 4), ("c", 3, 6), (None, 1, 3), (None, 2, 7)]


def test_merge_is_idempotent_for_keys(target, source):
    keyed = source.where("Ticket_ID is not null")
    once = merge_upsert(target, keyed, "Ticket_ID", "seq")
    assert rows(merge_upsert(once, keyed, "Ticket_ID", "seq")) == rows(once)


def test_merge_refuses_repeats_on_request(target, source):
    with pytest.raises(DuplicateKeyError):
        merge_upsert(target, source, "Ticket_ID", on_duplicate="error")


def test_merge_with_one_hot_key(spark, folder):
    """A third of the source on one key and a third without a key."""
    made = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("Ticket_ID"),
        F.lit(1).alias("v"),
        F.col("id").alias("seq"),
    )
    table = VersionedTable(spark, folder + "/t")
    table.overwrite(made.limit(0))
    merged = table.merge(made, "Ticket_ID", "seq")
    assert merged.count() == 10_000 + 1 + 10_000
    assert merged.where("Ticket_ID = 'hot'").first().seq == 29_997


def test_versions(spark, folder, target, source):
    table = VersionedTable(spark, folder + "/t")
    assert not table.exists() and table.version == 0
    table.overwrite(target)
    table.merge(source, "Ticket_ID", "seq")
    table.append(target)
    assert table.version == 3 and table.read().count() == 8
    # a version may be made from the one it replaces
    table.overwrite(table.read().where("v = 2"))
    assert table.read().count() == 2 and table.version == 4


def test_reading_a_missing_table(spark, folder):
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, folder + "/none").read()


def test_unpublished_parts_stay_invisible(spark, folder, target):
    table = VersionedTable(spark, folder + "/t")
    table.overwrite(target)
    target.write.parquet(folder + "/t/part-000002-lost")
    assert table.read().count() == 3


@pytest.mark.parametrize(
    "change, refused",
    [
        (lambda df: df.withColumn("extra", F.lit(1)), True),
        (lambda df: df.withColumn("v", F.col("v").cast("string")), True),
        (lambda df: df.drop("v"), False),
        (lambda df: df.select("seq", "v", "Ticket_ID"), False),
    ],
)
def test_append_checks_the_schema(spark, folder, target, change, refused):
    table = VersionedTable(spark, folder + "/t")
    table.overwrite(target)
    if refused:
        with pytest.raises(SchemaMismatchError):
            table.append(change(target))
        assert table.read().count() == 3
    else:
        assert table.append(change(target)).count() == 6
        assert table.read().columns == target.columns


def wide(spark, n, first=0, v=1):
    """Every seventh row without a key, every fifth key twice."""
    key = F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.when(F.col("id") % 5 == 0, F.col("id") - 1).otherwise(F.col("id"))))
    return spark.range(first, first + n).select(key.alias("Ticket_ID"), F.lit(v).alias("v"), F.col("id").alias("seq"))


def files(table):
    return {p: p.stat().st_mtime_ns for part in table.parts() for p in (Path(table.path) / part).glob("*.parquet")}


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_merge_by_buckets_is_the_upsert(spark, folder, buckets):
    table = VersionedTable(spark, folder + "/t", "Ticket_ID", buckets)
    expected = dedup_keep_last(wide(spark, 300).where("Ticket_ID is not null"), "Ticket_ID", "seq").unionByName(wide(spark, 300).where("Ticket_ID is null"))
    assert rows(table.overwrite(wide(spark, 300), "seq")) == rows(expected)
    for source in (wide(spark, 40, 200, 2), wide(spark, 200, 250, 3), wide(spark, 3, 7, 4), wide(spark, 5).limit(0)):
        expected = merge_upsert(table.read(), source, "Ticket_ID", "seq")
        assert rows(table.merge(source, "Ticket_ID", "seq")) == rows(expected)
    assert all(p.rpartition("/")[2].startswith("_bucket=") for p in table.parts())
    # a table that is opened again knows its layout
    assert rows(VersionedTable(spark, folder + "/t").merge(wide(spark, 2, 1, 9), "Ticket_ID", "seq")) == rows(table.read())


def test_untouched_buckets_are_carried_over(spark, folder):
    table = VersionedTable(spark, folder + "/t", "Ticket_ID", 16)
    table.overwrite(wide(spark, 1000), "seq")
    before, parts = files(table), table.parts()
    assert len(parts) == 16
    table.merge(spark.createDataFrame([("k1", 5, 5000), ("k2", 5, 5001), ("new", 5, 5002)], SCHEMA), "Ticket_ID", "seq")
    after, written = files(table), [p for p in table.parts() if p not in parts]
    touched = {p.rpartition("/")[2] for p in written}
    assert 1 <= len(touched) <= 3
    assert {p: t for p, t in before.items() if p.parent.name not in touched} == {p: t for p, t in after.items() if p.parent.name not in touched}
    assert {p.rpartition("/")[2] for p in written} == {p.rpartition("/")[2] for p in parts if p not in table.parts()}
    assert table.read().where("Ticket_ID in ('k1', 'k2', 'new') and v = 5").count() == 3


def test_merge_with_an_order_column_that_is_dropped(spark, folder):
    table = VersionedTable(spark, folder + "/t", "Ticket_ID", 4)
    rows_ = spark.createDataFrame([("a", 1, 9, 1), ("a", 2, 1, 2)], SCHEMA + ", batch int")
    order = F.struct("batch", "seq")
    assert rows(table.overwrite(rows_, order, ("batch",))) == [("a", 2, 1)]
    later = spark.createDataFrame([("a", 3, 0, 3), ("a", 4, 0, 2)], SCHEMA + ", batch int")
    assert rows(table.merge(later, "Ticket_ID", order, drop=("batch",))) == [("a", 3, 0)]


@pytest.mark.parametrize("ties", [False, True])
def test_late_keep_last(spark, folder, ties):
    made = wide(spark, 500).withColumn("description", F.concat(F.lit("text "), "seq"))
    if ties:
        made = made.unionByName(made.where("seq % 50 = 1"))
    made.write.parquet(folder + "/w")
    made = spark.read.parquet(folder + "/w")
    late = keep_last_late(made, "Ticket_ID", "seq")
    assert rows(late) == rows(dedup_keep_last(made, "Ticket_ID", "seq"))
    plan = late._jdf.queryExecution().executedPlan().toString()
    if not ties:
        assert "Exchange hashpartitioning" not in plan
        assert all("description" not in line for line in plan.splitlines() if "Exchange" in line)


TEXT_SCHEMA = "Ticket_ID string, v int, seq bigint, text string"


def worded(spark, n, first=0, v=1):
    """``wide`` with one of seven long texts in each row, and none in every eleventh."""
    long = F.repeat(F.concat(F.lit("long text "), F.col("seq") % 7, F.lit(" ")), 200)
    return wide(spark, n, first, v).withColumn("text", F.when(F.col("seq") % 11 != 0, long))


@pytest.mark.parametrize("key", [None, "Ticket_ID"])
def test_shared_texts_give_the_same_table(spark, folder, key):
    plain = VersionedTable(spark, folder + "/p", key, 4)
    shared = VersionedTable(spark, folder + "/s", key, 4, shared=("text",))
    order = "seq" if key else None
    assert rows(shared.overwrite(worded(spark, 300), order)) == rows(plain.overwrite(worded(spark, 300), order))
    new = spark.createDataFrame([("k1", 7, 900, "a new text"), ("k2", 7, 901, ""), ("k3", 7, 902, None), (None, 7, 903, "a new text")], TEXT_SCHEMA)
    for source in (worded(spark, 50, 280, 2), new):
        assert rows(shared.merge(source, "Ticket_ID", "seq")) == rows(plain.merge(source, "Ticket_ID", "seq"))
    for source in (new, worded(spark, 20, 5), worded(spark, 20).drop("text")):
        assert rows(shared.append(source)) == rows(plain.append(source))
    assert shared.read().schema == plain.read().schema
    # a table that is opened again knows what it shares
    again = VersionedTable(spark, folder + "/s")
    assert rows(again.read()) == rows(plain.read()) and again.read(["seq", "v"]).columns == ["seq", "v"]
    assert rows(again.overwrite(again.read().where("v = 7"))) == rows(plain.read().where("v = 7"))


def test_a_shared_text_is_stored_and_moved_once(spark, folder):
    table = VersionedTable(spark, folder + "/t", "Ticket_ID", 8, shared=("text",))
    table.overwrite(worded(spark, 500), "seq")
    table.merge(worded(spark, 100, 450, 2), "Ticket_ID", "seq")
    texts = spark.read.parquet(*[str(p) for p in Path(folder, "t").glob("texts-*")])
    assert texts.count() == texts.select("text").distinct().count() == 7
    assert all(dict(spark.read.parquet(f"{table.path}/{p}").dtypes)["text"] == "binary" for p in table.parts())
    narrow = table.read(["Ticket_ID", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in narrow and "texts-" not in narrow


def test_no_shared_key(spark, folder):
    with pytest.raises(ValueError):
        VersionedTable(spark, folder + "/t", "text", shared=("text",))


def test_texts_that_a_table_has_are_not_moved(spark, folder):
    """Rows whose texts are all stored add none: neither an empty folder nor a pass over the texts."""
    table = VersionedTable(spark, folder + "/t", "Ticket_ID", 8, shared=("text",))
    made = table.overwrite(worded(spark, 300), "seq")
    before = rows(made)
    table.append(made)
    table.merge(worded(spark, 50, 280), "Ticket_ID", "seq")
    assert len(list(Path(folder, "t").glob("texts-*"))) == 1
    table.append(spark.createDataFrame([("k1", 7, 900, "a new text")], TEXT_SCHEMA))
    assert len(list(Path(folder, "t").glob("texts-*"))) == 2
    assert {"a new text", *(r[3] for r in before)} == {r.text for r in table.read().collect()}
