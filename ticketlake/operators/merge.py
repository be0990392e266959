"""Keyed dedup and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake.session import scratch_dir


class DuplicateKeyError(ValueError):
    """The source of an upsert holds one key more than once."""


def dedup_keep_last(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """The last row per key by ``order``; null keys count as one value.

    ``row_number() = 1`` lets Spark cut each map task to one row per key before
    the shuffle, so a key that holds a third of the table sends one row per task.
    """
    latest = Window.partitionBy(key).orderBy((F.col(order) if isinstance(order, str) else order).desc())
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def keep_last_late(df: DataFrame, key: str, order: str) -> DataFrame:
    """As ``dedup_keep_last``, for wide rows that are cheap to read twice, such as those of a table.

    Only keys and orders are shuffled, to find the keys that repeat and their last order; these are
    written, so that Spark sees how many they are. Rows of other keys and rows before the last order are
    told apart without moving them. Only if a key has its last order twice do such rows meet.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "repeated")
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.max(order).alias("_top"))
    counts.where("_n > 1").select("_key", "_top").write.parquet(path)
    repeated = spark.read.schema(f"_key {df.schema[key].dataType.simpleString()}, _top {df.schema[order].dataType.simpleString()}").parquet(path)
    marked = df.join(repeated.withColumn("_again", F.lit(True)), F.col(key).eqNullSafe(F.col("_key")), "left")
    last = marked.where(F.col("_again").isNull() | F.col(order).eqNullSafe(F.col("_top")))
    names = [F.col(f"`{c}`") for c in df.columns]
    ends = df.select(key, order).join(repeated, F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_top")))
    if ends.groupBy(key).count().where("count > 1").isEmpty():
        return last.select(*names)
    tied = dedup_keep_last(last.where("_again"), key, order)
    return last.where("_again is null").select(*names).unionByName(tied.select(*names))


def _single_per_key(source: DataFrame, key: str, order: str | None, on_duplicate: str) -> DataFrame:
    has_key = source.where(F.col(key).isNotNull())
    no_key = source.where(F.col(key).isNull())
    if on_duplicate == "keep_last":
        if order is None:
            raise ValueError("keep_last needs an order column")
        return dedup_keep_last(has_key, key, order).unionByName(no_key)
    if on_duplicate == "error":
        refuse_repeats(source, key)
        return source
    raise ValueError(f"unknown on_duplicate: {on_duplicate}")


def refuse_repeats(source: DataFrame, key: str) -> None:
    repeated = source.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise DuplicateKeyError(f"source repeats a value of {key}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    order: str | None = None,
    on_duplicate: str = "keep_last",
) -> DataFrame:
    """Matched rows take the source's values, new keys are added, the rest stays.

    Null keys match nothing: target rows stay and source rows are added.
    """
    incoming = folded(source, key, order, on_duplicate)
    return untouched(target, incoming, key).unionByName(incoming)


def folded(source: DataFrame, key: str, order: str | None = None, on_duplicate: str = "keep_last") -> DataFrame:
    """The source of an upsert with one row per key; rows without a key all stay."""
    return _single_per_key(source, key, order, on_duplicate)


def untouched(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source does not hold, from one scan of the target.

    Only the keys are read for the join; Spark broadcasts them when it finds them
    small. A null key joins on a text of its own place, so that a mass of them is
    spread over the tasks.
    """
    keys = incoming.where(F.col(key).isNotNull()).select(F.struct(F.col(key).alias("k"), F.lit(None).cast("long").alias("i")).alias("_key"))
    place = F.when(F.col(key).isNull(), F.xxhash64(*[c for c, kind in target.dtypes if not kind.startswith("map")]))
    marked = target.withColumn("_key", F.struct(F.col(key).alias("k"), place.alias("i")))
    return marked.join(keys, "_key", "left_anti").select(target.columns)
