"""Mixing sources to target weights by Poisson replication.

A source with n documents, weight w (of all weights W) and a target of N documents
has the mean repetition rate r = w / W * N / n. Every document draws its number of
copies from a Poisson distribution with mean r by inverting the distribution at a
uniform number hashed from a seed, its id, its text and its number among the rows with this id
and text, so a rerun draws the same and rows without an id, or with one id, draw apart. Copies are
exploded and shuffled over the whole result by a hash of the same and the copy number.

The rates are a written table of one row for each source: Spark broadcasts it by its size,
and with very many sources both sides of the join are plain shuffles, of which it splits hot ones. Rates above ``STEP`` are drawn as a sum of Poisson numbers with equal smaller
means, which is the same distribution and keeps exp(-r) away from underflow.
Native column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake.llm.common import written

STEP = 16
#: Terms of one inversion: beyond mean 16 the tail after 120 terms is below 2**-200.
TERMS = 120


def _uniform(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _poisson(row: Column) -> Column:
    """The number drawn with ``pieces`` and ``cdf`` by a row's text: for each piece the values whose probability lies below its uniform number.

    What a lambda binds is computed once; a column named in it would be computed for each element.
    """
    def drawn(text: Column) -> Column:
        numbers = F.transform(F.sequence(F.expr("1"), F.col("pieces")), lambda piece: _uniform(F.concat(text, F.lit(":"), piece.cast("string"))))
        return F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: u >= c)))

    return F.element_at(F.transform(F.array(row), drawn), 1)


def _named(source: str) -> Column:
    """A source's key: null is another one than the empty text."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, total: int | None, source: str = "source") -> DataFrame:
    """One row per source: ``source``, ``n_docs``, ``rate``, ``pieces`` and the ``cdf`` of one piece.

    ``weights`` without an entry for a source give it weight 0; no weights mean equal
    weights. ``total`` documents are wanted, by default as many as there are.
    A null source is a source of its own, with the key None in ``weights``.
    ``_source`` is the name behind "=", empty for null.
    """
    counts = docs.groupBy(_named(source).alias("_source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("_source") == ("" if name is None else f"={name}"), float(value)).otherwise(weight)
    sums = counts.select("*", weight.alias("weight"))
    # one row per source, so the totals are a join with a single row
    all_of = sums.agg(F.sum("weight").alias("_w"), F.sum("n_docs").alias("_n"))
    wanted = F.lit(float(total)) if total is not None else F.col("_n").cast("double")
    rate = F.when(F.col("_w") > 0, F.col("weight") / F.col("_w") * wanted / F.col("n_docs")).otherwise(0.0)
    rates = sums.crossJoin(F.broadcast(all_of)).select("_source", "n_docs", "weight", rate.alias("rate"))
    rates = rates.withColumn("pieces", F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("pieces")
    # P(X <= k) for k = 0 .. TERMS - 1, by p(k) = p(k - 1) * mean / k
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    cdf = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return rates.withColumn("cdf", cdf)


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All rows with ``_nth``, the number (from 1) among those with the same id and text.

    Which keys repeat is counted on hashes alone; only their rows are numbered. Each
    task numbers its own, and the rows that the tasks before it have are added, so a key
    with very many rows is never in one task.
    """
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.col(f"`{text}`").isNull())
    counts = docs.select(key.alias("_row")).groupBy("_row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written(counts.select("_row"), "repeated")
    rows = docs.withColumn("_row", key)
    if repeated.isEmpty():
        return rows.withColumn("_nth", F.lit(1).cast("long")).drop("_row")
    local = Window.partitionBy("_row", "_task").orderBy(*[F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    again = rows.join(repeated, "_row", "left_semi").withColumn("_task", F.spark_partition_id())
    again = written(again.withColumn("_local", F.row_number().over(local)), "numbered")
    # one row for each key and task
    before = Window.partitionBy("_row").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = again.groupBy("_row", "_task").agg(F.max("_local").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    again = again.join(written(offsets.drop("n"), "offsets"), ["_row", "_task"])
    single = rows.join(repeated, "_row", "left_anti").withColumn("_nth", F.lit(1).cast("long"))
    return single.drop("_row").unionByName(again.withColumn("_nth", F.col("_local") + F.col("_before")).select(*single.drop("_row").columns))


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: int | None = None,
    seed: int = 1,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document as often as drawn, with ``copy`` (from 1) and ``shuffle_key``, globally shuffled.

    A document drawn 0 times is absent. Every row draws for itself: rows without an id, with the same
    id, and rows that repeat id and text draw numbers of their own. Texts are only hashed, so null,
    empty and long ones pass unchanged. A null source is a source apart from the empty one. Without
    documents the result is empty. Input columns named ``copy`` or ``shuffle_key``
    are replaced; all others pass through.
    """
    rates = written(source_rates(docs, weights, total, source), "rates")
    base = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("copy", "shuffle_key")])
    columns = [F.col(f"`{c}`") for c in base.columns]
    body = F.coalesce(F.md5(F.col(f"`{text}`").cast("binary")), F.lit("null"))
    drawn = numbered(base, doc_id, text).withColumns({"_key": _named(source), "_body": body})
    drawn = drawn.join(rates.select(F.col("_source").alias("_key"), "pieces", "cdf"), "_key")
    row = [F.lit(seed), F.col(f"`{doc_id}`"), F.col("_body"), F.col("_nth")]
    named = F.concat_ws(":", *[F.coalesce(x.cast("string"), F.lit("null")) for x in row])
    exploded = drawn.select(*columns, "_body", "_nth", _poisson(named).alias("_n")).where("_n > 0").select(
        *columns, "_body", "_nth", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy")
    )
    order = F.xxhash64(*row, F.col("copy"))
    # hashed apart and ordered by the hash inside: a random global order, without the second read a range needs
    mixed = exploded.withColumn("shuffle_key", order).drop("_body", "_nth")
    return mixed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def oracle() -> str:
    """Which documents come how often, in DuckDB SQL over ``documents`` (equal weights, as many as there are)."""
    return f"""
WITH n AS (SELECT coalesce('=' || source, '') AS k, count(*) AS n_docs FROM documents GROUP BY 1),
t AS (SELECT count(*) AS w, sum(n_docs) AS n FROM n),
r AS MATERIALIZED (SELECT k, (1.0::DOUBLE / w::DOUBLE * n::DOUBLE / n_docs::DOUBLE) AS rate FROM n, t),
p AS MATERIALIZED (SELECT k, rate, greatest(ceil(rate / {STEP}), 1)::INT AS pieces FROM r),
c AS MATERIALIZED (
  WITH RECURSIVE c(k, pieces, mean, i, pr, cdf) AS (
    SELECT k, pieces, rate / pieces, 0, exp(-(rate / pieces)), exp(-(rate / pieces)) FROM p
    UNION ALL SELECT k, pieces, mean, i + 1, pr * mean / (i + 1), cdf + pr * mean / (i + 1) FROM c WHERE i < {TERMS - 1})
  SELECT k, pieces, list(cdf ORDER BY i) AS cdf FROM c GROUP BY k, pieces),
d AS MATERIALIZED (
  SELECT d.*, c.cdf, unnest(range(1, c.pieces + 1)) AS piece
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text) AS nth FROM documents) d JOIN c ON coalesce('=' || d.source, '') = c.k),
u AS MATERIALIZED (
  SELECT doc_id, text, lang, source, n_chars, nth, cdf,
    ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null') || ':' || nth || ':' || piece), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u FROM d),
x AS (SELECT doc_id, text, lang, source, n_chars, nth, sum(len(list_filter(cdf, lambda v: u >= v)))::INT AS n FROM u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INT AS copy FROM x WHERE n > 0"""
