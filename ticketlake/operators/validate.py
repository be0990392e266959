"""Contract validation: one pass gives typed tickets and rejection reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticketlake.functions import contract as C
from ticketlake.schema import COLUMNS, NUMERIC, QUARANTINED, REQUIRED, TICKET_FIELDS

REASON = "rejection_reason"
RAW = "raw_record"


UNKNOWN = "_unknown"


def rename_to_contract(df: DataFrame, keep: tuple[str, ...] = (), unknown: bool = False) -> DataFrame:
    """Accept either spelling of each column; columns the contract does not know go.

    Where both spellings exist the capitalised one counts, also where it is null,
    as in JSON records. ``unknown`` keeps the other columns as one struct.
    """
    # positional names: Spark compares column names without case, so both
    # spellings side by side could not be told apart
    at = {name: f"_{i}" for i, name in enumerate(df.columns)}
    columns = [F.col(at[name]).alias(name) for name in keep]
    for pair in TICKET_FIELDS:
        found = [F.col(at[name]).cast("string") for name in pair if name in at]
        if found:
            columns.append(found[0].alias(pair[0]))
    known = {name for pair in TICKET_FIELDS for name in pair} | set(keep)
    others = [F.col(at[name]).alias(name) for name in df.columns if name not in known]
    if unknown and others:
        columns.append(F.struct(*others).alias(UNKNOWN))
    return df.toDF(*at.values()).select(*columns)


# columns whose value a table's text does not already hold
COMPUTED = [*REQUIRED, "Priority_Level", *NUMERIC]
STRICT = ["Customer_Email", "Issue_Category", "Submission_Date"]


def _judged(
    fields: dict[str, C.RawField], columns: list[str], strict: bool, unreadable: Column
) -> Column:
    """Values and rejection reason of a record as one struct; no reason is the empty text."""
    values = {c: C.RULES[c].value(fields[c]) for c in columns}
    extra = C.strict_errors(values) if strict else {}
    errors = []
    for c in columns:
        error = C.RULES[c].error(fields[c], values[c])
        error = F.coalesce(error, extra[c]) if c in extra else error
        errors.append(F.concat(F.lit(f"{c}: "), error))
    # concat_ws skips nulls, so it joins exactly the failing fields in contract order
    joined = F.concat_ws(" | ", *errors)
    reason = F.when(unreadable, C.NOT_A_RECORD).otherwise(joined)
    return F.struct(*[value.alias(c) for c, value in values.items()], reason.alias(REASON))


def _sealed(df: DataFrame) -> DataFrame:
    """``_judged`` as ``_result``, through an explode of one element.

    Spark does not push filters through it. Without it, a filter on the reason
    would be moved below the projection and evaluate all rules once more.
    """
    return df.withColumn("_result", F.explode(F.array("_judged")))


def validate_table(
    df: DataFrame,
    keep: tuple[str, ...] = (),
    strict: bool = False,
    nan_compat: bool = False,
) -> DataFrame:
    """Judge a table of raw text tickets. Adds ``raw_record`` and ``rejection_reason``.

    A column that does not exist counts as an absent key. ``nan_compat`` treats
    an empty cell as a floating-point NaN, the way a data frame library hands it
    on: then empty text cells are rejected.
    """
    named = rename_to_contract(df, keep, unknown=True)
    have = [c for c in COLUMNS if c in named.columns]
    wanted = COLUMNS if nan_compat else COMPUTED + (STRICT if strict else [])
    # text columns that no rule looks at stay out, so that unused ones are never read
    columns = [c for c in COLUMNS if c in wanted]

    def field(column: str) -> C.RawField:
        if column not in have:
            return C.RawField.absent()
        text = F.col(column)
        kind = F.when(text.isNull(), C.NAN).otherwise(C.STRING) if nan_compat else F.lit(C.STRING)
        return C.RawField(text, F.lit(True), kind)

    judged = _judged({c: field(c) for c in columns}, columns, strict, F.lit(False))
    passed = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in COLUMNS}
    passed |= {c: F.col(f"_result.{c}") for c in columns}
    # the whole record, columns outside the contract last
    others = [f"{UNKNOWN}.*"] if UNKNOWN in named.columns else []
    raw = F.to_json(F.struct(*have, *others), {"ignoreNullFields": "false"})
    return _sealed(named.withColumn("_judged", judged)).select(
        *keep,
        *[value.alias(c) for c, value in passed.items()],
        raw.alias(RAW),
        F.nullif(f"_result.{REASON}", F.lit("")).alias(REASON),
    )


def _json_field(i: int, nan_compat: bool) -> dict[str, Column]:
    """Text, presence and kind of a field, from its variant and the variant's type.

    An absent key has no variant, a JSON null has one.
    """
    variant, written = F.col(f"_variant{i}"), F.col(f"_written{i}")
    text = variant.cast("string")
    nan = (written == "DOUBLE") & (text == "NaN")
    nan_kind, nan_text = (C.NAN, "nan") if nan_compat else (C.STRING, None)
    # a whole number that fits a bigint is only kept as a decimal when written like 5.0
    point = written.rlike(r"^DECIMAL\((\d|1[0-8]),0\)")
    return {
        f"_text{i}": F.when(written == "STRING", text)
        .when(nan, F.lit(nan_text).cast("string"))
        .when(written == "BOOLEAN", F.initcap(text))
        .when(point, F.concat(text, F.lit(".0")))
        .otherwise(text),
        f"_kind{i}": F.when(written.isNull() | written.isin("STRING", "VOID"), C.STRING)
        .when(nan, nan_kind)
        .when(written == "BOOLEAN", C.BOOLEAN)
        .when(written.rlike("^(OBJECT|ARRAY)"), C.NESTED)
        .otherwise(C.NUMBER),
    }


def validate_json(
    df: DataFrame,
    value: str = "value",
    keep: tuple[str, ...] = (),
    strict: bool = False,
    nan_compat: bool = False,
    numbers: tuple[str, ...] = (),
) -> DataFrame:
    """Judge JSON text records. Text that is no JSON object is rejected, never dropped.

    ``numbers`` names further keys of a record to keep as whole numbers. The
    text is parsed once, into a variant per key: that tells absent keys from
    nulls and strings from numbers, booleans and nested values.
    """
    names = [f"`{key}` variant" for pair in TICKET_FIELDS for key in pair]
    names += [f"`{key}` variant" for key in numbers] + ["_unreadable string"]
    slots = [f"{side}{i} variant" for i in range(len(TICKET_FIELDS)) for side in "an"]
    slots += [f"k{i} variant" for i in range(len(numbers))] + ["unreadable string"]
    # renamed by position: Spark compares names without case, JSON keys differ by it
    parsed = F.from_json(value, ", ".join(names), {"columnNameOfCorruptRecord": "_unreadable"})
    parsed = parsed.cast(f"struct<{', '.join(p.replace(' ', ':') for p in slots)}>")
    places = range(len(COLUMNS))
    rows = df.select(*dict.fromkeys([*keep, value]), parsed.alias("_parsed"))
    variants = {f"_variant{i}": F.coalesce(f"_parsed.a{i}", f"_parsed.n{i}") for i in places}
    rows = rows.withColumns(variants)
    rows = rows.withColumns({f"_written{i}": F.schema_of_variant(f"_variant{i}") for i in places})
    texts = {}
    for i in places:
        texts |= _json_field(i, nan_compat)
    texts["_readable"] = C.split_code(F.col("_parsed.unreadable"), lambda text: text.isNull())
    rows = rows.withColumns(texts)
    fields = {
        c: C.RawField(F.col(f"_text{i}"), F.col(f"_variant{i}").isNotNull(), F.col(f"_kind{i}"))
        for i, c in enumerate(COLUMNS)
    }
    judged = _judged(fields, COLUMNS, strict, F.col("_parsed").isNull() | ~F.col("_readable"))
    return _sealed(rows.withColumn("_judged", judged)).select(
        *keep,
        *[F.try_variant_get(f"_parsed.k{i}", "$", "bigint").alias(n) for i, n in enumerate(numbers)],
        *[F.col(f"_result.{c}").alias(c) for c in COLUMNS],
        F.col(value).alias(RAW),
        F.nullif(f"_result.{REASON}", F.lit("")).alias(REASON),
    )


def valid_tickets(judged: DataFrame) -> DataFrame:
    """The accepted side, typed."""
    return judged.where(F.col(REASON).isNull()).drop(RAW, REASON)


def quarantine(judged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rejected side as quarantine envelopes."""
    return judged.where(F.col(REASON).isNotNull()).select(
        *keep, RAW, REASON, F.lit(QUARANTINED).alias("status")
    )


def summary(judged: DataFrame) -> DataFrame:
    """Total, valid and invalid counts in one aggregate."""
    ok = F.col(REASON).isNull()
    return judged.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(ok).alias("valid_count"),
        F.count_if(~ok).alias("invalid_count"),
    )


def dlq_sample(rejected: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first rejected records by arrival, with their id or N/A."""
    ticket = F.get_json_object(RAW, "$.Ticket_ID")
    return (
        rejected.orderBy(order)
        .limit(n)
        .select(order, F.coalesce(ticket, F.lit("N/A")).alias("ticket_id"), REASON)
    )
