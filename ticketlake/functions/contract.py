"""The ticket data contract as column expressions.

A rule builds two columns for a field: ``value``, the typed value, and
``error``, the rejection text, null when the field is fine. ``error`` gets the
finished value column, so nothing is parsed twice. Everything stays in the JVM;
no Python runs per record.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ticketlake.functions.text import NOT_SPACE, is_nan_text, strip, to_number
from ticketlake.schema import CATEGORIES, OPTIONAL_TEXT, PRIORITIES, REQUIRED, TICKET_FIELDS

# --- fixed values: rejection texts -------------------------------------------
MISSING_FIELD = "Field required"
EMPTY_FIELD = "Value error, Field '{}' cannot be empty or null"
BAD_SCORE = "Value error, Invalid satisfaction score: "
BAD_PRIORITY = "Value error, Priority_Level '{}' not in allowed values: ['Low', 'Medium', 'High', 'Critical']"
NOT_A_STRING = "Input should be a valid string"
NOT_A_NUMBER = "Input should be a valid number"
NOT_A_NUMBER_TEXT = "Input should be a valid number, unable to parse string as a number"
NOT_A_RECORD = "Record is not a JSON object"
DEFAULT_PRIORITY = "Medium"
SCORE_RANGE = (1.0, 5.0)

# How a value was written in its source.
STRING, NUMBER, BOOLEAN, NAN, NESTED = "STRING", "NUMBER", "BOOLEAN", "NAN", "NESTED"


def split_code(value: Column, test: Callable[[Column], Column]) -> Column:
    """``test(value)``, behind a lambda.

    Spark compiles a projection with a lambda by itself, in many small methods.
    Within whole-stage code all rules would be one method, too large for the JVM
    to turn into machine code.
    """
    return F.exists(F.array(value), test)


@dataclass(frozen=True)
class RawField:
    """``text``: the value as text; ``present``: the key exists; ``kind``: how it was written."""

    text: Column
    present: Column
    kind: Column

    @classmethod
    def absent(cls) -> RawField:
        return cls(F.lit(None).cast("string"), F.lit(False), F.lit(None).cast("string"))

    def is_kind(self, *kinds: str) -> Column:
        return F.coalesce(self.kind.isin(*kinds), F.lit(False))

    @property
    def truth(self) -> Column:
        """1.0 or 0.0 for a boolean."""
        number = F.when(F.lower(self.text) == "true", 1.0).otherwise(0.0)
        return F.when(self.is_kind(BOOLEAN), number)


class RequiredText:
    """Not null, not blank, not the words none or nan (compared before stripping)."""

    def __init__(self, name: str):
        self.message = EMPTY_FIELD.format(name)

    def value(self, field: RawField) -> Column:
        return strip(field.text)

    def error(self, field: RawField, value: Column) -> Column:
        empty = field.text.isNull() | (value == "") | F.lower(field.text).isin("none", "nan")
        return F.when(~field.present, MISSING_FIELD).when(empty, self.message)


class OptionalText:
    """Any text, or nothing."""

    def value(self, field: RawField) -> Column:
        return F.when(~self._wrong(field), field.text)

    def error(self, field: RawField, value: Column) -> Column:
        return F.when(self._wrong(field), NOT_A_STRING)

    def _wrong(self, field: RawField) -> Column:
        return field.is_kind(NUMBER, BOOLEAN, NAN, NESTED)


class Priority:
    """One of four levels. Blank becomes Medium when the key is there; an absent key stays null."""

    def value(self, field: RawField) -> Column:
        return (
            F.when(~field.present, F.lit(None).cast("string"))
            .when(field.is_kind(NAN), "nan")
            .when(field.text.isNull() | ~field.text.rlike(NOT_SPACE), DEFAULT_PRIORITY)
            .otherwise(strip(field.text))
        )

    def error(self, field: RawField, value: Column) -> Column:
        before, after = BAD_PRIORITY.split("{}")
        message = F.concat(F.lit(before), value, F.lit(after))
        known = split_code(value, lambda level: level.isin(*PRIORITIES))
        return F.when(~known, message)


class Hours:
    """Any number; negatives pass. NaN becomes null, so no average turns into NaN."""

    def value(self, field: RawField) -> Column:
        return F.coalesce(field.truth, to_number(field.text))

    def error(self, field: RawField, value: Column) -> Column:
        fine = field.text.isNull() | value.isNotNull() | is_nan_text(field.text)
        return (
            F.when(fine | field.is_kind(NAN), F.lit(None).cast("string"))
            .when(field.is_kind(NESTED), NOT_A_NUMBER)
            .otherwise(NOT_A_NUMBER_TEXT)
        )


class Score:
    """Null, the empty text and nan mean no score; otherwise a number in [1, 5]."""

    def value(self, field: RawField) -> Column:
        number = F.coalesce(field.truth, to_number(field.text))
        low, high = SCORE_RANGE
        return F.when((number >= low) & (number <= high), number)

    def error(self, field: RawField, value: Column) -> Column:
        none = field.text.isNull() | (field.text == "") | is_nan_text(field.text) | field.is_kind(NAN)
        return F.when(value.isNull() & ~none, F.concat(F.lit(BAD_SCORE), field.text))


RULES = {column: OptionalText() for column in OPTIONAL_TEXT}
RULES |= {column: RequiredText(name) for column, name in TICKET_FIELDS if column in REQUIRED}
RULES |= {
    "Priority_Level": Priority(),
    "Resolution_Time_Hours": Hours(),
    "Satisfaction_Score": Score(),
}


def strict_errors(value: dict[str, Column]) -> dict[str, Column]:
    """Opt-in checks on e-mail, category, date and negative hours."""
    date = value["Submission_Date"]
    bad_date = ~date.rlike(r"^\d{4}-\d{2}-\d{2}$") | date.try_cast("date").isNull()
    email = value["Customer_Email"].rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    return {
        "Customer_Email": F.when(~email, "not an e-mail address"),
        "Issue_Category": F.when(~value["Issue_Category"].isin(*CATEGORIES), "not a known category"),
        "Submission_Date": F.when(date.isNotNull() & bad_date, "not an ISO date"),
        "Resolution_Time_Hours": F.when(value["Resolution_Time_Hours"] < 0, "must not be negative"),
    }
