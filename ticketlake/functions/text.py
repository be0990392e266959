"""Text expressions shared by the contract and by retrieval."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: the characters that count as white space ------------------
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# the same set as a pattern; \p{Z} is one look-up where a list of ranges is many
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
SPACE_RUN = SPACE + "+"
SPACE_AT_AN_END = rf"^{SPACE}|{SPACE}\z"

# --- fixed values: number text; digits may be grouped with "_" ---------------
NUMBER_TEXT = r"[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
INFINITY_TEXT = r"(?i)[+-]?inf(inity)?"
NAN_TEXT = r"(?i)[+-]?nan"


def _all_of(text: Column, pattern: str) -> Column:
    """Whether a text is the pattern and nothing else but white space around it."""
    return text.rlike(rf"\A{SPACE}*(?:{pattern}){SPACE}*\z")


def strip(text: Column) -> Column:
    """Cut white space from both ends. Spark's ``trim`` cuts blanks only.

    Most values have none, and the test for it is cheaper than the cut.
    """
    return F.when(text.rlike(SPACE_AT_AN_END), F.btrim(text, F.lit(SPACE_CHARS))).otherwise(text)


def is_nan_text(text: Column) -> Column:
    return _all_of(text, NAN_TEXT)


def to_number(text: Column) -> Column:
    """Number text as double; null for anything else, NaN included.

    The pattern guards the cast, because Spark alone also reads ``4d``.
    """
    infinity = F.when(strip(text).startswith("-"), float("-inf")).otherwise(float("inf"))
    return F.when(
        _all_of(text, NUMBER_TEXT), F.replace(strip(text), F.lit("_"), F.lit("")).try_cast("double")
    ).when(_all_of(text, INFINITY_TEXT), infinity)


def tokens(text: Column) -> Column:
    """Lower-cased words between white space, in order, repeats kept."""
    return F.array_remove(F.split(F.lower(text), SPACE_RUN), "")


def words(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(tokens(text))


def shared_words(left: Column, right: Column) -> Column:
    """Number of distinct words two texts share."""
    return F.size(F.array_intersect(tokens(left), tokens(right)))


def plain_number(value: Column, digits: int) -> Column:
    """Shortest decimal text of a rounded number, with at least one decimal."""
    fixed = F.round(value, digits).cast(f"decimal(20,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
