"""Scalar column expressions: ids, calendar parts, null handling, scores, sampling keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What \s stands for, and line ends beyond it: before one of these at the very end, $ matches too.
_SPACE, _LINE_ENDS = " \t\n\x0b\f\r", ("\x85", "\u2028", "\u2029")


def stripped(col: Column) -> Column:
    """Remove any white space, not only blanks, from both ends."""
    text = col.cast("string")
    by_pattern = F.regexp_replace(text, r"^\s+|\s+$", "")
    # A pattern is tried at every character, so it is left to the rare ids that need it.
    odd = text.endswith(_LINE_ENDS[0]) | text.endswith(_LINE_ENDS[1]) | text.endswith(_LINE_ENDS[2])
    return F.when(odd, by_pattern).otherwise(F.btrim(text, F.lit(_SPACE)))


def article_key(col: Column, width: int = 10) -> Column:
    """Stripped id, left-filled with zeros up to ``width``; longer ids stay whole."""
    s = stripped(col)
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), F.lit("0"))


def customer_key(col: Column) -> Column:
    return F.lower(stripped(col))


def sunday_week(date: Column) -> Column:
    """Week of the year with Sunday as first day; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def age_bucket(age: Column) -> Column:
    """The bucket bounds and names. A missing age falls into the last bucket."""
    return (
        F.when(age < 25, "under_25").when(age < 35, "25_34").when(age < 50, "35_49").otherwise("50_plus")
    )


def null_if_nan(col: Column, data_type: str) -> Column:
    """NaN to NULL for floating columns: Spark orders NaN above every number and averages to NaN."""
    return F.nanvl(col, F.lit(None)) if data_type in ("float", "double") else col


def feature_value(col: Column) -> Column:
    """A 32-bit feature with missing values as 0."""
    return F.coalesce(F.nanvl(col.cast("float"), F.lit(None).cast("float")), F.lit(0.0).cast("float"))


def position_score(position: Column, length: Column) -> Column:
    """Score of a 0-based list position: 1 at the top, falling evenly, 4 decimals half-even."""
    return F.bround(1 - position / F.greatest(length, F.lit(1)), 4)


def sample_key(seed: int, *cols: str) -> Column:
    """A repeatable pseudo-random sort key that does not depend on partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c) for c in cols]))
