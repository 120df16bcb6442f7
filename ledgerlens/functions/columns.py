"""Column expressions of the reports and checks.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

ISO_DATE = "yyyy-MM-dd"

# Fixed values of the reporting rules: the manager-name format
# 'Last, First Middle' (Q10), the default STATE -> REGION buckets and their
# ELSE value (P9), the documented REGION domain and the IS_ACTIVE domain (Q7),
# and the labels of the before/after comparison.
MANAGER_NAME_PATTERN = r"^[^,]+, [^,]+$"
DEFAULT_STATE_BUCKETS = {
    "West": ["CA", "WA", "OR"],
    "East": ["NY", "NJ", "CT"],
    "South": ["TX", "FL", "GA"],
}
DEFAULT_STATE_BUCKET_ELSE = "Central"
DEFAULT_REGIONS = ["North", "South", "East", "West", "Central"]
ACTIVE_FLAGS = ["Y", "N"]
BEFORE_AFTER_LABELS = ("Before Enhancement", "After Enhancement")


def date_text(df: DataFrame, name: str) -> Column:
    """P5: a DATE (or TIMESTAMP) column as ``yyyy-MM-dd`` text; NULL stays NULL.

    Oracle DATE arrives over JDBC as a timestamp, so timestamps go through
    ``to_date`` first.  Text input is passed through unchanged.
    """
    dtype = df.schema[name].dataType
    column = F.col(name)
    if isinstance(dtype, DateType):
        return F.date_format(column, ISO_DATE)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_format(F.to_date(column), ISO_DATE)
    if isinstance(dtype, StringType):
        return column
    return column.cast("string")


def widen_key(name: str) -> Column:
    """INT key widened to BIGINT, keeping the name."""
    return F.col(name).cast("bigint").alias(name)


def money_to_double(column: Column) -> Column:
    """Exact DECIMAL total cast to DOUBLE only at the report boundary."""
    return column.cast("double")


def when_active(value: Column, active_col: str = "IS_ACTIVE", active_value: str = "Y") -> Column:
    """``value`` when the row is active, else NULL (NULL flag counts as not active)."""
    return F.when(F.col(active_col) == F.lit(active_value), value)


def bucket(
    column: Column,
    buckets: Mapping[str, Iterable[str]] = DEFAULT_STATE_BUCKETS,
    default: str | None = DEFAULT_STATE_BUCKET_ELSE,
) -> Column:
    """Searched CASE with IN lists and an ELSE value, in mapping order."""
    expr = None
    for label, members in buckets.items():
        cond = column.isin(list(members))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def zero_if_null(column: Column, zero=0) -> Column:
    """Zero-fill for branches without transactions."""
    return F.coalesce(column, F.lit(zero))


# ---- rule predicates: TRUE flags a violation; NULL input never flags -----


def outside_domain(column: Column, allowed: Iterable[str], case_sensitive: bool = True) -> Column:
    """Q7: value not in ``allowed``.  NULL passes, as in a SQL CHECK."""
    allowed = list(allowed)
    if case_sensitive:
        return ~column.isin(allowed)
    return ~F.upper(column).isin([a.upper() for a in allowed])


def after(column: Column, as_of: str) -> Column:
    """Q9: date later than ``as_of`` (an argument, never ``current_date``)."""
    return column > F.lit(as_of).cast("date")


def longer_than(column: Column, max_chars: int) -> Column:
    """Q12: text longer than ``max_chars`` characters."""
    return F.length(column) > F.lit(max_chars)


def not_matching(column: Column, pattern: str = MANAGER_NAME_PATTERN) -> Column:
    """Q10: text not matching ``pattern`` (anchored regular expression)."""
    return ~column.rlike(pattern)


def is_missing(column: Column) -> Column:
    """Q13: a required column holds NULL."""
    return column.isNull()


def negative(column: Column) -> Column:
    """Q13: a report measure below zero."""
    return column < F.lit(0)


def not_convertible(column: Column, to_type: str = "int") -> Column:
    """Q16: text present but not convertible to ``to_type``.

    ``try_cast`` returns NULL where an ANSI cast would raise.
    """
    return column.isNotNull() & column.try_cast(to_type).isNull()
