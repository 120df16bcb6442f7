"""Exact money totals in two long limbs.

Spark sums a DECIMAL(15,2) in a DECIMAL(25,2) buffer, an object per row.  An
amount of at most 15 digits, two of them decimals, is a whole number of cents
that a double holds exactly after rounding: converting and multiplying by 100
err by less than 0.23 of a cent.  The cents are summed as a high and a low limb
of 25 bits each, in long buffers of the hash aggregate, and the exact DECIMAL
is put together once per group.  ``SAFE_ROWS`` rows of the largest amount fit;
a group with more rows raises instead of wrapping.  Amounts of any other type
are summed as they are.

Partial totals may be summed again, also after a join that repeats them.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

BITS = 25
SAFE_ROWS = 1 << (62 - BITS)
WHOLE, HIGH, LOW = "_amount", "_amount_high", "_amount_low"


def in_limbs(dtype: DataType) -> bool:
    """Whether amounts of this type are summed in limbs."""
    return isinstance(dtype, DecimalType) and dtype.scale == 2 and dtype.precision <= 15


def partial_sums(df: DataFrame, amount: str = "AMOUNT") -> list[Column]:
    """Aggregates of ``amount``: a high and a low limb, or the plain sum."""
    if not in_limbs(df.select(amount).schema[0].dataType):
        return [F.sum(amount).alias(WHOLE)]
    cents = F.rint(F.col(amount).cast("double") * 100).cast("bigint")
    high, low = F.shiftright(cents, BITS), cents.bitwiseAND(F.lit((1 << BITS) - 1))
    return [F.sum(high).alias(HIGH), F.sum(low).alias(LOW)]


def merged_sums(columns: Sequence[str]) -> list[Column]:
    """Aggregates of the partial sums among ``columns``, under the same names."""
    return [F.sum(c).alias(c) for c in (WHOLE, HIGH, LOW) if c in columns]


def total(columns: Sequence[str], rows: str) -> Column:
    """The exact total of the partial sums among ``columns``, NULL without an
    amount; ``rows`` names the count of all rows in the group."""
    if WHOLE in columns:
        return F.col(WHOLE)
    unit = Decimal(1 << BITS) / 100
    exact = F.col(HIGH).cast("decimal(19,0)") * F.lit(unit) + F.col(LOW).cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    return F.when(F.col(rows) > SAFE_ROWS, F.raise_error(F.lit("too many rows in one group for an exact total"))).otherwise(exact)
