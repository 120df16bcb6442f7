"""One row per key.

``latest`` and ``first`` are grouped ``max``/``min`` over a struct, not a
``row_number`` window: an aggregate (sort-based, its buffer being a struct) combines partially before the
shuffle, so a key holding a third of all rows never lands whole in one task,
and the struct ordering gives a total, deterministic tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("latest", "first", "keep", "error")


class DuplicateKeyError(ValueError):
    """Raised by ``latest_per_key(mode="error")`` when a key repeats."""


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    mode: str = "latest",
) -> DataFrame:
    """Keep one row for each ``keys`` value.

    ``latest``: largest ``order`` values win, NULLs last; ties are broken by
    the remaining columns, largest first.  ``first``: smallest ``order``
    values win, NULLs last; remaining columns smallest first.  ``keep``:
    every row.  ``error``: raise :class:`DuplicateKeyError` if any key
    repeats (one aggregate job), else every row.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys, order = list(keys), list(order)
    if mode == "keep":
        return df
    if mode == "error":
        repeated = df.groupBy(*keys).count().where(F.col("count") > 1)
        if not repeated.isEmpty():
            raise DuplicateKeyError(f"duplicate keys in {keys}")
        return df
    rest = [c for c in df.columns if c not in keys and c not in order]
    if mode == "latest":
        fields = [F.col(c) for c in order + rest]
        best = F.max(F.struct(*fields))
    else:
        # Struct ordering puts NULL first; a leading is-null flag moves
        # missing order values behind present ones under ``min``.
        flags = [F.col(c).isNull().alias(f"_null_{i}") for i, c in enumerate(order)]
        fields = flags + [F.col(c) for c in order + rest]
        best = F.min(F.struct(*fields))
    picked = df.groupBy(*keys).agg(best.alias("_best"))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )
