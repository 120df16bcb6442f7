"""Migration operators: seeding missing details (S14, J6, F4, P9-P11) and
the before/after comparison (U1, re-exported from ``quality``).

Statements that change tables (backup, add columns, restore) live in
``ledgerlens.sources.tables``; this module only builds DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import (
    DEFAULT_STATE_BUCKET_ELSE,
    DEFAULT_STATE_BUCKETS,
    bucket,
)
from ledgerlens.operators.quality import before_after_counts

__all__ = ["branches_without_details", "seed_details", "region_buckets", "before_after_counts"]

# Fixed values of the seeding statement: placeholder manager and active flag.
SEED_MANAGER = "TBD"
SEED_ACTIVE = "Y"


def branches_without_details(branch: DataFrame, details: DataFrame, key: str = "BRANCH_ID") -> DataFrame:
    """Branches with no details row (correlated NOT EXISTS).

    Detail keys are made distinct first, so a key repeated many times is one
    row on the side of the join that AQE cannot split.  An outer join and a
    filter rather than an anti join, which Spark would push below a union of
    branches and turn into a nested loop where one part's key is a constant.
    """
    d = details.select(F.col(key).cast("bigint").alias("_dk")).distinct()
    return branch.join(d, F.col(key).cast("bigint") == d["_dk"], "left").where("_dk IS NULL").drop("_dk")


def region_buckets(
    branch: DataFrame,
    buckets: Mapping[str, Iterable[str]] = DEFAULT_STATE_BUCKETS,
    default: str = DEFAULT_STATE_BUCKET_ELSE,
    state_col: str = "STATE",
) -> DataFrame:
    """``BRANCH_ID, STATE, REGION`` with REGION bucketed from STATE."""
    return branch.select(
        F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"),
        F.col(state_col).alias("STATE"),
        bucket(F.col(state_col), buckets, default).alias("REGION"),
    )


def seed_details(
    branch: DataFrame,
    details: DataFrame,
    *,
    as_of: str,
    buckets: Mapping[str, Iterable[str]] = DEFAULT_STATE_BUCKETS,
    default: str = DEFAULT_STATE_BUCKET_ELSE,
    state_col: str = "STATE",
    manager: str = SEED_MANAGER,
    active: str = SEED_ACTIVE,
) -> DataFrame:
    """Default details rows for branches that have none.

    REGION is bucketed from STATE, MANAGER_NAME and IS_ACTIVE are constants,
    LAST_AUDIT_DATE is ``as_of`` (an argument standing in for SYSDATE, so
    reruns give the same rows).  Columns follow the details DDL.
    """
    missing = branches_without_details(branch, details)
    return missing.select(
        F.col("BRANCH_ID").cast("int").alias("BRANCH_ID"),
        bucket(F.col(state_col), buckets, default).alias("REGION"),
        F.lit(manager).alias("MANAGER_NAME"),
        F.lit(as_of).cast("date").alias("LAST_AUDIT_DATE"),
        F.lit(active).alias("IS_ACTIVE"),
    )
