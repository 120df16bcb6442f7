"""The reference ETL's public function names, over the Spark implementations.

A job written against the reference's functions can switch imports to this
module and keep its call sites.  Behaviour follows the reference's code, with
the deliberate differences of SURVEY §0.1: failures propagate (D12), the
session is never stopped (D13), and checks are single Spark jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators import quality as Q
from ledgerlens.operators import reports as R
from ledgerlens.session import get_spark_session
from ledgerlens.sources import jdbc
from ledgerlens.sources import tables as T

__all__ = [
    "collect_metrics",
    "create_aml_customer_transactions",
    "create_branch_summary_report",
    "create_enhanced_branch_summary_report",
    "get_spark_session",
    "read_branch_operational_details",
    "read_table",
    "validate_branch_operational_data",
    "validate_data_quality",
    "validate_schema",
    "write_to_delta_table",
]

read_branch_operational_details = jdbc.read_branch_operational_details


def read_table(
    spark: SparkSession,
    jdbc_url: str,
    table_name: str,
    connection_properties: Mapping[str, str],
    **partitioning,
) -> DataFrame:
    """A JDBC table; ``partitioning`` (``column``, ``num_partitions``, bounds)
    splits the read, which the reference always did in one partition."""
    return jdbc.read_jdbc(spark, jdbc_url, table_name, connection_properties, **partitioning)


def create_aml_customer_transactions(
    customer_df: DataFrame, account_df: DataFrame, transaction_df: DataFrame
) -> DataFrame:
    """The seven-column AML report."""
    return R.aml_customer_transactions(customer_df, account_df, transaction_df)


def create_branch_summary_report(
    transaction_df: DataFrame,
    account_df: DataFrame,
    branch_df: DataFrame,
    branch_operational_df: DataFrame | None = None,
) -> DataFrame:
    """A1 with three frames (v1, four columns); A2 with four (v2: LEFT join of
    REGION and LAST_AUDIT_DATE, no active rule, details rows as given)."""
    summary = R.branch_summary(transaction_df, account_df, branch_df)
    if branch_operational_df is None:
        return summary
    return R.enrich_summary(summary, branch_operational_df, active_rule="none", duplicates="keep")


def create_enhanced_branch_summary_report(
    transaction_df: DataFrame,
    account_df: DataFrame,
    branch_df: DataFrame,
    branch_operational_df: DataFrame,
) -> DataFrame:
    """A3: the specification's form: active details only, one per branch
    (latest audit), LAST_AUDIT_DATE as ``yyyy-MM-dd`` text."""
    summary = R.branch_summary(transaction_df, account_df, branch_df)
    return R.enrich_summary(summary, branch_operational_df)


def validate_data_quality(df: DataFrame, table_name: str, strict: bool = False) -> bool:
    """Q1 (lenient, the pipeline's rule) or Q2 (``strict``, the tests' rule),
    computed in one job instead of 1 + n counts."""
    return Q.passes(df, table_name, strict=strict)


def validate_branch_operational_data(df: DataFrame, active_col: str = "IS_ACTIVE") -> DataFrame:
    """active details rows only (counts come from ``quality.profile``)."""
    return df.where(F.col(active_col) == F.lit("Y"))


def validate_schema(df: DataFrame, expected_schema: StructType, mode: str = "equal") -> None:
    """Q3: raise ``quality.SchemaMismatch`` when the schema differs."""
    Q.check_schema(df, expected_schema, mode)


def write_to_delta_table(
    df: DataFrame, table_name: str, *, fmt: str = "delta", merge_schema: bool = False
) -> None:
    """Full-overwrite table write; ``merge_schema`` is the v2 writer's
    ``mergeSchema``.  ``fmt`` defaults to Delta as in the reference; pass
    ``"parquet"`` where Delta is not installed."""
    T.write_table(df, table_name, fmt=fmt, evolve=merge_schema)


def collect_metrics(df: DataFrame, stage: str) -> DataFrame:
    """Q17: one row ``stage, record_count, timestamp`` (lazy)."""
    return Q.record_counts({stage: df}, with_timestamp=True)

