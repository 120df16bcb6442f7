"""The reference's function names run unchanged call sites (compat layer)."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlens import compat
from ledgerlens.operators.quality import SchemaMismatch
from ledgerlens.sources import tables as T
from tests.fixtures import flat_sample, sorted_rows, v2_sample


def test_v1_and_v2_summary_and_aml(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    v1 = compat.create_branch_summary_report(transaction, account, branch)
    assert v1.columns == ["BRANCH_ID", "BRANCH_NAME", "TOTAL_TRANSACTIONS", "TOTAL_AMOUNT"]
    v2 = compat.create_branch_summary_report(transaction, account, branch, details)
    assert sorted_rows(v2) == [
        (201, "Downtown Branch", 3, 1000.0, "NORTH", "2024-01-01"),
        (202, "Uptown Branch", 1, 1000.0, "SOUTH", "2023-12-15"),
    ]
    assert compat.create_aml_customer_transactions(customer, account, transaction).count() == 4


def test_enhanced_report_filters_active(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    flagged = details.withColumnRenamed("STATUS", "IS_ACTIVE")
    out = compat.create_enhanced_branch_summary_report(transaction, account, branch, flagged)
    # 'ACTIVE' is not 'Y': the specification's filter leaves no details.
    assert all(r.REGION is None for r in out.collect())
    assert compat.validate_branch_operational_data(flagged).count() == 0


def test_validate_data_quality_and_schema(spark):
    transactions, branches, details = flat_sample(spark)
    assert compat.validate_data_quality(branches, "BRANCHES") is True
    assert compat.validate_data_quality(branches.limit(0), "BRANCHES") is False
    schema = StructType([StructField("BRANCH_ID", LongType()), StructField("BRANCH_NAME", StringType()),
                         StructField("LOCATION", StringType())])
    compat.validate_schema(branches, schema)
    with pytest.raises(SchemaMismatch):
        compat.validate_schema(branches.drop("LOCATION"), schema)


def test_write_and_metrics(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    name = f"{scratch_db}.compat_summary"
    compat.write_to_delta_table(compat.create_branch_summary_report(transaction, account, branch), name, fmt="parquet")
    assert T.read_table(spark, name).count() == 2
    m = compat.collect_metrics(T.read_table(spark, name), "BRANCH_SUMMARY_REPORT").first()
    assert (m.stage, m.record_count) == ("BRANCH_SUMMARY_REPORT", 2) and m.timestamp is not None
