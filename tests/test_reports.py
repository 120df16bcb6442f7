"""Golden rows for the reports, worked out from the reference's
sample rows, plus the enrichment modes of §0.1."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from ledgerlens.operators import reports as R
from ledgerlens.operators.dedupe import DuplicateKeyError
from tests.fixtures import flat_sample, generated_1000, v2_sample
from tests.fixtures import sorted_rows


def rows(df):
    return sorted_rows(df)


def test_v2_sample_enriched_no_rule(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    summary = R.branch_summary(transaction, account, branch)
    out = R.enrich_summary(summary, details, active_rule="none")
    assert out.columns == R.ENRICHED_COLUMNS
    assert rows(out) == [
        (201, "Downtown Branch", 3, 1000.0, "NORTH", "2024-01-01"),
        (202, "Uptown Branch", 1, 1000.0, "SOUTH", "2023-12-15"),
    ]


def test_v2_sample_status_column_as_active_flag(spark):
    # D3: the flag column and its active value are arguments.
    customer, account, transaction, branch, details = v2_sample(spark)
    summary = R.branch_summary(transaction, account, branch)
    out = R.enrich_summary(summary, details, active_col="STATUS", active_value="ACTIVE")
    assert [r[4] for r in rows(out)] == ["NORTH", "SOUTH"]


def test_summary_types_match_target_ddl(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    summary = R.branch_summary(transaction, account, branch)
    types = {f.name: f.dataType for f in summary.schema.fields}
    assert types == {
        "BRANCH_ID": LongType(),
        "BRANCH_NAME": StringType(),
        "TOTAL_TRANSACTIONS": LongType(),
        "TOTAL_AMOUNT": DoubleType(),
    }


def test_aml_sample(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    out = R.aml_customer_transactions(customer, account, transaction)
    assert out.columns == [
        "CUSTOMER_ID",
        "NAME",
        "ACCOUNT_ID",
        "TRANSACTION_ID",
        "AMOUNT",
        "TRANSACTION_TYPE",
        "TRANSACTION_DATE",
    ]
    got = rows(out)
    assert len(got) == 4
    assert sorted(r[0] for r in got) == [101, 101, 102, 103]


def test_withdrawal_adds_not_subtracts(spark):
    # Amounts are summed regardless of TRANSACTION_TYPE.
    customer, account, transaction, branch, details = v2_sample(spark)
    summary = rows(R.branch_summary(transaction, account, branch))
    assert summary[0][3] == 1000.0  # 500 + 200 (WITHDRAWAL) + 300


def test_eager_equals_join_first_with_duplicate_accounts_and_branches(spark):
    customer, account, transaction, branch, details = v2_sample(spark)
    account2 = account.unionByName(account.where("ACCOUNT_ID = 1001"))
    branch2 = branch.unionByName(branch.where("BRANCH_ID = 201"))
    a = rows(R.branch_summary(transaction, account2, branch2, eager=True))
    b = rows(R.branch_summary(transaction, account2, branch2, eager=False))
    assert a == b
    assert a[0][:3] == (201, "Downtown Branch", 2 * (3 + 2))


def test_flat_sample_golden(spark):
    transactions, branches, details = flat_sample(spark)
    flat = R.branch_summary_flat(transactions, branches)
    out = R.enrich_summary(flat, details, active_rule="none", duplicates="keep")
    assert rows(out) == [
        (101, "Downtown Branch", 2, 1250.0, "Central", "2024-01-10"),
        (102, "Uptown Branch", 1, 300.0, "North", "2024-01-08"),
        (103, "Suburban Branch", 1, 1200.0, "South", "2024-01-12"),
    ]


def test_flat_counts_transaction_id_not_rows(spark):
    # count(TRANSACTION_ID) skips NULL ids.
    t = spark.createDataFrame(
        [(1, 101, 10.0), (None, 101, 5.0)], "TRANSACTION_ID long, BRANCH_ID long, AMOUNT double"
    )
    b = spark.createDataFrame([(101, "A")], ["BRANCH_ID", "BRANCH_NAME"])
    assert rows(R.branch_summary_flat(t, b)) == [(101, "A", 1, 15.0)]


def test_tc009_thousand_rows(spark):
    df = generated_1000(spark)
    branches = spark.createDataFrame([(100 + k, f"B{k}") for k in range(10)], ["BRANCH_ID", "BRANCH_NAME"])
    start = time.time()
    out = rows(R.branch_summary_flat(df, branches))
    assert time.time() - start < 30
    assert len(out) == 10
    for k, r in enumerate(out):
        assert r[0] == 100 + k and r[2] == 100
        assert r[3] == 495000 + 1000 * k


def test_tc008_amount_edges(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "AMOUNT double")
        return df.agg(F.sum("AMOUNT")).first()[0]

    assert total([0.0, 0.0]) == 0.0
    assert total([-100.0, 200.0]) == 100.0
    assert total([999999999.99]) == 999999999.99


def _details(spark, rows_):
    return spark.createDataFrame(
        rows_, "BRANCH_ID int, REGION string, MANAGER_NAME string, LAST_AUDIT_DATE date, IS_ACTIVE string"
    )


@pytest.fixture
def summary(spark):
    return spark.createDataFrame(
        [(1, "A", 2, 10.0), (2, "B", 1, 5.0), (3, "C", 4, 1.5)],
        "BRANCH_ID long, BRANCH_NAME string, TOTAL_TRANSACTIONS long, TOTAL_AMOUNT double",
    )


def test_enrichment_modes(spark, summary):
    import datetime as dt

    d = _details(
        spark,
        [
            (1, "NORTH", "M, A", dt.date(2024, 1, 1), "Y"),
            (1, "EAST", "M, B", dt.date(2024, 6, 1), "Y"),  # later duplicate
            (2, "SOUTH", "M, C", dt.date(2023, 1, 1), "N"),  # inactive
        ],
    )
    # Default: LEFT, filter on active, latest duplicate.
    assert rows(R.enrich_summary(summary, d)) == [
        (1, "A", 2, 10.0, "EAST", "2024-06-01"),
        (2, "B", 1, 5.0, None, None),
        (3, "C", 4, 1.5, None, None),
    ]
    # CASE rule, INNER, keep duplicates: inactive branch kept, blanked.
    assert rows(R.enrich_summary(summary, d, how="inner", active_rule="case", duplicates="keep")) == [
        (1, "A", 2, 10.0, "EAST", "2024-06-01"),
        (1, "A", 2, 10.0, "NORTH", "2024-01-01"),
        (2, "B", 1, 5.0, None, None),
    ]
    # First duplicate instead of latest.
    first = rows(R.enrich_summary(summary, d, duplicates="first"))
    assert first[0][4] == "NORTH"
    with pytest.raises(DuplicateKeyError):
        R.enrich_summary(summary, d, duplicates="error")


def test_enrichment_never_changes_totals(spark, summary):
    import datetime as dt

    d = _details(spark, [(1, "N", "M, A", dt.date(2024, 1, 1), "Y")] * 3)
    out = R.enrich_summary(summary, d, active_rule="none", duplicates="keep")
    # Duplicates repeat the row (3 copies) but each copy keeps the same totals.
    assert {r[3] for r in out.where("BRANCH_ID = 1").collect()} == {10.0}
    assert out.count() == 5


def test_null_region_and_empty_details(spark, summary):
    import datetime as dt

    d = _details(spark, [(1, None, "M, A", None, "Y")])
    assert rows(R.enrich_summary(summary, d))[0] == (1, "A", 2, 10.0, None, None)
    empty = d.where(F.lit(False))
    out = rows(R.enrich_summary(summary, empty))
    assert len(out) == 3 and all(r[4] is None and r[5] is None for r in out)


def test_timestamp_audit_date_is_formatted_as_date(spark, summary):
    # Oracle DATE arrives over JDBC as TIMESTAMP; the text keeps only the date.
    d = spark.createDataFrame(
        [(1, "N", "2024-01-10 00:00:00", "Y")], "BRANCH_ID int, REGION string, LAST_AUDIT_DATE string, IS_ACTIVE string"
    ).withColumn("LAST_AUDIT_DATE", F.to_timestamp("LAST_AUDIT_DATE"))
    assert rows(R.enrich_summary(summary, d))[0][5] == "2024-01-10"


def test_all_branches_zero_fill(spark, summary):
    branch = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (9, "IDLE")], "BRANCH_ID int, BRANCH_NAME string")
    out = rows(R.all_branches(summary, branch))
    assert out[-1] == (9, "IDLE", 0, 0.0)
    assert len(out) == 4


def test_unknown_modes_rejected(spark, summary):
    with pytest.raises(ValueError):
        R.enrich_summary(summary, summary, how="full")
    with pytest.raises(ValueError):
        R.enrich_summary(summary, summary, active_rule="maybe")


def test_missing_column_raises_clearly(spark):
    # TC005: a frame without the needed columns fails at plan time.
    bad = spark.createDataFrame([(1, "A")], ["BRANCH_ID", "BRANCH_NAME"])
    with pytest.raises(Exception) as info:
        R.branch_summary(bad, bad, bad)
    assert "column" in str(info.value).lower() or "field" in str(info.value).lower()


def test_future_audit_modes(spark, summary):
    import datetime as dt

    d = _details(
        spark,
        [
            (1, "OLD", "M, A", dt.date(2024, 1, 1), "Y"),
            (1, "FUTURE", "M, B", dt.date(2999, 1, 1), "Y"),
            (2, "ONLY_FUTURE", "M, C", dt.date(2999, 1, 1), "Y"),
        ],
    )
    accept = {r[0]: r[4] for r in R.enrich_summary(summary, d).collect()}
    assert accept[1] == "FUTURE" and accept[2] == "ONLY_FUTURE"
    reject = {r[0]: r[4] for r in R.enrich_summary(summary, d, future_audit="reject", as_of="2026-12-01").collect()}
    assert reject[1] == "OLD" and reject[2] is None
    flagged = R.enrich_summary(summary, d, future_audit="flag", as_of="2026-12-01")
    assert flagged.columns[-1] == "AUDIT_DATE_IN_FUTURE"
    assert {r[0]: r[-1] for r in flagged.collect()} == {1: True, 2: True, 3: None}
    with pytest.raises(ValueError):
        R.enrich_summary(summary, d, future_audit="reject")


def test_reject_future_on_driver_data(spark):
    import __spark_entry__ as entry

    normal = {r.BRANCH_ID: r for r in entry.queries()["branch_summary_enriched"](spark, "/root/testdata/sf0.001").collect()}
    reject = {r.BRANCH_ID: r for r in entry.queries()["branch_summary_enriched_reject_future"](spark, "/root/testdata/sf0.001").collect()}
    assert normal[6].LAST_AUDIT_DATE == "2999-01-01"
    assert reject[6].LAST_AUDIT_DATE is None and reject[6].REGION is None
    assert {k: v for k, v in normal.items() if k != 6} == {k: v for k, v in reject.items() if k != 6}
