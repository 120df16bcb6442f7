"""Plan shapes the scale design relies on (checked on the executed plan)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlens.operators import reports as R
from ledgerlens.operators.joins import broadcast_if_bounded, size_at_most
from ledgerlens.sources.testdata import load_entities

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_columns(plan: str, table: str) -> list[list[str]]:
    found = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table + r"\.parquet", plan)
    return [[c.split("#")[0] for c in cols.split(",")] for cols in found]


def test_fact_scan_is_pruned_and_filtered(spark):
    plan = _plan(entry.queries()["branch_summary"](spark, SF))
    assert _scan_columns(plan, "lineitem") == [["l_orderkey", "l_extendedprice"]]
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_eager_plan_aggregates_before_the_account_join(spark):
    e = load_entities(spark, SF)
    df = R.branch_summary(e.transaction, e.account, e.branch)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    # partial_count / partial_sum appear on the fact side below the first exchange.
    assert plan.count("partial_count") >= 1 and plan.count("partial_sum") >= 3


from ledgerlens.plans.registry import QUERIES  # noqa: E402


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_nested_loop_or_window(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF", "EvalPython"):
        assert bad not in plan, f"{key} plans {bad}"


def test_broadcast_only_behind_a_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert size_at_most(small, 10) and not size_at_most(big, 10)
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("v"))
    assert not size_at_most(wide, 10, max_bytes=4000) and size_at_most(wide, 10, max_bytes=6000)
    joined = spark.range(5000).join(broadcast_if_bounded(big, max_rows=10), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(joined)
        hinted = spark.range(5000).join(broadcast_if_bounded(small, max_rows=10), "id")
        assert "BroadcastHashJoin" in _plan(hinted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_key_salts(spark):
    """The registered salted report joins on a salt, also at this small size."""
    df = entry.queries()["aml_customer_transactions_salted"](spark, SF)
    assert "_salt" in df._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_coverage_needs_no_expand(spark):
    assert "Expand" not in _plan(entry.queries()["details_coverage_distinct"](spark, SF))


def test_violations_need_no_shuffle(spark):
    plan = _plan(entry.queries()["domain_violations"](spark, SF))
    # The only exchange is the broadcast of the tiny region table inside the view.
    assert "Exchange hashpartitioning" not in plan


def test_aml_shuffles_fact_table_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(entry.queries()["aml_customer_transactions"](spark, SF))
        # lineitem appears once, below exactly one hash exchange on ACCOUNT_ID.
        assert len(_scan_columns(plan, "lineitem")) == 1
        assert plan.count("SortMergeJoin") == 3  # orders-customer, customer-account, account-transaction
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_sources_remove_the_fact_shuffle(spark, scratch_db):
    from ledgerlens.sources import tables as T

    e = load_entities(spark, SF)
    T.write_table(e.transaction, f"{scratch_db}.txn", bucket_by=(8, ["ACCOUNT_ID"]))
    T.write_table(e.account, f"{scratch_db}.acct", bucket_by=(8, ["ACCOUNT_ID"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = R.branch_summary(
            T.read_table(spark, f"{scratch_db}.txn"), T.read_table(spark, f"{scratch_db}.acct"), e.branch
        )
        plan = _plan(df)
        assert "hashpartitioning(ACCOUNT_ID" not in plan
        expected = sorted(tuple(r) for r in entry.queries()["branch_summary"](spark, SF).collect())
        assert sorted(tuple(r) for r in df.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
