"""Exact totals in limbs against DECIMAL sums and Python's decimals."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import money
from ledgerlens.operators import quality as Q
from ledgerlens.operators import reports as R

LARGEST = 10**15 - 1  # cents


def frame(spark, rows, dtype="decimal(15,2)"):
    """Rows (key, cents or None)."""
    cents = spark.createDataFrame(rows, "k int, cents decimal(20,0)")
    return cents.select("k", (F.col("cents") * F.lit(Decimal("0.01"))).cast(dtype).alias("AMOUNT"))


def totals(df):
    out = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *money.partial_sums(df))
    exact = money.total(out.columns, "n").cast("decimal(25,2)")
    return {r.k: r.total for r in out.select("k", exact.alias("total")).collect()}


def plain(df):
    return {r.k: r.total for r in df.groupBy("k").agg(F.sum("AMOUNT").alias("total")).collect()}


def test_extremes_equal_decimal(spark):
    edge = [LARGEST, -LARGEST, LARGEST - 1, 1, -1, 0, (1 << 25) - 1, 1 << 25, -(1 << 25), -(1 << 25) - 1, 1 << 49, None]
    rows = [(i % 5, Decimal(c) if c is not None else None) for i in range(5) for c in edge[i:] * 7]
    rows += [(9, None), (9, None), *[(10, Decimal(LARGEST))] * 20_000, *[(11, Decimal(-LARGEST))] * 20_000]  # beyond one long of cents
    df = frame(spark, rows)
    got = totals(df)
    assert got == plain(df)
    assert got[9] is None
    assert got[10] == Decimal(LARGEST) * 20_000 / 100 == -got[11]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-LARGEST, LARGEST)), min_size=1, max_size=60))
def test_any_amounts(spark, cents):
    rows = [(1, None if c is None else Decimal(c)) for c in cents]
    known = [c for c in cents if c is not None]
    assert totals(frame(spark, rows)) == {1: Decimal(sum(known)) / 100 if known else None}


@pytest.mark.parametrize("dtype", ["decimal(16,2)", "decimal(15,3)", "double", "bigint"])
def test_other_types_are_summed_as_they_are(spark, dtype):
    df = frame(spark, [(1, Decimal(1200)), (1, Decimal(300)), (2, None)], dtype)
    assert [c for c in df.groupBy("k").agg(*money.partial_sums(df)).columns if c != "k"] == [money.WHOLE]
    got = {r.BRANCH_ID: r.TOTAL_AMOUNT for r in R.branch_summary_flat(df.select(F.col("k").alias("BRANCH_ID"), F.lit(1).alias("TRANSACTION_ID"), "AMOUNT"), branches(spark)).collect()}
    assert got == {1: 15.0, 2: None}


def branches(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "BRANCH_ID int, BRANCH_NAME string")


def test_reports_beyond_one_long(spark):
    """Both plans and A5 on totals that pass a long of cents, accounts listed twice."""
    t = frame(spark, [(1 + i % 2, Decimal(LARGEST)) for i in range(24_000)]).withColumnRenamed("k", "ACCOUNT_ID")
    a = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (2, 2)], "ACCOUNT_ID int, BRANCH_ID int")
    want = {1: (36_000, float(Decimal(LARGEST) * 36_000 / 100)), 2: (12_000, float(Decimal(LARGEST) * 12_000 / 100))}
    for eager in (True, False):
        out = R.branch_summary(t, a, branches(spark), eager=eager).collect()
        assert {r.BRANCH_ID: (r.TOTAL_TRANSACTIONS, r.TOTAL_AMOUNT) for r in out} == want
    assert tuple(Q.amount_totals(t).first()) == (24_000, float(Decimal(LARGEST) * 24_000 / 100))


def test_no_amounts(spark):
    df = frame(spark, [])
    assert tuple(Q.amount_totals(df).first()) == (0, None)
    assert totals(df) == {}


def test_too_many_rows_raise(spark):
    df = spark.createDataFrame([(1, 1, money.SAFE_ROWS), (1, 1, money.SAFE_ROWS + 1)], f"{money.HIGH} bigint, {money.LOW} bigint, n bigint")
    out = df.select(money.total(df.columns, "n").alias("total"), "n")
    assert out.where(F.col("n") <= money.SAFE_ROWS).first().total == Decimal("335544.33")
    with pytest.raises(Exception, match="too many rows"):
        out.collect()
