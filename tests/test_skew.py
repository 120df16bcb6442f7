"""A third of all transactions on one account (derived from the sf0.01 data):
every plan gives the same result, and the explicit skew paths engage."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as Q
from ledgerlens.operators import reports as R
from ledgerlens.operators.joins import key_salts, salted_join
from ledgerlens.sources.testdata import load_entities

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    e = load_entities(spark, SF)
    hot = e.account.agg(F.min("ACCOUNT_ID")).first()[0]
    txn = e.transaction.withColumn(
        "ACCOUNT_ID", F.when(F.col("TRANSACTION_ID") % 3 == 0, F.lit(hot)).otherwise(F.col("ACCOUNT_ID"))
    )
    return e, txn, hot


def test_hot_account_is_detected(skewed):
    e, txn, hot = skewed
    rows = txn.where(F.col("ACCOUNT_ID") == hot).count()
    found = key_salts(txn, ["ACCOUNT_ID"], rows_per_salt=100).collect()
    assert [tuple(r) for r in found] == [(hot, -(-rows // 100))]


def test_summary_plans_agree_under_skew(skewed):
    e, txn, hot = skewed
    eager = R.branch_summary(txn, e.account, e.branch)
    literal = R.branch_summary(txn, e.account, e.branch, eager=False)
    assert Q.diff_summary(eager, literal).first().differing_rows == 0
    assert eager.agg(F.sum("TOTAL_TRANSACTIONS")).first()[0] == txn.count()


def test_aml_skew_paths_equal_plain_join(skewed):
    e, txn, hot = skewed
    plain = R.aml_customer_transactions(e.customer, e.account, txn)
    for rows_per_salt in (1, 100):
        salted = R.aml_customer_transactions(e.customer, e.account, txn, salt_hot_accounts=True, rows_per_salt=rows_per_salt)
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert Q.diff_summary(plain, salted).first().differing_rows == 0
    hot_rows = txn.where(F.col("ACCOUNT_ID") == hot).count()
    assert hot_rows > txn.count() // 4
    assert plain.where(F.col("ACCOUNT_ID") == hot).count() == hot_rows


def test_checks_agree_under_skew(skewed):
    e, txn, hot = skewed
    dups = Q.duplicate_keys(txn, ["ACCOUNT_ID"]).where(F.col("ACCOUNT_ID") == hot).first()
    assert dups.row_count == txn.where(F.col("ACCOUNT_ID") == hot).count() > txn.count() // 4
    # Every transaction's account exists.
    assert Q.missing_parent_keys(txn, e.account, ["ACCOUNT_ID"]).count() == 0


def test_salts_are_counted_once(spark):
    """The counts of the fact side are one job's; the join's plan does not repeat them."""
    fact = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    dim = spark.range(3).withColumnRenamed("id", "k")
    out = salted_join(fact, dim, ["k"], rows_per_salt=10)
    assert out.count() == 400
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Range (0, 400") == 1
