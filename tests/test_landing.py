"""Landing with sized buckets and spread hot accounts."""

import glob

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import reports as R
from ledgerlens.session import DEFAULT_CONF, RETRY_CONF, scale_conf
from ledgerlens.sources import landing
from ledgerlens.sources import tables as T
from tests.fixtures import sorted_rows


def frames(spark, hot, others):
    """One account with ``hot`` equal rows, the others with three each, rows without an account."""
    ids = spark.range(hot).select(F.lit(7).alias("ACCOUNT_ID"))
    rest = spark.range(others * 3).select((F.col("id") % others + 100).cast("int").alias("ACCOUNT_ID"))
    none = spark.range(50).select(F.lit(None).cast("int").alias("ACCOUNT_ID"))
    t = ids.unionByName(rest).unionByName(none).select(
        "ACCOUNT_ID", F.lit(1).alias("TRANSACTION_ID"), F.lit("2.50").cast("decimal(15,2)").alias("AMOUNT"),
        F.lit("D").alias("TRANSACTION_TYPE"), F.lit("2024-01-01").cast("date").alias("TRANSACTION_DATE"),
    )
    a = spark.range(others).select((F.col("id") + 100).cast("int").alias("ACCOUNT_ID")).unionByName(spark.createDataFrame([(7,), (7,)], "ACCOUNT_ID int"))
    a = a.select("ACCOUNT_ID", (F.col("ACCOUNT_ID") % 5).alias("CUSTOMER_ID"), (F.col("ACCOUNT_ID") % 3).alias("BRANCH_ID"))
    c = spark.range(5).select(F.col("id").cast("int").alias("CUSTOMER_ID"), F.concat(F.lit("c"), "id").alias("NAME"))
    b = spark.range(3).select(F.col("id").cast("int").alias("BRANCH_ID"), F.concat(F.lit("b"), "id").alias("BRANCH_NAME"))
    return t, a, c, b


def rows_per_bucket(spark, name):
    # one file for each bucket, its number in the name
    return [r["count"] for r in spark.table(name).groupBy(F.input_file_name()).count().collect()]


def test_layout_follows_the_size():
    assert landing.layout(0, 40) == landing.Layout(1, 1)
    assert landing.layout(8_000_000, 100, bucket_bytes=100_000_000) == landing.Layout(8, 31_250)
    assert landing.layout(8_000_000, 100, cores=64).buckets == 64  # at least the cores
    assert landing.layout(30_000, 100, cores=64).buckets == 2  # but no crumbs
    gib = 1 << 30
    big = landing.layout(10**12, 110)
    assert big.buckets * (110 * 10**12 // landing.BUCKET_BYTES) <= landing.MAX_SHUFFLE_BLOCKS
    assert 110 * 10**12 / big.buckets < 25 * gib  # no bucket above this at 100 TiB
    assert landing.layout(10**13, 100, max_buckets=50).buckets == 50


def test_hot_account_is_spread(spark, scratch_db):
    t, a, c, b = frames(spark, 4000, 650)
    transaction, account, plan = landing.land(t, a, f"{scratch_db}.l", bucket_bytes=12_000)
    assert plan.buckets >= 16
    held = rows_per_bucket(spark, f"{scratch_db}.l_transaction")
    # two thirds of the rows are one account's, and no bucket holds twice its share
    assert len(held) == plan.buckets
    assert max(held) <= 2 * sum(held) / plan.buckets
    salts = transaction.where("ACCOUNT_ID = 7").groupBy("ACCOUNT_SALT").count().collect()
    assert len(salts) >= 0.9 * 4000 / plan.rows_per_salt
    assert max(r["count"] for r in salts) <= 1.2 * plan.rows_per_salt + 8  # one for each file split
    keys = {"account_keys": landing.LANDED_KEYS}
    assert sorted_rows(R.aml_customer_transactions(c, account, transaction, **keys)) == sorted_rows(R.aml_customer_transactions(c, a, t))
    assert sorted_rows(R.branch_summary(transaction, account, b, **keys)) == sorted_rows(R.branch_summary(t, a, b))


def test_lands_with_checked_retries(spark, scratch_db):
    """The settings exist in this Spark, and rows that come out of a shuffle land whole."""
    conf = scale_conf(1 << 30, 8)
    assert RETRY_CONF.items() <= conf.items() and RETRY_CONF.items() <= DEFAULT_CONF.items()
    t, a, c, b = frames(spark, 2000, 300)
    for key, value in RETRY_CONF.items():
        assert spark.conf.get(key) == "false"  # known, and off unless asked for
        spark.conf.set(key, value)
    try:
        transaction, account, _ = landing.land(t.repartition(5), a, f"{scratch_db}.r", bucket_bytes=12_000)
        assert sorted_rows(R.branch_summary(transaction, account, b, account_keys=landing.LANDED_KEYS)) == sorted_rows(R.branch_summary(t, a, b))
    finally:
        for key in RETRY_CONF:
            spark.conf.unset(key)


def test_fact_side_is_not_shuffled(spark, scratch_db):
    t, a, c, b = frames(spark, 300, 60)
    transaction, account, plan = landing.land(t, a, f"{scratch_db}.n", bucket_bytes=3_000)
    assert plan.buckets > 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = R.account_totals(transaction, landing.LANDED_KEYS).join(account, list(landing.LANDED_KEYS))
        assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
        aml = R.aml_customer_transactions(c, account, transaction, account_keys=landing.LANDED_KEYS)
        plan_text = aml._jdf.queryExecution().executedPlan().toString()
        fact = [line for line in plan_text.splitlines() if "TRANSACTION_ID" in line and "Exchange" in line]
        assert fact == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [0, 1])
def test_small_and_empty(spark, scratch_db, rows):
    t, a, c, b = frames(spark, 10, 5)
    transaction, account, plan = landing.land(t.limit(rows), a.limit(rows), f"{scratch_db}.e{rows}")
    assert plan.buckets == 1
    assert R.branch_summary(transaction, account, b, account_keys=landing.LANDED_KEYS).count() <= rows


def test_one_file_per_bucket(spark, scratch_db):
    t, a, _, _ = frames(spark, 300, 60)
    _, _, plan = landing.land(t, a, f"{scratch_db}.f", bucket_bytes=3_000)
    folder = spark.sql(f"DESCRIBE EXTENDED {scratch_db}.f_transaction").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    assert len(glob.glob(f"{folder}/part-*.parquet")) <= plan.buckets
    assert T.read_table(spark, f"{scratch_db}.f_transaction").count() == t.count()
