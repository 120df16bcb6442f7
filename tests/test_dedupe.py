"""One row per key (W1, D14): modes, determinism, and a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.dedupe import DuplicateKeyError, latest_per_key
from tests.fixtures import sorted_rows

SCHEMA = "K int, D date, V string"


def rows(df):
    return sorted_rows(df)


DATA = [
    (1, dt.date(2024, 1, 1), "a"),
    (1, dt.date(2024, 6, 1), "b"),
    (1, None, "c"),
    (2, None, "d"),
    (2, None, "e"),
    (3, dt.date(2023, 1, 1), "f"),
    (None, dt.date(2020, 1, 1), "g"),
]


def test_latest(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(latest_per_key(df, ["K"], ["D"])) == [
        (1, dt.date(2024, 6, 1), "b"),
        (2, None, "e"),  # all NULL: tie broken by the largest remaining value
        (3, dt.date(2023, 1, 1), "f"),
        (None, dt.date(2020, 1, 1), "g"),
    ]


def test_first(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = rows(latest_per_key(df, ["K"], ["D"], mode="first"))
    assert got[0] == (1, dt.date(2024, 1, 1), "a")
    assert got[1] == (2, None, "d")


def test_keep_and_error(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert latest_per_key(df, ["K"], ["D"], mode="keep").count() == len(DATA)
    with pytest.raises(DuplicateKeyError):
        latest_per_key(df, ["K"], ["D"], mode="error")
    unique = df.where("K = 3")
    assert latest_per_key(unique, ["K"], ["D"], mode="error").count() == 1
    with pytest.raises(ValueError):
        latest_per_key(df, ["K"], ["D"], mode="newest")


def test_order_independent(spark):
    shuffled = DATA[:]
    random.Random(7).shuffle(shuffled)
    a = rows(latest_per_key(spark.createDataFrame(DATA, SCHEMA), ["K"], ["D"]))
    b = rows(latest_per_key(spark.createDataFrame(shuffled, SCHEMA).repartition(5), ["K"], ["D"]))
    assert a == b


def test_hot_key_is_aggregated_not_windowed(spark):
    # One key holds a third of the rows; the plan is a partial + final
    # aggregate (no Window operator, which would gather the key in one task).
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("K"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("D"),
        F.col("id").cast("string").alias("V"),
    )
    out = latest_per_key(df, ["K"], ["D"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    hot = out.where("K = 0").collect()
    assert len(hot) == 1
    assert hot[0].D == dt.date(2020, 1, 1) + dt.timedelta(days=999)
    assert out.count() == 1 + (n - n // 3)


def _hot_fact_and_dim(spark):
    # Account 7 holds a third of the transactions; one account row repeats.
    fact = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("ACCOUNT_ID"),
        F.col("id").alias("TRANSACTION_ID"),
    )
    fact = fact.unionByName(spark.range(3).select(F.lit(None).cast("long").alias("ACCOUNT_ID"), F.col("id").alias("TRANSACTION_ID")))
    dim = spark.range(500).select(F.col("id").alias("ACCOUNT_ID"), (F.col("id") * 10).alias("CUSTOMER_ID"))
    return fact, dim.unionByName(dim.where("ACCOUNT_ID = 7"))


# One extreme key; 200 and more hot keys; every key hot; none.
@pytest.mark.parametrize("rows_per_salt", [5_000, 30, 1, 1_000_000])
def test_salted_join_equals_plain_join(spark, rows_per_salt):
    from ledgerlens.operators.joins import key_salts, salted_join
    from ledgerlens.operators.quality import diff_summary

    fact, dim = _hot_fact_and_dim(spark)
    found = {r.ACCOUNT_ID: r._salts for r in key_salts(fact, ["ACCOUNT_ID"], rows_per_salt).collect()}
    counts = {r.ACCOUNT_ID: r["count"] for r in fact.groupBy("ACCOUNT_ID").count().collect()}
    assert found == {k: -(-n // rows_per_salt) for k, n in counts.items() if k is not None and n > rows_per_salt}
    plain = fact.join(dim, ["ACCOUNT_ID"])
    salted = salted_join(fact, dim, ["ACCOUNT_ID"], rows_per_salt=rows_per_salt)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert diff_summary(plain, salted.select(*plain.columns)).first().differing_rows == 0


def test_identical_rows_of_a_hot_key_spread(spark):
    from ledgerlens.operators.joins import salted_join

    fact = spark.range(4_000).select(F.lit(7).alias("ACCOUNT_ID"), F.lit("same").alias("V"))
    dim = spark.createDataFrame([(7, "c")], "ACCOUNT_ID int, C string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(fact, dim, ["ACCOUNT_ID"], rows_per_salt=100)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 4_000
        assert len(per_task) > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
