"""Table sinks and migration statements (S6-S16), on Parquet tables."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as Q
from ledgerlens.operators.migrate import branches_without_details, region_buckets, seed_details
from ledgerlens.schemas import BRANCH_SUMMARY_V1, BRANCH_SUMMARY_V2
from ledgerlens.sources import tables as T
from tests.fixtures import sorted_rows


def rows(df):
    return sorted_rows(df)


@pytest.fixture
def summary_v1(spark):
    return spark.createDataFrame([(1, "A", 2, 10.0), (2, "B", 1, 5.0)], BRANCH_SUMMARY_V1)


@pytest.fixture
def summary_v2(spark):
    return spark.createDataFrame(
        [(1, "A", 2, 10.0, "NORTH", "2024-01-01"), (2, "B", 1, 5.0, None, None)], BRANCH_SUMMARY_V2
    )


def test_overwrite_is_full_reload(spark, scratch_db, summary_v1):
    name = f"{scratch_db}.summary"
    T.write_table(summary_v1, name)
    T.write_table(summary_v1, name)  # rerun: same table, no duplicates (S15)
    assert rows(T.read_table(spark, name)) == rows(summary_v1)


def test_evolve_4_to_6(spark, scratch_db, summary_v1, summary_v2):
    name = f"{scratch_db}.evolve"
    T.write_table(summary_v1, name)
    T.write_table(summary_v2, name, evolve=True)
    back = T.read_table(spark, name)
    Q.check_schema(back, BRANCH_SUMMARY_V2, "equal")
    assert rows(back) == rows(summary_v2)


def test_staged_overwrite_keeps_old_table_on_failed_check(spark, scratch_db, summary_v1):
    name = f"{scratch_db}.staged"
    T.write_table(summary_v1, name)
    empty = summary_v1.where(F.lit(False))
    with pytest.raises(ValueError):
        T.staged_overwrite(empty, name, check=lambda df: Q.passes(df, name))
    assert rows(T.read_table(spark, name)) == rows(summary_v1)
    assert not T.table_exists(spark, f"{name}__staging")
    T.staged_overwrite(summary_v1.where("BRANCH_ID = 1"), name, check=lambda df: Q.passes(df, name))
    assert rows(T.read_table(spark, name)) == [(1, "A", 2, 10.0)]


def test_staged_overwrite_keeps_old_table_on_failed_job(spark, scratch_db, summary_v1):
    name = f"{scratch_db}.staged_fail"
    T.write_table(summary_v1, name)
    broken = summary_v1.withColumn("TOTAL_AMOUNT", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception):
        T.staged_overwrite(broken, name)
    assert rows(T.read_table(spark, name)) == rows(summary_v1)


def test_backup_add_columns_restore(spark, scratch_db, summary_v1, summary_v2):
    target, backup = f"{scratch_db}.target", f"{scratch_db}.target_backup"
    T.write_table(summary_v1, target)
    T.backup_table(spark, target, backup)
    T.add_columns(spark, target, "REGION STRING, LAST_AUDIT_DATE STRING")
    widened = T.read_table(spark, target)
    assert widened.columns == BRANCH_SUMMARY_V2.fieldNames()
    assert all(r.REGION is None for r in widened.collect())
    T.write_table(summary_v2, target)
    T.backup_table(spark, target, backup)
    T.restore_table(spark, backup, target, BRANCH_SUMMARY_V1)
    restored = T.read_table(spark, target)
    Q.check_schema(restored, BRANCH_SUMMARY_V1, "equal")
    assert rows(restored) == rows(summary_v1)


def test_create_with_defaults_and_insert_subset(spark, scratch_db):
    name = f"{scratch_db}.account"
    T.create_table(
        spark,
        name,
        "ACCOUNT_ID INT, ACCOUNT_TYPE STRING, BALANCE DECIMAL(15,2) DEFAULT 0, IS_OPEN STRING DEFAULT 'Y'",
    )
    T.create_table(spark, name, "ACCOUNT_ID INT")  # IF NOT EXISTS: no error, no change
    src = spark.createDataFrame([(1, "CHECKING"), (2, "SAVINGS")], "ACCOUNT_ID int, ACCOUNT_TYPE string")
    T.insert_columns(src, name, ["ACCOUNT_ID", "ACCOUNT_TYPE"])
    got = rows(T.read_table(spark, name))
    assert [(r[0], r[1], float(r[2]), r[3]) for r in got] == [(1, "CHECKING", 0.0, "Y"), (2, "SAVINGS", 0.0, "Y")]


def test_seed_missing_details_and_insert(spark, scratch_db):
    branch = spark.createDataFrame(
        [(1, "CA"), (2, "NY"), (3, "TX"), (4, "OH"), (5, "WA")], "BRANCH_ID int, STATE string"
    )
    details = spark.createDataFrame(
        [(5, "West", "Doe, J", None, "Y")],
        "BRANCH_ID int, REGION string, MANAGER_NAME string, LAST_AUDIT_DATE date, IS_ACTIVE string",
    )
    assert sorted(r.BRANCH_ID for r in branches_without_details(branch, details).collect()) == [1, 2, 3, 4]
    seeded = seed_details(branch, details, as_of="2026-12-01")
    got = rows(seeded.select("BRANCH_ID", "REGION", "MANAGER_NAME", "IS_ACTIVE"))
    assert got == [(1, "West", "TBD", "Y"), (2, "East", "TBD", "Y"), (3, "South", "TBD", "Y"), (4, "Central", "TBD", "Y")]
    assert {str(r.LAST_AUDIT_DATE) for r in seeded.collect()} == {"2026-12-01"}
    name = f"{scratch_db}.details"
    T.write_table(details, name)
    T.insert_columns(seeded, name)
    assert T.read_table(spark, name).count() == 5
    # Seeding again finds nothing left to seed.
    assert seed_details(branch, T.read_table(spark, name), as_of="2026-12-01").count() == 0


def test_region_buckets_default_lists(spark):
    branch = spark.createDataFrame([(1, "OR"), (2, "CT"), (3, "GA"), (4, None)], "BRANCH_ID int, STATE string")
    assert [r.REGION for r in region_buckets(branch).orderBy("BRANCH_ID").collect()] == [
        "West",
        "East",
        "South",
        "Central",
    ]


def test_bucketed_write_avoids_join_shuffle(spark, scratch_db):
    a = spark.range(1000).select(F.col("id").alias("K"), (F.col("id") * 2).alias("A"))
    b = spark.range(1000).select(F.col("id").alias("K"), (F.col("id") * 3).alias("B"))
    T.write_table(a, f"{scratch_db}.a", bucket_by=(4, ["K"]))
    T.write_table(b, f"{scratch_db}.b", bucket_by=(4, ["K"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = T.read_table(spark, f"{scratch_db}.a").join(T.read_table(spark, f"{scratch_db}.b"), "K")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_target_table_from_ddl_then_load(spark, scratch_db, summary_v2):
    # The target is created from its DDL (properties are kept as options),
    # then loaded by position with a full reload.
    name = f"{scratch_db}.branch_summary_report"
    T.create_table(
        spark,
        name,
        BRANCH_SUMMARY_V2,
        properties={"parquet.compression": "zstd", "report.owner": "reporting"},
    )
    summary_v2.write.insertInto(name, overwrite=True)
    summary_v2.write.insertInto(name, overwrite=True)
    back = T.read_table(spark, name)
    Q.check_schema(back, BRANCH_SUMMARY_V2, "equal")
    assert rows(back) == rows(summary_v2)
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props.get("report.owner") == "reporting"


def test_add_constant_column_and_evolve(spark, scratch_db, summary_v2):
    # TC006 / P12: a constant column added to the report, written with schema evolution.
    name = f"{scratch_db}.with_created"
    T.write_table(summary_v2, name)
    stamped = summary_v2.withColumn("CREATED_TIMESTAMP", F.lit("2026-12-01T00:00:00"))
    T.write_table(stamped, name, evolve=True)
    back = T.read_table(spark, name)
    assert back.columns == BRANCH_SUMMARY_V2.fieldNames() + ["CREATED_TIMESTAMP"]
    Q.check_schema(back, BRANCH_SUMMARY_V2, "compatible")


def test_publish_keeps_old_table_when_rename_fails(spark, scratch_db, summary_v1):
    name = f"{scratch_db}.swap"
    T.write_table(summary_v1, name)
    # No staging table exists, so the rename fails: the old table comes back.
    with pytest.raises(Exception):
        T.publish_staging(spark, name)
    assert rows(T.read_table(spark, name)) == rows(summary_v1)
    assert not T.table_exists(spark, T.previous_name(name))


def test_staged_overwrite_can_rewrite_a_table_from_itself(spark, scratch_db, summary_v1):
    # A plain overwrite of a Parquet table that the job reads is refused;
    # the staged path writes elsewhere first, so it works.
    name = f"{scratch_db}.self"
    T.write_table(summary_v1, name)
    doubled = T.read_table(spark, name).withColumn("TOTAL_AMOUNT", F.col("TOTAL_AMOUNT") * 2)
    with pytest.raises(Exception):
        T.write_table(doubled, name)
    T.staged_overwrite(doubled, name)
    assert sorted(r.TOTAL_AMOUNT for r in T.read_table(spark, name).collect()) == [10.0, 20.0]


def test_partitioned_write_prunes_partitions(spark, scratch_db):
    from ledgerlens.operators.reports import aml_customer_transactions
    from ledgerlens.sources.testdata import load_entities

    e = load_entities(spark, "/root/testdata/sf0.001")
    aml = aml_customer_transactions(e.customer, e.account, e.transaction)
    name = f"{scratch_db}.aml_by_type"
    T.write_table(aml, name, partition_by=["TRANSACTION_TYPE"])
    back = T.read_table(spark, name).where(F.col("TRANSACTION_TYPE") == "R")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TRANSACTION_TYPE" in plan
    assert back.count() == aml.where(F.col("TRANSACTION_TYPE") == "R").count() > 0
