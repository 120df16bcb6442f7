"""End-to-end job (TC010) and the JDBC reader's option handling."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.jobs import QualityGateError, Sources, run_reporting_job
from ledgerlens.sources import jdbc, publish
from ledgerlens.sources import tables as T
from tests.fixtures import v2_sample


def test_end_to_end_v2(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    details = details.withColumnRenamed("STATUS", "IS_ACTIVE").withColumn(
        "IS_ACTIVE", F.when(F.col("IS_ACTIVE") == "ACTIVE", "Y").otherwise("N")
    )
    result = run_reporting_job(
        spark,
        Sources(customer, account, transaction, branch, details),
        aml_table=f"{scratch_db}.aml",
        summary_table=f"{scratch_db}.summary",
    )
    assert result.record_counts == {f"{scratch_db}.aml": 4, f"{scratch_db}.summary": 2}
    assert {v["table_name"] for v in result.verdicts} == {
        "CUSTOMER",
        "ACCOUNT",
        "TRANSACTION",
        "BRANCH",
        "BRANCH_OPERATIONAL_DETAILS",
    }
    summary = sorted(tuple(r) for r in T.read_table(spark, f"{scratch_db}.summary").collect())
    assert summary == [
        (201, "Downtown Branch", 3, 1000.0, "NORTH", "2024-01-01"),
        (202, "Uptown Branch", 1, 1000.0, "SOUTH", "2023-12-15"),
    ]
    # TC010: every branch with transactions appears in the summary.
    assert {r[0] for r in summary} == {201, 202}


def test_end_to_end_v1_without_details(spark, scratch_db):
    customer, account, transaction, branch, _ = v2_sample(spark)
    run_reporting_job(
        spark,
        Sources(customer, account, transaction, branch),
        aml_table=f"{scratch_db}.aml1",
        summary_table=f"{scratch_db}.summary1",
    )
    assert T.read_table(spark, f"{scratch_db}.summary1").columns == [
        "BRANCH_ID",
        "BRANCH_NAME",
        "TOTAL_TRANSACTIONS",
        "TOTAL_AMOUNT",
    ]


def test_quality_gate_blocks_writes(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    empty_branch = branch.where(F.lit(False))
    with pytest.raises(QualityGateError):
        run_reporting_job(
            spark,
            Sources(customer, account, transaction, empty_branch),
            aml_table=f"{scratch_db}.aml_g",
            summary_table=f"{scratch_db}.summary_g",
        )
    assert not T.table_exists(spark, f"{scratch_db}.aml_g")


def _job(spark, db, transaction=None, **options):
    customer, account, plain, branch, details = v2_sample(spark)
    return run_reporting_job(
        spark,
        Sources(customer, account, transaction if transaction is not None else plain, branch, details.withColumnRenamed("STATUS", "IS_ACTIVE")),
        aml_table=f"{db}.aml",
        summary_table=f"{db}.summary",
        enrich_options={"active_value": "ACTIVE"},
        **options,
    )


def _state(spark, db):
    """The reports (without the versions behind them) and their rows."""
    tables = sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary and "__" not in t.name)
    return tables, {t: sorted(map(str, spark.table(f"{db}.{t}").collect())) for t in tables}


def test_missing_source_leaves_the_old_reports(spark, scratch_db, tmp_path):
    """Q20: a source that has gone fails the job; nothing is touched, nothing left behind."""
    plain = v2_sample(spark)[2]
    plain.write.parquet(f"{tmp_path}/txn")
    source = spark.read.parquet(f"{tmp_path}/txn")
    _job(spark, scratch_db, source)
    before = _state(spark, scratch_db)
    assert before[0] == ["aml", "summary"]
    for file in (tmp_path / "txn").glob("*.parquet"):
        file.unlink()
    with pytest.raises(Exception):
        _job(spark, scratch_db, source)
    assert _state(spark, scratch_db) == before


def test_renamed_column_stops_the_job(spark, scratch_db):
    _job(spark, scratch_db)
    before = _state(spark, scratch_db)
    with pytest.raises(ValueError):
        _job(spark, scratch_db, v2_sample(spark)[2].withColumnRenamed("AMOUNT", "AMT"))
    assert _state(spark, scratch_db) == before


def test_renamed_parquet_column_raises(spark, tmp_path):
    from ledgerlens.sources import testdata as td

    renamed = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").withColumnRenamed("c_name", "c_fullname")
    renamed.write.parquet(f"{tmp_path}/customer.parquet")
    with pytest.raises(ValueError, match="c_name"):
        td.customer(spark, str(tmp_path))


def test_strict_holds_for_reports(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    # sources without a NULL; the LEFT join still leaves branches without details NULL
    one = details.withColumnRenamed("STATUS", "IS_ACTIVE").limit(1)
    sources = Sources(customer, account, transaction, branch, one)
    options = {"aml_table": f"{scratch_db}.aml", "summary_table": f"{scratch_db}.summary", "enrich_options": {"active_value": "ACTIVE"}}
    run_reporting_job(spark, sources, **options)
    before = _state(spark, scratch_db)
    with pytest.raises(QualityGateError):
        run_reporting_job(spark, sources, strict=True, **options)
    assert _state(spark, scratch_db) == before


@pytest.mark.parametrize("step", range(5))
def test_publishing_is_both_or_neither(spark, scratch_db, monkeypatch, step):
    """Each catalog step of the second run fails in turn: two views over both
    versions, the pointer, two views over the new version."""
    _job(spark, scratch_db)
    before = _state(spark, scratch_db)
    run, calls = publish._run, []

    def failing(spark, sql):
        calls.append(sql)
        if len(calls) == step + 1:
            raise RuntimeError("killed")
        run(spark, sql)

    monkeypatch.setattr(publish, "_run", failing)
    with pytest.raises(RuntimeError):
        _job(spark, scratch_db, v2_sample(spark)[2].limit(2))
    monkeypatch.undo()
    after = _state(spark, scratch_db)
    assert after[0] == before[0]
    if step <= 2:
        assert after == before
    else:
        assert len(after[1]["aml"]) == 2 and all(after[1][t] != before[1][t] for t in ("aml", "summary"))
    leftovers = [t.name for t in spark.catalog.listTables(scratch_db) if "__landed" in t.name or "__laid" in t.name]
    assert leftovers == []
    _job(spark, scratch_db)  # the next run goes on from there
    assert _state(spark, scratch_db) == before


class _FakeReader:
    def __init__(self):
        self.calls = []

    def jdbc(self, **kwargs):
        self.calls.append(kwargs)
        return _FakeFrame(kwargs)


class _FakeFrame:
    def __init__(self, kwargs):
        self.kwargs = kwargs

    def first(self):
        return (1, 1000)


class _FakeSpark:
    def __init__(self):
        self.read = _FakeReader()


def test_read_jdbc_single_partition():
    spark = _FakeSpark()
    jdbc.read_jdbc(spark, "jdbc:x", "BRANCH", {"user": "u"})
    assert spark.read.calls == [{"url": "jdbc:x", "table": "BRANCH", "properties": {"user": "u"}}]


def test_read_jdbc_partitioned_fetches_bounds():
    spark = _FakeSpark()
    jdbc.read_jdbc(spark, "jdbc:x", "TRANSACTION", {"user": "u"}, column="TRANSACTION_ID", num_partitions=8, fetch_size=5000)
    bounds_call, read_call = spark.read.calls
    assert "MIN(TRANSACTION_ID)" in bounds_call["table"]
    assert read_call["column"] == "TRANSACTION_ID"
    assert (read_call["lowerBound"], read_call["upperBound"], read_call["numPartitions"]) == (1, 1000, 8)
    assert read_call["properties"]["fetchsize"] == "5000"


def _balanced(spark, keys, parts):
    """Rows per range that the predicates give, by Spark SQL in the database's place."""
    spark.createDataFrame([(k,) for k in keys], "k bigint").createOrReplaceTempView("ranged")
    query = jdbc.quantile_query("ranged", "k", parts)
    cuts = sorted({r[0] for r in spark.sql(f"SELECT * FROM {query}").collect() if r[0] is not None})[1:]
    conditions = jdbc.range_predicates("k", cuts)
    got = [spark.sql(f"SELECT count(*) FROM ranged WHERE {c}").first()[0] for c in conditions]
    assert sum(got) == len(keys)  # each row in exactly one range
    return got


def test_balanced_ranges(spark):
    even = _balanced(spark, list(range(1000)), 8)
    assert len(even) == 8 and max(even) <= 126
    # ids crowd at the low end with one far outlier: equal steps would put all but one row in one range
    crowded = _balanced(spark, [i * i // 7 for i in range(2000)] + [10**15], 10)
    assert len(crowded) == 10 and max(crowded) <= 1.1 * 2001 / 10
    # one key with two thirds of the rows, NULLs: every other range stays near its share
    hot = _balanced(spark, [500] * 2000 + list(range(1000)) + [None] * 30, 9)
    assert sorted(hot)[-1] <= 2000 + 400 and sorted(hot)[-2] <= 400
    assert _balanced(spark, [], 4) == []


def test_range_predicates_and_literals():
    import datetime as dt

    assert jdbc.range_predicates("K", []) == []
    assert jdbc.range_predicates("K", [5, 9]) == ["K < 5 OR K IS NULL", "K >= 5 AND K < 9", "K >= 9"]
    assert jdbc.range_predicates("D", [dt.date(2024, 1, 2), "a'b"])[1] == "D >= DATE '2024-01-02' AND D < 'a''b'"


class _RowsFrame(_FakeFrame):
    def collect(self):
        return [(30,), (None,), (10,), (20,)]


def test_large_tables_are_ranged_by_default():
    spark = _FakeSpark()
    spark.read.jdbc = lambda **kw: spark.read.calls.append(kw) or _RowsFrame(kw)
    from ledgerlens.plans.jobs import load_sources_jdbc

    load_sources_jdbc(spark, "jdbc:x", {"user": "u"}, partitioning={"CUSTOMER": {}})
    reads = {c["table"]: c for c in spark.read.calls if not c["table"].startswith("(")}
    assert reads["TRANSACTION"]["predicates"] == ["TRANSACTION_ID < 20 OR TRANSACTION_ID IS NULL", "TRANSACTION_ID >= 20 AND TRANSACTION_ID < 30", "TRANSACTION_ID >= 30"]
    assert "predicates" in reads["ACCOUNT"]
    assert all("predicates" not in reads[t] for t in ("CUSTOMER", "BRANCH", "BRANCH_OPERATIONAL_DETAILS"))


def test_read_details_table_name():
    spark = _FakeSpark()
    jdbc.read_branch_operational_details(spark, "jdbc:x", {}, column="BRANCH_ID", num_partitions=2, lower_bound=0, upper_bound=10)
    assert spark.read.calls[-1]["table"] == "BRANCH_OPERATIONAL_DETAILS"


def test_empty_report_publishes_nothing(spark, scratch_db):
    # Sources pass, but no account matches a customer: the AML report is
    # empty, so neither report replaces the existing tables.
    customer, account, transaction, branch, details = v2_sample(spark)
    from pyspark.sql import functions as F2

    T.write_table(account.limit(1), f"{scratch_db}.aml_e")
    lonely = customer.withColumn("CUSTOMER_ID", F2.col("CUSTOMER_ID") + 1000)
    with pytest.raises(QualityGateError):
        run_reporting_job(
            spark,
            Sources(lonely, account, transaction, branch),
            aml_table=f"{scratch_db}.aml_e",
            summary_table=f"{scratch_db}.summary_e",
        )
    assert T.read_table(spark, f"{scratch_db}.aml_e").count() == 1
    assert not T.table_exists(spark, f"{scratch_db}.summary_e")
    assert [t.name for t in spark.catalog.listTables(scratch_db) if not t.isTemporary] == ["aml_e"]


def test_report_profile_observed_during_write(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    result = run_reporting_job(
        spark,
        Sources(customer, account, transaction, branch, details.withColumnRenamed("STATUS", "IS_ACTIVE")),
        aml_table=f"{scratch_db}.aml_o",
        summary_table=f"{scratch_db}.summary_o",
        enrich_options={"active_value": "ACTIVE"},
    )
    summary_verdict = [v for v in result.report_verdicts if v["table_name"].endswith("summary_o")][0]
    assert summary_verdict["row_count"] == 2
    assert summary_verdict["null_counts"]["REGION"] == 0


def test_source_schema_drift_stops_the_job(spark, scratch_db):
    from ledgerlens.operators.quality import SchemaMismatch

    customer, account, transaction, branch, details = v2_sample(spark)
    renamed = details.withColumnRenamed("REGION", "AREA").withColumnRenamed("STATUS", "IS_ACTIVE")
    with pytest.raises(SchemaMismatch, match="REGION"):
        run_reporting_job(
            spark,
            Sources(customer, account, transaction, branch, renamed),
            aml_table=f"{scratch_db}.aml_s",
            summary_table=f"{scratch_db}.summary_s",
        )
    assert not T.table_exists(spark, f"{scratch_db}.aml_s")


def test_job_with_salted_aml_and_checked_broadcast(spark, scratch_db):
    customer, account, transaction, branch, details = v2_sample(spark)
    result = run_reporting_job(
        spark,
        Sources(customer, account, transaction, branch, details.withColumnRenamed("STATUS", "IS_ACTIVE")),
        aml_table=f"{scratch_db}.aml_x",
        summary_table=f"{scratch_db}.summary_x",
        enrich_options={"active_value": "ACTIVE"},
        aml_options={"salt_hot_accounts": True, "rows_per_salt": 1},
        summary_options={"broadcast_branch": True},
    )
    assert result.record_counts[f"{scratch_db}.aml_x"] == 4
    assert sorted(tuple(r) for r in T.read_table(spark, f"{scratch_db}.summary_x").collect())[0][:4] == (
        201,
        "Downtown Branch",
        3,
        1000.0,
    )
