"""Quality and reconciliation operators."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ledgerlens.functions import columns as C
from ledgerlens.operators import quality as Q
from ledgerlens.schemas import BRANCH_SUMMARY_V1, BRANCH_SUMMARY_V2
from tests.fixtures import sorted_rows


def rows(df):
    return sorted_rows(df)


BRANCH_SCHEMA = StructType(
    [
        StructField("BRANCH_ID", IntegerType(), True),
        StructField("BRANCH_NAME", StringType(), True),
        StructField("LOCATION", StringType(), True),
    ]
)


def test_tc004_clean_nulls_empty(spark):
    clean = spark.createDataFrame([(1, "Branch A", "Location A"), (2, "Branch B", "Location B")], BRANCH_SCHEMA)
    nulls = spark.createDataFrame([(1, None, "Location A"), (2, "Branch B", None)], BRANCH_SCHEMA)
    empty = spark.createDataFrame([], BRANCH_SCHEMA)
    assert Q.passes(clean, "BRANCHES", strict=True) is True
    assert Q.passes(nulls, "BRANCHES", strict=True) is False
    assert Q.passes(nulls, "BRANCHES", strict=False) is True  # lenient: reported, not fatal
    assert Q.passes(empty, "BRANCHES", strict=False) is False
    assert Q.passes(empty, "BRANCHES", strict=True) is False


def test_profile_rows(spark):
    nulls = spark.createDataFrame([(1, None, "Location A"), (2, "Branch B", None)], BRANCH_SCHEMA)
    assert rows(Q.profile(nulls, "B")) == [
        ("B", "BRANCH_ID", 2, 0),
        ("B", "BRANCH_NAME", 2, 1),
        ("B", "LOCATION", 2, 1),
    ]
    v = Q.verdict(Q.profile(nulls, "B")).first()
    assert (v.row_count, v.null_cells, v.columns_with_nulls, v.passed_lenient, v.passed_strict) == (
        2,
        2,
        2,
        True,
        False,
    )


def test_profile_is_one_job_plan(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("x"))
    plan = Q.profile(df, "T")._jdf.queryExecution().executedPlan().toString()
    # A single aggregate over the scan: no join, no repeated scan of the input.
    assert plan.count("Range (") == 1


def test_strict_implies_lenient(spark):
    for data in ([(1, "a", "b")], [(1, None, "b")], []):
        df = spark.createDataFrame(data, BRANCH_SCHEMA)
        if Q.passes(df, "T", strict=True):
            assert Q.passes(df, "T", strict=False)


def test_tc005_malformed_id_is_handled(spark):
    # A text id beside numbers infers a string column; the check still returns a bool.
    df = spark.createDataFrame([("invalid_id", "Branch A", "Location A"), ("2", "Branch B", "Location B")],
                               ["BRANCH_ID", "BRANCH_NAME", "LOCATION"])
    assert isinstance(Q.passes(df, "B"), bool)
    errors = Q.violations(df, ["BRANCH_NAME"], [Q.Rule("id_not_int", C.not_convertible(F.col("BRANCH_ID")), F.col("BRANCH_ID"))])
    assert rows(errors) == [("Branch A", "id_not_int", "invalid_id")]


def test_check_schema_equal_and_compatible(spark):
    df = spark.createDataFrame([], BRANCH_SUMMARY_V2)
    Q.check_schema(df, BRANCH_SUMMARY_V2, "equal")
    Q.check_schema(df, BRANCH_SUMMARY_V1, "compatible")  # TC007: v1 fields kept with same types
    with pytest.raises(Q.SchemaMismatch):
        Q.check_schema(df, BRANCH_SUMMARY_V1, "equal")
    narrow = spark.createDataFrame([], BRANCH_SUMMARY_V1)
    with pytest.raises(Q.SchemaMismatch):
        Q.check_schema(narrow, BRANCH_SUMMARY_V2, "compatible")
    wrong = spark.createDataFrame([], "BRANCH_ID int, BRANCH_NAME string, TOTAL_TRANSACTIONS long, TOTAL_AMOUNT double")
    with pytest.raises(Q.SchemaMismatch):
        Q.check_schema(wrong, BRANCH_SUMMARY_V1, "compatible")


def test_check_schema_ignores_nullability(spark):
    schema = StructType([StructField("A", LongType(), False), StructField("B", DoubleType(), True)])
    df = spark.range(1).select(F.col("id").alias("A"), F.lit(1.0).alias("B"))
    Q.check_schema(df, schema, "equal")


def _details(spark):
    return spark.createDataFrame(
        [
            (1, "AFRICA", "Doe, John", dt.date(2024, 1, 1), "Y", "1"),
            (2, None, "NoComma", dt.date(2999, 1, 1), "X", "two"),
            (3, "Narnia", "L" * 120 + ", F", None, None, None),
            (3, "ASIA", None, dt.date(2020, 1, 1), "N", "3"),
        ],
        "BRANCH_ID int, REGION string, MANAGER_NAME string, LAST_AUDIT_DATE date, IS_ACTIVE string, BRANCH_REF string",
    )


def test_violations_one_pass_all_rules(spark):
    d = _details(spark)
    rules = [
        Q.Rule("region_domain", C.outside_domain(F.col("REGION"), ["AFRICA", "ASIA"]), F.col("REGION")),
        Q.Rule("active_domain", C.outside_domain(F.col("IS_ACTIVE"), ["Y", "N"]), F.col("IS_ACTIVE")),
        Q.Rule("future", C.after(F.col("LAST_AUDIT_DATE"), "2026-12-01"), F.col("LAST_AUDIT_DATE")),
        Q.Rule("format", C.not_matching(F.col("MANAGER_NAME")), F.col("MANAGER_NAME")),
        Q.Rule("length", C.longer_than(F.col("MANAGER_NAME"), 100), F.lit("too long")),
        Q.Rule("ref", C.not_convertible(F.col("BRANCH_REF")), F.col("BRANCH_REF")),
    ]
    got = rows(Q.violations(d, ["BRANCH_ID"], rules))
    assert got == [
        (2, "active_domain", "X"),
        (2, "format", "NoComma"),
        (2, "future", "2999-01-01"),
        (2, "ref", "two"),
        (3, "length", "too long"),
        (3, "region_domain", "Narnia"),
    ]
    counts = dict((r.rule, r.violations) for r in Q.violation_counts(d, "D", rules).collect())
    assert counts == {"region_domain": 1, "active_domain": 1, "future": 1, "format": 1, "length": 1, "ref": 1}


def test_domain_case_flag(spark):
    df = spark.createDataFrame([("North",), ("NORTH",), ("Mars",)], ["REGION"])
    sensitive = df.where(C.outside_domain(F.col("REGION"), ["North"])).count()
    insensitive = df.where(C.outside_domain(F.col("REGION"), ["North"], case_sensitive=False)).count()
    assert (sensitive, insensitive) == (2, 1)


def test_flag_modes(spark):
    d = _details(spark)
    rule = Q.Rule("future", C.after(F.col("LAST_AUDIT_DATE"), "2026-12-01"), F.col("LAST_AUDIT_DATE"))
    assert Q.flag(d, rule, "accept").count() == 4
    assert Q.flag(d, rule, "reject").count() == 3
    assert Q.flag(d, rule, "flag").where("future").count() == 1


def test_duplicates_orphans_integrity(spark):
    d = _details(spark)
    branch = spark.createDataFrame([(1, "A"), (2, "B")], "BRANCH_ID long, BRANCH_NAME string")
    assert rows(Q.duplicate_keys(d, ["BRANCH_ID"])) == [(3, 2)]
    assert sorted(r.BRANCH_ID for r in Q.missing_parents(d, branch, ["BRANCH_ID"]).collect()) == [3, 3]
    assert rows(Q.missing_parent_keys(d, branch, ["BRANCH_ID"])) == [(3, 2)]
    report = rows(Q.integrity_report([Q.Edge("d_b", d, branch, ["BRANCH_ID"]), Q.Edge("b_d", branch, d, ["BRANCH_ID"])]))
    assert report == [("b_d", 0, 0), ("d_b", 1, 2)]


def test_null_child_key_is_missing_like_not_exists(spark):
    child = spark.createDataFrame([(None,), (1,)], "K int")
    parent = spark.createDataFrame([(1,)], "K int")
    assert Q.missing_parents(child, parent, ["K"]).count() == 1


def test_reconcile(spark):
    summary = spark.createDataFrame(
        [(1, 2, 30.0), (2, 1, 5.0), (4, 1, 1.0)], "BRANCH_ID long, TOTAL_TRANSACTIONS long, TOTAL_AMOUNT double"
    )
    detail = spark.createDataFrame(
        [(1, 10.0), (1, 20.004), (2, 5.0), (2, 1.0), (3, 7.0)], "BRANCH_ID long, AMOUNT double"
    )
    got = {r.BRANCH_ID: (r.counts_match, r.amounts_match) for r in Q.reconcile(summary, detail).collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (False, False), 4: (False, False)}
    assert Q.reconcile(summary, detail, only_mismatches=True).count() == 3


def test_frame_diff_and_summary(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "K int, V string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "K int, V string")
    assert rows(Q.frame_diff(a, b)) == [(1, "x", "left_only", 1), (3, "z", "right_only", 1)]
    assert tuple(Q.diff_summary(a, b).first()) == (3, 3, 2)
    assert tuple(Q.diff_summary(a, a).first()) == (3, 3, 0)
    assert Q.frame_diff(a, a).count() == 0


def test_key_set_compare(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "K int")
    b = spark.createDataFrame([(2,), (3,)], "K int")
    assert tuple(Q.key_set_compare(a, b, ["K"]).first()) == (2, 2, 1, 1)


def test_coverage_literal_and_distinct(spark):
    branch = spark.createDataFrame([(1,), (2,), (3,)], "BRANCH_ID long")
    details = spark.createDataFrame([(1,), (1,), (2,)], "BRANCH_ID int")
    lit_ = Q.coverage(branch, details).first()
    assert (lit_.total_branches, lit_.branches_with_operational_details, lit_.missing_operational_details) == (4, 3, 1)
    dis = Q.coverage(branch, details, distinct=True).first()
    assert (dis.total_branches, dis.branches_with_operational_details, dis.missing_operational_details) == (3, 2, 1)
    assert dis.breached is True
    assert Q.coverage(branch, details, max_missing=0.5, distinct=True).first().breached is False


def test_counts_and_metrics(spark):
    a = spark.range(5)
    b = spark.range(3)
    assert rows(Q.record_counts({"A": a, "B": b})) == [("A", 5), ("B", 3)]
    m = Q.count_match(a, b, "A", "B").first()
    assert (m.source_rows, m.target_rows, m.counts_match) == (5, 3, False)
    assert rows(Q.before_after_counts(a, b.withColumn("x", F.lit(1)))) == [
        ("After Enhancement", 3, 2),
        ("Before Enhancement", 5, 1),
    ]


def test_observed_counts_without_extra_job(spark):
    df, obs = Q.observed(spark.range(7), "S")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["record_count"] == 7


def test_amount_totals_and_completeness(spark):
    t = spark.createDataFrame(
        [(decimal.Decimal("1.50"),), (decimal.Decimal("-0.50"),), (None,)], "AMOUNT decimal(15,2)"
    )
    r = Q.amount_totals(t).first()
    assert (r.row_count, r.total_amount) == (3, 1.0)
    rep = spark.createDataFrame([("N", "2024-01-01"), (None, None)], "REGION string, LAST_AUDIT_DATE string")
    assert tuple(Q.report_completeness(rep).first()) == (2, 1, 1, 1)


def test_record_counts_with_timestamp(spark):
    out = Q.record_counts({"A": spark.range(3)}, with_timestamp=True).first()
    assert (out.stage, out.record_count) == ("A", 3) and out.timestamp is not None


def test_profile_and_rule_counts_with_awkward_names(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "`a.b` int, `c d` string")
    assert rows(Q.profile(df, "T")) == [("T", "a.b", 2, 1), ("T", "c d", 2, 1)]
    rule = Q.Rule("c d is set", F.col("`c d`").isNotNull(), F.col("`c d`"))
    assert rows(Q.violation_counts(df, "T", [rule])) == [("T", "c d is set", 1)]
