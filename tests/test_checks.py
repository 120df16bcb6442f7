"""Constraints that bind (S10, Q13), one-pass integrity (Q6, U2), fingerprints
(Q11), schema rows (Q3-Q5) and observed verdicts (Q1, Q2, Q17)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as Q
from ledgerlens.plans import registry
from ledgerlens.schemas import BRANCH_SUMMARY_V1, BRANCH_SUMMARY_V2, CHECKS, DEFAULTS, REQUIRED_COLUMNS, SOURCES
from ledgerlens.sources import tables as T
from tests.fixtures import sorted_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture
def details(spark, scratch_db):
    name, source = f"{scratch_db}.details", "BRANCH_OPERATIONAL_DETAILS"
    T.create_table(spark, name, SOURCES[source], defaults=DEFAULTS[source], not_null=REQUIRED_COLUMNS[source], checks=CHECKS[source])
    return name


def test_all_source_tables_take_their_ddl(spark, scratch_db):
    for source, schema in SOURCES.items():
        name = f"{scratch_db}.{source.lower()}"
        T.create_table(spark, name, schema, defaults=DEFAULTS.get(source), not_null=REQUIRED_COLUMNS.get(source, []), checks=CHECKS.get(source))
        rules = T.table_rules(spark, name)
        assert set(rules) == {f"{c}_not_null" for c in REQUIRED_COLUMNS.get(source, [])} | set(CHECKS.get(source, {}))
        defaults = {f.name: f.metadata.get("CURRENT_DEFAULT") for f in spark.table(name).schema.fields if "CURRENT_DEFAULT" in f.metadata}
        assert defaults == DEFAULTS.get(source, {})


def test_good_batch_takes_defaults(spark, scratch_db, details):
    batch = spark.createDataFrame([(1, "West"), (2, "East")], "BRANCH_ID int, REGION string")
    assert T.insert_checked(batch, details) == 2
    assert T.insert_checked(batch.limit(0), details) == 0
    assert sorted_rows(T.read_table(spark, details)) == [(1, "West", None, None, "Y"), (2, "East", None, None, "Y")]
    tables = [t.name for t in spark.catalog.listTables(scratch_db) if not t.isTemporary]
    assert tables == ["details"]  # no staging left


def test_bad_batch_is_refused_whole(spark, scratch_db, details):
    T.insert_checked(spark.createDataFrame([(1, "West")], "BRANCH_ID int, REGION string"), details)
    bad = spark.createDataFrame([(2, "East", "Y"), (3, None, "X"), (4, None, None), (5, "East", "it's")], "BRANCH_ID int, REGION string, IS_ACTIVE string")
    with pytest.raises(T.RefusedBatch) as refused:
        T.insert_checked(bad, details)
    # a NULL flag is no broken CHECK, as in SQL
    assert refused.value.broken == {"REGION_not_null": 2, "IS_ACTIVE_domain": 2}
    assert [r.BRANCH_ID for r in T.read_table(spark, details).collect()] == [1]
    assert len([t for t in spark.catalog.listTables(scratch_db) if not t.isTemporary]) == 1


def literal_report(edges):
    return {e.name: Q.missing_parent_keys(e.child, e.parent, e.keys, e.parent_keys).agg(F.count(F.lit(1)), F.coalesce(F.sum("child_rows"), F.lit(0))).first() for e in edges}


def test_integrity_in_one_pass(spark):
    parent = spark.createDataFrame([(1, 7), (2, 8), (2, 9), (None, 9)], "K int, L int")
    child = spark.createDataFrame([(1, 7)] * 40 + [(3, 1), (3, 2), (None, 9), (2, None)], "K bigint, L bigint")
    edges = [
        Q.Edge("one", child, parent, ["K"]),
        Q.Edge("two", child, parent, ["K", "L"]),
        Q.Edge("named", child, parent, ["L"], ["L"]),
        Q.Edge("self", parent, child, ["K"]),
        Q.Edge("empty", child.limit(0), parent, ["K"]),
        Q.Edge("no parents", child, parent.limit(0), ["L"]),
    ]
    want = literal_report(edges)
    got = Q.integrity_report(edges)
    assert {r.edge: (r.missing_keys, r.missing_rows) for r in got.collect()} == {k: tuple(v) for k, v in want.items()}
    # the child is read once for all edges in which it takes part
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2


def test_integrity_of_counted_children(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (2, 1)], "K int, n bigint")
    parent = spark.createDataFrame([(1,)], "K int")
    assert [tuple(r) for r in Q.integrity_report([Q.Edge("e", child, parent, ["K"], rows="n")]).collect()] == [("e", 1, 7)]


def test_registered_integrity_reads_each_table_once(spark):
    plan = registry.QUERIES["ref_integrity"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan  # their own scans are behind the two written tables


ROWS = [(1, "a", None), (2, None, 1.5), (2, None, 1.5), (None, "a", 0.0)]


@pytest.mark.parametrize(
    "change, differing",
    [
        (lambda rows: rows[::-1], 0),
        (lambda rows: rows + [rows[0]], 1),  # one row duplicated
        (lambda rows: rows[1:], 1),  # one lost
        (lambda rows: [*rows[:-1], (None, None, 0.0)], 2),
        (lambda rows: [(1, None, None), *rows[1:3], (None, "a", 0.0)], 2),
        (lambda rows: [rows[0], rows[0], *rows[2:]], 2),  # as many rows, another multiplicity
        (lambda rows: [], 4),
    ],
)
def test_fingerprints(spark, change, differing):
    schema = "K int, T string, D double"
    a, b = spark.createDataFrame(ROWS, schema).repartition(3), spark.createDataFrame(change(list(ROWS)), schema)
    got, want = Q.compare_frames(a, b), Q.diff_summary(a, b)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.first().differing_rows == differing
    assert (Q.fingerprint(a).first() == Q.fingerprint(b).first()) == (differing == 0)


def test_null_places_count(spark):
    a = spark.createDataFrame([("x", None)], "A string, B string")
    b = spark.createDataFrame([(None, "x")], "A string, B string")
    assert Q.fingerprint(a).first() != Q.fingerprint(b).first()


def test_fingerprint_moves_no_rows(spark):
    plan = Q.fingerprint(spark.range(10).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_schema_rows(spark):
    df = spark.createDataFrame([], BRANCH_SUMMARY_V2)
    assert {r.verdict for r in Q.schema_diff(df, BRANCH_SUMMARY_V2, "t").collect()} == {"equal"}
    v1 = {r.field: r.verdict for r in Q.schema_diff(df, BRANCH_SUMMARY_V1, "t").collect()}
    assert [f for f, v in v1.items() if v == "added"] == ["REGION", "LAST_AUDIT_DATE"]
    turned = df.select("BRANCH_NAME", "BRANCH_ID", F.col("TOTAL_AMOUNT").cast("float"))
    got = {r.field: r.verdict for r in Q.schema_diff(turned, BRANCH_SUMMARY_V1, "t").collect()}
    assert got == {"BRANCH_ID": "moved", "BRANCH_NAME": "moved", "TOTAL_TRANSACTIONS": "missing", "TOTAL_AMOUNT": "type"}


def test_observed_verdicts_equal_a_second_plan(spark):
    e = registry._e(spark, SF)
    profiles = None
    for name, df in registry._entity_frames(e).items():
        p = Q.profile(df, name)
        profiles = p if profiles is None else profiles.unionByName(p)
    assert sorted_rows(registry.QUERIES["quality_verdict"](spark, SF)) == sorted_rows(Q.verdict(profiles))
