"""Property tests (hypothesis) against brute-force Python models.

Invariants from SURVEY §5: the eager and join-first summaries agree;
enrichment never changes totals; dedupe keeps one row per key whatever the
input order; frame_diff equals multiset difference; strict implies lenient.
"""

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import quality as Q
from ledgerlens.operators import reports as R
from ledgerlens.operators.dedupe import latest_per_key

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

amounts = st.integers(min_value=-10_000, max_value=10_000)
small_key = st.one_of(st.none(), st.integers(min_value=1, max_value=5))

transactions_st = st.lists(st.tuples(small_key, amounts), min_size=0, max_size=25)
accounts_st = st.lists(st.tuples(st.integers(1, 5), st.one_of(st.none(), st.integers(1, 3))), min_size=0, max_size=8)
branches_st = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["A", "B"])), min_size=0, max_size=5)


def _frames(spark, txns, accts, branches):
    t = spark.createDataFrame(
        [(i, a, amt / 100) for i, (a, amt) in enumerate(txns)],
        "TRANSACTION_ID long, ACCOUNT_ID long, AMOUNT double",
    ).selectExpr("TRANSACTION_ID", "ACCOUNT_ID", "CAST(AMOUNT AS DECIMAL(15,2)) AS AMOUNT")
    a = spark.createDataFrame(accts, "ACCOUNT_ID long, BRANCH_ID long")
    b = spark.createDataFrame(branches, "BRANCH_ID long, BRANCH_NAME string")
    return t, a, b


def _brute_summary(txns, accts, branches):
    out = collections.defaultdict(lambda: [0, 0])
    for acct, amt in txns:
        for a_id, b_id in accts:
            if acct is None or a_id != acct or b_id is None:
                continue
            for br_id, name in branches:
                if br_id == b_id:
                    out[(br_id, name)][0] += 1
                    out[(br_id, name)][1] += amt
    return sorted((k[0], k[1], n, cents / 100) for k, (n, cents) in out.items())


@SETTINGS
@given(transactions_st, accounts_st, branches_st)
def test_summary_eager_join_first_and_brute_force_agree(spark, txns, accts, branches):
    t, a, b = _frames(spark, txns, accts, branches)
    eager = sorted(tuple(r) for r in R.branch_summary(t, a, b).collect())
    literal = sorted(tuple(r) for r in R.branch_summary(t, a, b, eager=False).collect())
    assert eager == literal == _brute_summary(txns, accts, branches)


details_st = st.lists(
    st.tuples(
        st.integers(1, 4),
        st.one_of(st.none(), st.sampled_from(["N", "S"])),
        st.one_of(st.none(), st.dates(dt.date(2020, 1, 1), dt.date(2020, 1, 5))),
        st.sampled_from(["Y", "N"]),
    ),
    max_size=8,
)


@SETTINGS
@given(details_st, st.sampled_from(["left", "inner"]), st.sampled_from(["filter", "case", "none"]),
       st.sampled_from(["latest", "first", "keep"]))
def test_enrichment_never_changes_totals(spark, details, how, rule, dups):
    summary = spark.createDataFrame(
        [(1, "A", 2, 10.0), (2, "B", 1, 5.0), (3, "C", 7, -1.5)],
        "BRANCH_ID long, BRANCH_NAME string, TOTAL_TRANSACTIONS long, TOTAL_AMOUNT double",
    )
    d = spark.createDataFrame(details, "BRANCH_ID int, REGION string, LAST_AUDIT_DATE date, IS_ACTIVE string")
    out = R.enrich_summary(summary, d, how=how, active_rule=rule, duplicates=dups).collect()
    base = {r[0]: tuple(r) for r in summary.collect()}
    for r in out:
        assert tuple(r)[:4] == base[r[0]]
    if how == "left":
        assert {r[0] for r in out} == set(base)
    if dups != "keep":
        assert len(out) == len({r[0] for r in out})


@SETTINGS
@given(details_st, st.randoms(use_true_random=False))
def test_latest_per_key_matches_brute_force(spark, details, rnd):
    rows = [(k, reg, d, act) for k, reg, d, act in details]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    schema = "K int, REGION string, D date, ACT string"
    got = sorted(map(tuple, latest_per_key(spark.createDataFrame(shuffled, schema), ["K"], ["D"]).collect()),
                 key=repr)

    def rank(row):
        # Largest D first, NULL last; then remaining columns, largest first, NULL last.
        k, reg, d, act = row
        return ((d is not None, d or dt.date.min), (reg is not None, reg or ""), (act is not None, act or ""))

    best = {}
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    assert got == sorted(best.values(), key=repr)


pairs = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["x", "y"]))), max_size=10)


@SETTINGS
@given(pairs, pairs)
def test_frame_diff_is_multiset_difference(spark, left, right):
    schema = "K int, V string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = {(r.K, r.V, r.diff_side): r.diff_rows for r in Q.frame_diff(a, b).collect()}
    ca, cb = collections.Counter(left), collections.Counter(right)
    want = {}
    for key, n in (ca - cb).items():
        want[key + ("left_only",)] = n
    for key, n in (cb - ca).items():
        want[key + ("right_only",)] = n
    assert got == want
    s = Q.diff_summary(a, b).first()
    assert (s.rows_left, s.rows_right, s.differing_rows) == (len(left), len(right), sum(want.values()))


@SETTINGS
@given(pairs)
def test_strict_implies_lenient_and_profile_counts(spark, rows):
    df = spark.createDataFrame(rows, "K int, V string")
    v = Q.verdict(Q.profile(df, "T")).first()
    assert (not v.passed_strict) or v.passed_lenient
    assert v.row_count == len(rows)
    assert v.null_cells == sum(1 for _, val in rows if val is None)


rule_rows = st.lists(
    st.tuples(
        st.integers(1, 6),
        st.one_of(st.none(), st.sampled_from(["AFRICA", "ASIA", "Mars", "x" * 60])),
        st.one_of(st.none(), st.sampled_from(["Y", "N", "X"])),
        st.one_of(st.none(), st.sampled_from(["12", "abc", "7x"])),
    ),
    max_size=12,
)


@SETTINGS
@given(rule_rows)
def test_violations_match_row_by_row_rules(spark, data):
    from pyspark.sql import functions as F

    from ledgerlens.functions import columns as C

    df = spark.createDataFrame(data, "K int, REGION string, ACT string, REF string")
    rules = [
        Q.Rule("domain", C.outside_domain(F.col("REGION"), ["AFRICA", "ASIA"]), F.col("REGION")),
        Q.Rule("length", C.longer_than(F.col("REGION"), 50), F.col("REGION")),
        Q.Rule("flag", C.outside_domain(F.col("ACT"), C.ACTIVE_FLAGS), F.col("ACT")),
        Q.Rule("ref", C.not_convertible(F.col("REF"), "int"), F.col("REF")),
    ]
    got = collections.Counter(tuple(r) for r in Q.violations(df, ["K"], rules).collect())
    want = collections.Counter()
    for k, region, act, ref in data:
        if region is not None and region not in ("AFRICA", "ASIA"):
            want[(k, "domain", region)] += 1
        if region is not None and len(region) > 50:
            want[(k, "length", region)] += 1
        if act is not None and act not in ("Y", "N"):
            want[(k, "flag", act)] += 1
        if ref is not None and not ref.isdigit():
            want[(k, "ref", ref)] += 1
    assert got == want
    counts = {r.rule: r.violations for r in Q.violation_counts(df, "T", rules).collect()}
    for name in ("domain", "length", "flag", "ref"):
        assert counts[name] == sum(n for (k, rule, v), n in want.items() if rule == name)


@SETTINGS
@given(st.lists(st.integers(1, 6), max_size=8), st.lists(st.integers(1, 8), max_size=10))
def test_coverage_matches_brute_force(spark, branches, details):
    b = spark.createDataFrame([(x,) for x in branches], "BRANCH_ID long")
    d = spark.createDataFrame([(x,) for x in details], "BRANCH_ID int")
    lit_ = Q.coverage(b, d).first()
    total = sum(max(1, details.count(x)) for x in branches)
    present = sum(details.count(x) for x in branches)
    assert (lit_.total_branches, lit_.branches_with_operational_details) == (total, present)
    dis = Q.coverage(b, d, distinct=True).first()
    assert dis.total_branches == len(set(branches))
    assert dis.branches_with_operational_details == len(set(branches) & set(details))
