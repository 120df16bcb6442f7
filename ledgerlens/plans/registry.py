"""The registered queries: one Spark plan per operator key of SURVEY §2.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables at that scale.  ``ledgerlens.plans.oracle.ORACLE_SQL`` holds
the DuckDB equivalent under the same key with the same column names.

Sink keys write to managed tables in a scratch database of the running
application (in the shared ``spark.checkpoint.dir`` folder when the session
names one, else under the warehouse directory), read them back, and return
the table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerlens.functions import columns as C
from ledgerlens.operators import migrate as M
from ledgerlens.operators import quality as Q
from ledgerlens.operators import reports as R
from ledgerlens.operators.dedupe import latest_per_key
from ledgerlens.schemas import BRANCH_SUMMARY_V1, BRANCH_SUMMARY_V2, CHECKS, DEFAULTS, REQUIRED_COLUMNS, SOURCES
from ledgerlens.session import concurrently
from ledgerlens.sources import landing, publish
from ledgerlens.sources import tables as T
from ledgerlens.sources import testdata as td

SCRATCH_DB = "ledgerlens_scratch"

Query = Callable[[SparkSession, str], DataFrame]


def _e(spark: SparkSession, sf_dir: str) -> td.Entities:
    # Defined anew for each query, so rewritten input is never read stale.
    return td.load_entities(spark, sf_dir)


def _summary(e: td.Entities) -> DataFrame:
    return R.branch_summary(e.transaction, e.account, e.branch)


def _enriched(e: td.Entities) -> DataFrame:
    return R.enrich_summary(_summary(e), e.details)


def _aml(e: td.Entities) -> DataFrame:
    return R.aml_customer_transactions(e.customer, e.account, e.transaction)


def _entity_frames(e: td.Entities) -> dict[str, DataFrame]:
    return {
        "CUSTOMER": e.customer,
        "ACCOUNT": e.account,
        "TRANSACTION": e.transaction,
        "BRANCH": e.branch,
        "BRANCH_OPERATIONAL_DETAILS": e.details,
        "AML_CUSTOMER_TRANSACTIONS": _aml(e),
        "BRANCH_SUMMARY_REPORT": _enriched(e),
    }


def _scratch(spark: SparkSession, name: str) -> str:
    """A managed table name in this application's own scratch database.

    One database per Spark application: a later application with a fresh
    catalog never meets table folders left by an earlier one (Spark refuses
    to create a managed table over an existing location).
    """
    app = re.sub(r"[^0-9A-Za-z]", "_", spark.conf.get("spark.app.id"))
    db = f"{SCRATCH_DB}_{app}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        # The shared folder the cluster names for intermediate data.
        location = f"{shared.rstrip('/')}/{db}.db".replace("'", "''")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return f"{db}.{name}"


# ---- reports ----------------------------------------------------------------


def q_aml(spark, sf_dir):
    return _aml(_e(spark, sf_dir))


def q_aml_split_hot(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.aml_customer_transactions(e.customer, e.account, e.transaction, salt_hot_accounts=True)


def q_aml_salted(spark, sf_dir):
    # A threshold that very many accounts of the test tables exceed, so that
    # the rows really go through several salts.
    e = _e(spark, sf_dir)
    return R.aml_customer_transactions(e.customer, e.account, e.transaction, salt_hot_accounts=True, rows_per_salt=6)


def q_branch_summary(spark, sf_dir):
    return _summary(_e(spark, sf_dir))


def q_branch_summary_join_first(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.branch_summary(e.transaction, e.account, e.branch, eager=False)


def q_enriched(spark, sf_dir):
    return _enriched(_e(spark, sf_dir))


def q_enriched_reject_future(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_summary(e), e.details, future_audit="reject", as_of=td.AS_OF)


def q_enriched_flag_future(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_summary(e), e.details, future_audit="flag", as_of=td.AS_OF)


def q_branch_summary_broadcast(spark, sf_dir):
    """The branch side is broadcast after its rows and bytes are counted."""
    e = _e(spark, sf_dir)
    return R.branch_summary(e.transaction, e.account, e.branch, broadcast_branch=True)


def q_left_no_rule(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_summary(e), e.details, active_rule="none", duplicates="keep")


def q_case_active(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_summary(e), e.details, how="inner", active_rule="case", duplicates="keep")


def q_all_branches(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.all_branches(_summary(e), e.branch)


def q_all_branches_enriched(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(R.all_branches(_summary(e), e.branch), e.details)


def q_flat(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.branch_summary_flat(e.transaction_flat, e.branch_flat)


def q_summary_empty_details(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_summary(e), e.details.where(F.lit(False)))


def q_latest_details(spark, sf_dir):
    e = _e(spark, sf_dir)
    return latest_per_key(e.details, ["BRANCH_ID"], ["LAST_AUDIT_DATE"])


def q_active_details(spark, sf_dir):
    d = _e(spark, sf_dir).details
    return d.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("IS_ACTIVE") == "Y").alias("active_records"),
    )


def q_cast_audit_date(spark, sf_dir):
    d = _e(spark, sf_dir).details
    return d.select("BRANCH_ID", C.date_text(d, "LAST_AUDIT_DATE").alias("LAST_AUDIT_DATE"))


def q_cast_branch_id(spark, sf_dir):
    return _e(spark, sf_dir).details.select(C.widen_key("BRANCH_ID"))


def q_region_bucket(spark, sf_dir):
    e = _e(spark, sf_dir)
    return M.region_buckets(e.branch, td.STATE_BUCKETS, td.STATE_BUCKET_DEFAULT)


def q_seed(spark, sf_dir):
    e = _e(spark, sf_dir)
    return M.seed_details(
        e.branch, e.details, as_of=td.AS_OF, buckets=td.STATE_BUCKETS, default=td.STATE_BUCKET_DEFAULT
    )


def q_coverage(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.coverage(e.branch, e.details)


def q_coverage_distinct(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.coverage(e.branch, e.details, distinct=True)


def q_completeness(spark, sf_dir):
    return Q.report_completeness(_enriched(_e(spark, sf_dir)))


def q_before_after(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.before_after_counts(_summary(e), _enriched(e))


# ---- quality ------------------------------------------------------------------


def _profile_query(table_name: str) -> Query:
    def run(spark, sf_dir):
        return Q.profile(_entity_frames(_e(spark, sf_dir))[table_name], table_name)

    return run


REPORTS = ["AML_CUSTOMER_TRANSACTIONS", "BRANCH_SUMMARY_REPORT"]


def _observed_verdicts(spark: SparkSession, frames: dict[str, DataFrame]) -> list[dict]:
    """Verdicts of all frames: sources from one profile each, in one job; each
    report observed while it is written, all at the same time."""

    def write(name: str) -> list[dict]:
        observed, observation = Q.observed_profile(frames[name], name)
        T.write_table(observed, _scratch(spark, f"{name.lower()}_observed"))
        return [Q.verdict_from_observation(name, frames[name].columns, observation)]

    def sources() -> list[dict]:
        profiles = [Q.profile(df, name) for name, df in frames.items() if name not in REPORTS]
        return [r.asDict() for r in Q.verdict(reduce(DataFrame.unionByName, profiles)).collect()]  # a row per table

    found = concurrently(spark, sources, *(lambda name=name: write(name) for name in REPORTS))
    return [v for each in found for v in each]


def q_verdict(spark, sf_dir):
    return Q.verdict_frame(spark, _observed_verdicts(spark, _entity_frames(_e(spark, sf_dir))))


def _details_rules(spark, sf_dir, rules: Callable[[], list[Q.Rule]]):
    return Q.violations(_e(spark, sf_dir).details, ["BRANCH_ID"], rules())


def q_domain(spark, sf_dir):
    return _details_rules(
        spark,
        sf_dir,
        lambda: [
            Q.Rule("region_domain", C.outside_domain(F.col("REGION"), td.VALID_REGIONS), F.col("REGION")),
            Q.Rule("active_flag_domain", C.outside_domain(F.col("IS_ACTIVE"), C.ACTIVE_FLAGS), F.col("IS_ACTIVE")),
        ],
    )


def q_future(spark, sf_dir):
    return _details_rules(
        spark,
        sf_dir,
        lambda: [
            Q.Rule("audit_date_in_future", C.after(F.col("LAST_AUDIT_DATE"), td.AS_OF), F.col("LAST_AUDIT_DATE"))
        ],
    )


def q_manager_format(spark, sf_dir):
    return _details_rules(
        spark,
        sf_dir,
        lambda: [Q.Rule("manager_name_format", C.not_matching(F.col("MANAGER_NAME")), F.col("MANAGER_NAME"))],
    )


def q_length(spark, sf_dir):
    return _details_rules(
        spark,
        sf_dir,
        lambda: [
            Q.Rule("region_length", C.longer_than(F.col("REGION"), 50), F.col("REGION")),
            Q.Rule("manager_name_length", C.longer_than(F.col("MANAGER_NAME"), 100), F.col("MANAGER_NAME")),
        ],
    )


def q_conversion(spark, sf_dir):
    return _details_rules(
        spark,
        sf_dir,
        lambda: [Q.Rule("branch_ref_not_int", C.not_convertible(F.col("BRANCH_REF"), "int"), F.col("BRANCH_REF"))],
    )


def q_required(spark, sf_dir):
    e = _e(spark, sf_dir)

    def required(col):
        return Q.Rule(f"{col}_required", C.is_missing(F.col(col)), F.col(col))

    def not_negative(col):
        return Q.Rule(f"{col}_not_negative", C.negative(F.col(col)), F.col(col))

    parts = [
        Q.violation_counts(e.customer, "CUSTOMER", [required("NAME")]),
        Q.violation_counts(e.branch, "BRANCH", [required("BRANCH_NAME")]),
        Q.violation_counts(e.transaction, "TRANSACTION", [required("TRANSACTION_TYPE"), required("AMOUNT")]),
        Q.violation_counts(e.details, "BRANCH_OPERATIONAL_DETAILS", [required("REGION")]),
        Q.violation_counts(
            _enriched(e),
            "BRANCH_SUMMARY_REPORT",
            [required("BRANCH_NAME"), not_negative("TOTAL_TRANSACTIONS"), not_negative("TOTAL_AMOUNT")],
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_orphans(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.missing_parents(e.details, e.branch, ["BRANCH_ID"])


def q_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_e(spark, sf_dir).details, ["BRANCH_ID"])


def q_duplicate_txn_ids(spark, sf_dir):
    return Q.duplicate_keys(_e(spark, sf_dir).transaction, ["TRANSACTION_ID"])


def q_ref_integrity(spark, sf_dir):
    """Transactions are read once, into their totals per account, which the
    report and the check share; ACCOUNT is built once."""
    e = _e(spark, sf_dir)
    totals, account = _scratch(spark, "account_totals"), _scratch(spark, "account_keys")
    concurrently(
        spark,
        lambda: T.write_table(R.account_totals(e.transaction), totals),
        lambda: T.write_table(e.account.select("ACCOUNT_ID", "CUSTOMER_ID", "BRANCH_ID"), account),
    )
    per_account, a, b, d = T.read_table(spark, totals), T.read_table(spark, account), e.branch, e.details
    return Q.integrity_report(
        [
            Q.Edge("transaction_account", per_account, a, ["ACCOUNT_ID"], rows="_n"),
            Q.Edge("account_customer", a, e.customer, ["CUSTOMER_ID"]),
            Q.Edge("account_branch", a, b, ["BRANCH_ID"]),
            Q.Edge("details_branch", d, b, ["BRANCH_ID"]),
            Q.Edge("summary_details", R.summary_of_totals(per_account, a, b), d, ["BRANCH_ID"]),
        ]
    )


def q_key_equality(spark, sf_dir):
    e = _e(spark, sf_dir)
    keys = R.branch_keys_with_transactions(e.transaction, e.account)
    return Q.key_set_compare(_summary(e), keys, ["BRANCH_ID"])


def _reconciled(e: td.Entities, written: DataFrame) -> DataFrame:
    # The detail side joins first and aggregates last: another plan than the
    # one the written report came from.
    detail = e.transaction.select("ACCOUNT_ID", "AMOUNT").join(e.account.select("ACCOUNT_ID", "BRANCH_ID"), "ACCOUNT_ID")
    return Q.reconcile(written, detail, ["BRANCH_ID"])


def q_reconcile(spark, sf_dir):
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_reconciled")
    T.write_table(_summary(e), name)
    return _reconciled(e, T.read_table(spark, name))


def q_reconcile_corrupted(spark, sf_dir):
    """The written report with wrong rows: every third branch one transaction
    short, every fifth off by one cent more than the tolerance, every seventh gone."""
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_corrupted")
    wrong = _summary(e).where(F.col("BRANCH_ID") % 7 != 0).select(
        "BRANCH_ID",
        "BRANCH_NAME",
        F.when(F.col("BRANCH_ID") % 3 == 0, F.col("TOTAL_TRANSACTIONS") - 1).otherwise(F.col("TOTAL_TRANSACTIONS")).alias("TOTAL_TRANSACTIONS"),
        F.when(F.col("BRANCH_ID") % 5 == 0, F.col("TOTAL_AMOUNT") + 0.02).otherwise(F.col("TOTAL_AMOUNT")).alias("TOTAL_AMOUNT"),
    )
    T.write_table(wrong, name)
    out = _reconciled(e, T.read_table(spark, name))
    return out.where(~(F.col("counts_match") & F.col("amounts_match"))).select(
        "BRANCH_ID", "summary_count", "detail_count", "counts_match", "amounts_match"
    )


def q_amount_totals(spark, sf_dir):
    return Q.amount_totals(_e(spark, sf_dir).transaction)


def q_row_counts(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.count_match(e.transaction, _aml(e), "TRANSACTION", "AML_CUSTOMER_TRANSACTIONS")


def q_distinct_keys(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.branch_keys_with_transactions(e.transaction, e.account)


def q_stage_metrics(spark, sf_dir):
    """Q17: the counts that come with the verdicts."""
    counts = [(v["table_name"], v["row_count"]) for v in _observed_verdicts(spark, _entity_frames(_e(spark, sf_dir)))]
    return spark.createDataFrame(counts, "stage string, record_count bigint")


def q_schema_checks(spark, sf_dir):
    """Q3-Q5 on the written reports: the enriched one against its layout (all
    equal) and against the former one (columns added), and one with a renamed
    and a retyped column against its layout."""
    e = _e(spark, sf_dir)
    good, bad = _scratch(spark, "branch_summary_report_schema"), _scratch(spark, "branch_summary_report_drifted")
    T.write_table(_enriched(e), good)
    written = T.read_table(spark, good)
    drifted = written.withColumnRenamed("REGION", "AREA").withColumn("TOTAL_TRANSACTIONS", F.col("TOTAL_TRANSACTIONS").cast("int"))
    T.write_table(drifted, bad)
    out = Q.schema_diff(written, BRANCH_SUMMARY_V2, "BRANCH_SUMMARY_REPORT")
    out = out.unionByName(Q.schema_diff(written, BRANCH_SUMMARY_V1, "BRANCH_SUMMARY_REPORT as v1"))
    return out.unionByName(Q.schema_diff(T.read_table(spark, bad), BRANCH_SUMMARY_V2, "drifted"))


# ---- landing and publication --------------------------------------------------


def _landed(spark: SparkSession, e: td.Entities, name: str) -> tuple[DataFrame, DataFrame]:
    return landing.land(e.transaction, e.account, _scratch(spark, name))[:2]


def q_aml_landed(spark, sf_dir):
    """The AML report from landed tables, its fact side read by bucket."""
    e = _e(spark, sf_dir)
    transaction, account = _landed(spark, e, "aml_landed")
    return R.aml_customer_transactions(e.customer, account, transaction, account_keys=landing.LANDED_KEYS)


def q_summary_landed(spark, sf_dir):
    """The branch summary from landed tables."""
    e = _e(spark, sf_dir)
    transaction, account = _landed(spark, e, "summary_landed")
    return R.branch_summary(transaction, account, e.branch, account_keys=landing.LANDED_KEYS)


def q_published(spark, sf_dir):
    """The reports published twice, first v1 and then v2; what the views
    show is the second, read through them."""
    e = _e(spark, sf_dir)
    names = [_scratch(spark, "published_summary"), _scratch(spark, "published_active_details")]
    publish.unpublish(spark, names)
    details = e.details.where(F.col("IS_ACTIVE") == "Y")
    for run, frames in (("first", [_summary(e), e.details]), ("second", [_enriched(e), details])):
        for name, df in zip(names, frames):
            version = publish.version_name(name, run)
            T.drop_table(spark, version)
            T.write_table(df, version)
        publish.publish(spark, names, run)
    active = T.read_table(spark, names[1]).select("BRANCH_ID").distinct().withColumn("HAS_ACTIVE_DETAILS", F.lit(True))
    report = T.read_table(spark, names[0])
    return report.join(active, "BRANCH_ID", "left").withColumn("HAS_ACTIVE_DETAILS", F.coalesce("HAS_ACTIVE_DETAILS", F.lit(False)))


# ---- constraints ----------------------------------------------------------------


def _source_table(spark: SparkSession, source: str, suffix: str, frame: DataFrame) -> str:
    """An empty table of the source's columns that the frame has, wide keys, with
    the DDL's defaults and rules."""
    name = _scratch(spark, f"{source.lower()}_{suffix}")
    T.drop_table(spark, name)
    have = {f.name: f.dataType for f in frame.schema.fields}
    fields = [StructField(f.name, have.get(f.name, f.dataType)) for f in SOURCES[source].fields]
    T.create_table(
        spark, name, StructType(fields), defaults=DEFAULTS.get(source), not_null=REQUIRED_COLUMNS.get(source, []), checks=CHECKS.get(source)
    )
    return name


def _source_batches(e: td.Entities) -> dict[str, tuple[DataFrame, list[str]]]:
    """Per source table a batch without the columns that have defaults, cut to
    rows that hold every required value."""
    batches = {}
    for source, df in {"CUSTOMER": e.customer, "BRANCH": e.branch, "ACCOUNT": e.account, "TRANSACTION": e.transaction, "BRANCH_OPERATIONAL_DETAILS": e.details_flat}.items():
        wanted = [f.name for f in SOURCES[source].fields if f.name in df.columns and f.name not in DEFAULTS.get(source, {})]
        batches[source] = (df.select(*wanted), wanted)
    return batches


def q_insert_accepted(spark, sf_dir):
    """Batches for all five source tables, defaults filled in; one row
    per table with its rows and those in which every default column has its default."""
    out = None
    for source, (df, columns) in _source_batches(_e(spark, sf_dir)).items():
        name = _source_table(spark, source, "checked", df)
        required = [F.col(c).isNotNull() for c in REQUIRED_COLUMNS.get(source, [])]
        T.insert_checked(df.where(reduce(lambda a, b: a & b, required, F.lit(True))), name, columns)
        filled = [F.col(c).isNotNull() if d == "CURRENT_DATE" else F.col(c) == F.expr(d) for c, d in DEFAULTS.get(source, {}).items()]
        one = T.read_table(spark, name).agg(F.count(F.lit(1)).alias("table_rows"), F.count_if(reduce(lambda a, b: a & b, filled, F.lit(True))).alias("rows_with_defaults"))
        one = one.select(F.lit(source).alias("table_name"), "table_rows", "rows_with_defaults")
        out = one if out is None else out.unionByName(one)
    return out


def q_insert_refused(spark, sf_dir):
    """Batches with rows that break rules (every seventh branch without
    a name; flags outside the domain and missing regions as the details have
    them) are refused whole; one row per broken rule, and the table's rows after."""
    e = _e(spark, sf_dir)
    branch = e.branch_flat.withColumn("BRANCH_NAME", F.when(F.col("BRANCH_ID") % 7 != 0, F.col("BRANCH_NAME")))
    details = e.details_flat.select("BRANCH_ID", "REGION", "MANAGER_NAME", "LAST_AUDIT_DATE", "IS_ACTIVE")
    rows = []
    for source, df in (("BRANCH", branch), ("BRANCH_OPERATIONAL_DETAILS", details)):
        name = _source_table(spark, source, "refused", df)
        columns = [c for c in df.columns if c in SOURCES[source].fieldNames()]
        try:
            T.insert_checked(df, name, columns)
            broken = {}
        except T.RefusedBatch as refused:
            broken = refused.broken
        left = T.read_table(spark, name).count()
        rows += [(source, rule, n, left) for rule, n in sorted(broken.items())]
    return spark.createDataFrame(rows, "table_name string, rule string, refused_rows bigint, table_rows bigint")


# ---- supplier grain: the same operators on details that grow with the data ----


def _flat_summary(e: td.Entities) -> DataFrame:
    return R.branch_summary_flat(e.transaction_flat, e.branch_flat)


def _detail_rules() -> list[Q.Rule]:
    col = F.col
    return [
        Q.Rule("region_domain", C.outside_domain(col("REGION"), td.VALID_REGIONS), col("REGION")),
        Q.Rule("active_flag_domain", C.outside_domain(col("IS_ACTIVE"), C.ACTIVE_FLAGS), col("IS_ACTIVE")),
        Q.Rule("audit_date_in_future", C.after(col("LAST_AUDIT_DATE"), td.AS_OF), col("LAST_AUDIT_DATE")),
        Q.Rule("manager_name_format", C.not_matching(col("MANAGER_NAME")), col("MANAGER_NAME")),
        Q.Rule("region_length", C.longer_than(col("REGION"), 50), col("REGION")),
        Q.Rule("manager_name_length", C.longer_than(col("MANAGER_NAME"), 100), col("MANAGER_NAME")),
        Q.Rule("branch_ref_not_int", C.not_convertible(col("BRANCH_REF"), "bigint"), col("BRANCH_REF")),
    ]


def q_flat_enriched(spark, sf_dir):
    e = _e(spark, sf_dir)
    return R.enrich_summary(_flat_summary(e), e.details_flat)


def q_latest_by_supplier(spark, sf_dir):
    return latest_per_key(_e(spark, sf_dir).details_flat, ["BRANCH_ID"], ["LAST_AUDIT_DATE"])


def q_active_by_supplier(spark, sf_dir):
    d = _e(spark, sf_dir).details_flat
    return d.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("IS_ACTIVE") == "Y").alias("active_records"),
    )


def q_rules_by_supplier(spark, sf_dir):
    return Q.violations(_e(spark, sf_dir).details_flat, ["BRANCH_ID"], _detail_rules())


def q_orphans_by_supplier(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.missing_parents(e.details_flat, e.branch_flat, ["BRANCH_ID"])


def q_duplicates_by_supplier(spark, sf_dir):
    return Q.duplicate_keys(_e(spark, sf_dir).details_flat, ["BRANCH_ID"])


def q_coverage_by_supplier(spark, sf_dir):
    e = _e(spark, sf_dir)
    return Q.coverage(e.branch_flat, e.details_flat)


def q_seed_by_supplier(spark, sf_dir):
    e = _e(spark, sf_dir)
    return M.seed_details(
        e.branch_flat, e.details_flat, as_of=td.AS_OF, buckets=td.STATE_BUCKETS, default=td.STATE_BUCKET_DEFAULT
    )


def q_integrity_by_supplier(spark, sf_dir):
    e = _e(spark, sf_dir)
    transaction, branch, details = e.transaction_flat, e.branch_flat, e.details_flat
    return Q.integrity_report(
        [
            Q.Edge("transaction_branch", transaction, branch, ["BRANCH_ID"]),
            Q.Edge("details_branch", details, branch, ["BRANCH_ID"]),
            Q.Edge("summary_details", R.branch_summary_flat(transaction, branch), details, ["BRANCH_ID"]),
        ]
    )


def q_region_bucket_by_supplier(spark, sf_dir):
    e = _e(spark, sf_dir)
    return M.region_buckets(e.branch_flat, td.STATE_BUCKETS, td.STATE_BUCKET_DEFAULT)


def q_cast_audit_date_by_supplier(spark, sf_dir):
    d = _e(spark, sf_dir).details_flat
    return d.select("BRANCH_ID", C.date_text(d, "LAST_AUDIT_DATE").alias("LAST_AUDIT_DATE"))


def q_profile_by_supplier(spark, sf_dir):
    return Q.profile(_e(spark, sf_dir).details_flat, "BRANCH_OPERATIONAL_DETAILS_BY_SUPPLIER")


# ---- sinks ----------------------------------------------------------------------


def q_sink_summary(spark, sf_dir):
    name = _scratch(spark, "branch_summary_report_v1")
    T.write_table(_summary(_e(spark, sf_dir)), name)
    return T.read_table(spark, name)


def q_sink_aml(spark, sf_dir):
    name = _scratch(spark, "aml_customer_transactions")
    T.write_table(_aml(_e(spark, sf_dir)), name)
    return T.read_table(spark, name)


def q_sink_evolve(spark, sf_dir):
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_evolve")
    T.write_table(_summary(e), name)
    T.write_table(_enriched(e), name, evolve=True)
    return T.read_table(spark, name)


def q_sink_constant_column(spark, sf_dir):
    """A constant column added to a report by an evolving write."""
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_constant")
    T.write_table(_summary(e), name)
    T.write_table(_summary(e).withColumn("REPORT_VERSION", F.lit("v2")), name, evolve=True)
    return T.read_table(spark, name)


def q_sink_evolve_narrow(spark, sf_dir):
    """The new frame lacks two columns of the table, which keeps them as NULL."""
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_narrow")
    T.write_table(_enriched(e), name)
    T.write_table(_summary(e), name, evolve=True)
    return T.read_table(spark, name)


def q_seed_append(spark, sf_dir):
    """Details of branches that have none are appended to the table."""
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_operational_details_seeded")
    columns = ["BRANCH_ID", "REGION", "MANAGER_NAME", "LAST_AUDIT_DATE", "IS_ACTIVE"]
    T.write_table(e.details_flat.select(*columns), name)
    seeded = M.seed_details(
        e.branch_flat, T.read_table(spark, name), as_of=td.AS_OF, buckets=td.STATE_BUCKETS, default=td.STATE_BUCKET_DEFAULT
    )
    T.insert_columns(seeded, name, columns)
    return T.read_table(spark, name)


def q_staged(spark, sf_dir):
    name = _scratch(spark, "branch_summary_report_staged")
    T.staged_overwrite(_enriched(_e(spark, sf_dir)), name, check=lambda df: Q.passes(df, name))
    return T.read_table(spark, name)


def q_insert_defaults(spark, sf_dir):
    name = _scratch(spark, "account_with_defaults")
    T.drop_table(spark, name)
    T.create_table(
        spark,
        name,
        "ACCOUNT_ID BIGINT, CUSTOMER_ID BIGINT, BRANCH_ID BIGINT, ACCOUNT_TYPE STRING, "
        "BALANCE DECIMAL(15,2) DEFAULT 0, OPENED_DATE DATE DEFAULT CURRENT_DATE",
    )
    account = _e(spark, sf_dir).account
    T.insert_columns(account, name, ["ACCOUNT_ID", "CUSTOMER_ID", "BRANCH_ID", "ACCOUNT_TYPE"])
    # OPENED_DATE holds CURRENT_DATE and is left out of the compared output.
    return T.read_table(spark, name).drop("OPENED_DATE")


def q_backup_restore(spark, sf_dir):
    target = _scratch(spark, "branch_summary_report_rb")
    backup = _scratch(spark, "branch_summary_report_rb_backup")
    T.write_table(_enriched(_e(spark, sf_dir)), target)
    T.backup_table(spark, target, backup)
    T.restore_table(spark, backup, target, BRANCH_SUMMARY_V1)
    return T.read_table(spark, target)


def q_alter_add(spark, sf_dir):
    name = _scratch(spark, "branch_summary_report_alter")
    T.write_table(_summary(_e(spark, sf_dir)), name)
    T.add_columns(spark, name, "REGION STRING, LAST_AUDIT_DATE STRING")
    return T.read_table(spark, name)


def q_rerun(spark, sf_dir):
    e = _e(spark, sf_dir)
    name = _scratch(spark, "branch_summary_report_rerun")
    first = _scratch(spark, "branch_summary_report_rerun_first")
    T.write_table(_enriched(e), name)
    T.backup_table(spark, name, first)
    T.write_table(_enriched(e), name)
    return Q.compare_frames(T.read_table(spark, first), T.read_table(spark, name))


QUERIES: dict[str, Query] = {
    "aml_customer_transactions": q_aml,
    "aml_customer_transactions_split_hot": q_aml_split_hot,
    "aml_customer_transactions_salted": q_aml_salted,
    "branch_summary": q_branch_summary,
    "branch_summary_join_first": q_branch_summary_join_first,
    "branch_summary_enriched": q_enriched,
    "branch_summary_left_no_rule": q_left_no_rule,
    "branch_summary_enriched_reject_future": q_enriched_reject_future,
    "branch_summary_enriched_flag_future": q_enriched_flag_future,
    "branch_summary_broadcast": q_branch_summary_broadcast,
    "branch_summary_case_active": q_case_active,
    "branch_summary_all_branches": q_all_branches,
    "branch_summary_all_branches_enriched": q_all_branches_enriched,
    "branch_summary_flat": q_flat,
    "summary_empty_details": q_summary_empty_details,
    "latest_details": q_latest_details,
    "active_details": q_active_details,
    "cast_audit_date": q_cast_audit_date,
    "cast_branch_id": q_cast_branch_id,
    "region_bucket": q_region_bucket,
    "seed_missing_details": q_seed,
    "details_coverage": q_coverage,
    "details_coverage_distinct": q_coverage_distinct,
    "report_completeness": q_completeness,
    "before_after_counts": q_before_after,
    "quality_verdict": q_verdict,
    "domain_violations": q_domain,
    "future_audit_dates": q_future,
    "manager_name_format": q_manager_format,
    "length_violations": q_length,
    "conversion_errors": q_conversion,
    "required_violations": q_required,
    "orphan_details": q_orphans,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_transaction_ids": q_duplicate_txn_ids,
    "ref_integrity": q_ref_integrity,
    "summary_key_equality": q_key_equality,
    "reconcile_summary": q_reconcile,
    "reconcile_corrupted_summary": q_reconcile_corrupted,
    "amount_totals": q_amount_totals,
    "row_counts": q_row_counts,
    "distinct_branch_keys": q_distinct_keys,
    "stage_metrics": q_stage_metrics,
    "branch_summary_flat_enriched": q_flat_enriched,
    "latest_details_by_supplier": q_latest_by_supplier,
    "active_details_by_supplier": q_active_by_supplier,
    "details_rules_by_supplier": q_rules_by_supplier,
    "orphan_details_by_supplier": q_orphans_by_supplier,
    "duplicate_keys_by_supplier": q_duplicates_by_supplier,
    "details_coverage_by_supplier": q_coverage_by_supplier,
    "seed_missing_details_by_supplier": q_seed_by_supplier,
    "ref_integrity_by_supplier": q_integrity_by_supplier,
    "null_profile_details_by_supplier": q_profile_by_supplier,
    "region_bucket_by_supplier": q_region_bucket_by_supplier,
    "cast_audit_date_by_supplier": q_cast_audit_date_by_supplier,
    "sink_roundtrip_summary": q_sink_summary,
    "sink_roundtrip_aml": q_sink_aml,
    "sink_evolve_4_to_6": q_sink_evolve,
    "sink_constant_column": q_sink_constant_column,
    "sink_evolve_narrow_frame": q_sink_evolve_narrow,
    "seed_then_append": q_seed_append,
    "staged_write_summary": q_staged,
    "insert_with_defaults": q_insert_defaults,
    "backup_restore": q_backup_restore,
    "alter_add_columns": q_alter_add,
    "rerun_identical": q_rerun,
    "aml_customer_transactions_landed": q_aml_landed,
    "branch_summary_landed": q_summary_landed,
    "published_reports": q_published,
    "insert_checked_accepted": q_insert_accepted,
    "insert_checked_refused": q_insert_refused,
    "schema_checks": q_schema_checks,
}

for _table, _key in [
    ("CUSTOMER", "customer"),
    ("ACCOUNT", "account"),
    ("TRANSACTION", "transaction"),
    ("BRANCH", "branch"),
    ("BRANCH_OPERATIONAL_DETAILS", "details"),
    ("AML_CUSTOMER_TRANSACTIONS", "aml"),
    ("BRANCH_SUMMARY_REPORT", "summary"),
]:
    QUERIES[f"null_profile_{_key}"] = _profile_query(_table)
