"""Banking entities derived from the driver's TPC-H-like tables.

The driver tables hold no banking data; this module maps them onto the five
source entities (FIXTURES.md §3).  Every entity is a lazy DataFrame over the
parquet files, so column pruning and filters reach the scans and the work
grows with the scale factor.  ``oracle.ENTITY_CTES`` states the same mapping
in DuckDB SQL; the two must change together.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md §3).  Branch operational
# details come from nation x region with these deliberate defects:
DETAILS_SKIP_MODULUS = 7  # nations with n_nationkey % 7 = 0 have no details
NULL_REGION_AT = 3
NO_COMMA_MANAGER_AT = 8
LONG_MANAGER_AT = 13
NULL_AUDIT_AT = 4
FUTURE_AUDIT_AT = 6
FUTURE_AUDIT_DATE = "2999-01-01"
AUDIT_BASE_DATE = "2023-01-01"
AUDIT_STEP_DAYS = 15
INACTIVE_MODULUS = 5  # IS_ACTIVE = 'N' when n_nationkey % 5 = 0
BAD_FLAG_AT = 9  # IS_ACTIVE = 'X'
BAD_REF_AT = 12  # BRANCH_REF = 'invalid_id'
# Extra detail rows: an orphan and a second row for branch 1.
ORPHAN_ROW = (999, "ORPHAN", "Manager, ORPHAN", "2023-06-01", "Y", "999")
DUPLICATE_ROW = (1, "DUPLICATE", "Manager, DUPLICATE", "2024-06-01", "Y", "1")
# A branch with no accounts and so no transactions.
IDLE_BRANCH = (900, "NO_ACTIVITY")
# STATE -> region buckets used by the seeding operator on this data.
STATE_BUCKETS = {
    "West": ["NATION_0", "NATION_1", "NATION_2"],
    "East": ["NATION_7", "NATION_8", "NATION_9"],
    "South": ["NATION_14", "NATION_15", "NATION_16"],
}
STATE_BUCKET_DEFAULT = "Central"
VALID_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Supplier-grain details (grow with the scale factor): the same kinds of
# defects, placed by modulus rules on s_suppkey as (modulus, remainder).
FLAT_SKIP = (7, 0)
FLAT_NULL_REGION = (97, 3)
FLAT_NO_COMMA = (89, 8)
FLAT_LONG_MANAGER = (83, 13)
FLAT_NULL_AUDIT = (79, 4)
FLAT_FUTURE_AUDIT = (73, 6)
FLAT_BAD_FLAG = (71, 9)
FLAT_BAD_REF = (67, 12)
FLAT_DUPLICATE = (61, 1)
FLAT_ORPHAN = (59, 2)
FLAT_ORPHAN_OFFSET = 1_000_000_000
FLAT_AUDIT_SPAN_DAYS = 365
AS_OF = "2026-12-01"


# Declared schemas of the driver tables: reading with a schema skips the
# footer-based inference (a job per read).  A Parquet read with a given schema
# gives NULL for a column that was renamed, without an error, so the files' own
# column names are compared once per table and application.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


_CHECKED: set[tuple[str, str]] = set()


def _check_columns(spark: SparkSession, path: str, name: str) -> None:
    key = (spark.conf.get("spark.app.id"), path)
    if key in _CHECKED:
        return
    found = spark.read.parquet(path).columns
    missing = [c for c in (d.split()[0] for d in TABLE_SCHEMAS[name].split(", ")) if c not in found]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}; it has {found}")
    if len(_CHECKED) >= 256:
        _CHECKED.clear()
    _CHECKED.add(key)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if name not in TABLE_SCHEMAS:
        return spark.read.parquet(path)
    _check_columns(spark, path, name)
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("CUSTOMER_ID"),
        F.col("c_name").alias("NAME"),
    )


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are accounts; an account's branch is its customer's nation."""
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").alias("ACCOUNT_ID"),
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col("c_nationkey").cast("bigint").alias("BRANCH_ID"),
        F.col("o_orderpriority").alias("ACCOUNT_TYPE"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("BALANCE"),
        F.to_date("o_orderdate").alias("OPENED_DATE"),
    )


def _transaction_id() -> Column:
    # Not unique on purpose: (l_orderkey, l_linenumber) repeats in the data.
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("TRANSACTION_ID")


def transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _read(spark, sf_dir, "lineitem")
    return l.select(
        _transaction_id(),
        F.col("l_orderkey").alias("ACCOUNT_ID"),
        F.col("l_returnflag").alias("TRANSACTION_TYPE"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("AMOUNT"),
        F.to_date("l_shipdate").alias("TRANSACTION_DATE"),
    )


def transaction_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat grain (D9): the transaction carries its branch, the supplier."""
    l = _read(spark, sf_dir, "lineitem")
    return l.select(
        _transaction_id(),
        F.col("l_orderkey").alias("ACCOUNT_ID"),
        F.col("l_suppkey").alias("BRANCH_ID"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("AMOUNT"),
        F.to_date("l_shipdate").alias("TRANSACTION_DATE"),
    )


def branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    nations = n.select(
        F.col("n_nationkey").cast("bigint").alias("BRANCH_ID"),
        F.col("n_name").alias("BRANCH_NAME"),
        F.col("n_name").alias("STATE"),
    )
    idle_id, idle_name = IDLE_BRANCH
    idle = spark.range(1).select(
        F.lit(idle_id).cast("bigint").alias("BRANCH_ID"),
        F.lit(idle_name).alias("BRANCH_NAME"),
        F.lit(idle_name).alias("STATE"),
    )
    return nations.unionByName(idle)


def branch_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat-grain branches: suppliers; STATE is the supplier's nation name."""
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select(
        F.col("s_suppkey").alias("BRANCH_ID"),
        F.col("s_name").alias("BRANCH_NAME"),
        F.col("n_name").alias("STATE"),
    )


def _hit(rule: tuple[int, int], key: str = "s_suppkey") -> str:
    modulus, remainder = rule
    return f"{key} % {modulus} = {remainder}"


def branch_operational_details_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier-grain BRANCH_OPERATIONAL_DETAILS: one row per supplier (some
    skipped), defects placed by the FLAT_* rules, plus later duplicate rows
    and orphan rows derived from suppliers.  Grows with the scale factor."""
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    k = "s_suppkey"
    base = rows.where(f"NOT ({_hit(FLAT_SKIP)})").selectExpr(
        f"{k} AS BRANCH_ID",
        f"CASE WHEN {_hit(FLAT_NULL_REGION)} THEN CAST(NULL AS STRING) ELSE r_name END AS REGION",
        f"CASE WHEN {_hit(FLAT_NO_COMMA)} THEN 'NoComma' "
        f"WHEN {_hit(FLAT_LONG_MANAGER)} THEN concat('Long, ', repeat('x', 100)) "
        f"ELSE concat('Manager, ', s_name) END AS MANAGER_NAME",
        f"CASE WHEN {_hit(FLAT_NULL_AUDIT)} THEN CAST(NULL AS DATE) "
        f"WHEN {_hit(FLAT_FUTURE_AUDIT)} THEN DATE'{FUTURE_AUDIT_DATE}' "
        f"ELSE date_add(DATE'{AUDIT_BASE_DATE}', CAST({k} % {FLAT_AUDIT_SPAN_DAYS} AS INT)) END "
        f"AS LAST_AUDIT_DATE",
        f"CASE WHEN {_hit(FLAT_BAD_FLAG)} THEN 'X' WHEN {k} % {INACTIVE_MODULUS} = 0 THEN 'N' "
        f"ELSE 'Y' END AS IS_ACTIVE",
        f"CASE WHEN {_hit(FLAT_BAD_REF)} THEN 'invalid_id' ELSE CAST({k} AS STRING) END AS BRANCH_REF",
    )
    _, dup_region, dup_manager, dup_audit, dup_active, _ = DUPLICATE_ROW
    duplicates = rows.where(_hit(FLAT_DUPLICATE)).selectExpr(
        f"{k} AS BRANCH_ID",
        f"'{dup_region}' AS REGION",
        f"'{dup_manager}' AS MANAGER_NAME",
        f"DATE'{dup_audit}' AS LAST_AUDIT_DATE",
        f"'{dup_active}' AS IS_ACTIVE",
        f"CAST({k} AS STRING) AS BRANCH_REF",
    )
    _, orphan_region, orphan_manager, orphan_audit, orphan_active, _ = ORPHAN_ROW
    orphans = rows.where(_hit(FLAT_ORPHAN)).selectExpr(
        f"{k} + {FLAT_ORPHAN_OFFSET} AS BRANCH_ID",
        f"'{orphan_region}' AS REGION",
        f"'{orphan_manager}' AS MANAGER_NAME",
        f"DATE'{orphan_audit}' AS LAST_AUDIT_DATE",
        f"'{orphan_active}' AS IS_ACTIVE",
        f"CAST({k} + {FLAT_ORPHAN_OFFSET} AS STRING) AS BRANCH_REF",
    )
    return base.unionByName(duplicates).unionByName(orphans)


def branch_operational_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BRANCH_OPERATIONAL_DETAILS with the fixture's defects (see constants).

    Written as SQL expressions so the whole view is analysed in a few JVM
    calls; the two extra rows are one inline VALUES table.
    """
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    k = "n_nationkey"
    base = (
        n.join(r, n["n_regionkey"] == r["r_regionkey"])
        .where(f"{k} % {DETAILS_SKIP_MODULUS} <> 0")
        .selectExpr(
            f"CAST({k} AS INT) AS BRANCH_ID",
            f"CASE WHEN {k} = {NULL_REGION_AT} THEN CAST(NULL AS STRING) ELSE r_name END AS REGION",
            f"CASE WHEN {k} = {NO_COMMA_MANAGER_AT} THEN 'NoComma' "
            f"WHEN {k} = {LONG_MANAGER_AT} THEN concat('Long, ', repeat('x', 100)) "
            f"ELSE concat('Manager, ', n_name) END AS MANAGER_NAME",
            f"CASE WHEN {k} = {NULL_AUDIT_AT} THEN CAST(NULL AS DATE) "
            f"WHEN {k} = {FUTURE_AUDIT_AT} THEN DATE'{FUTURE_AUDIT_DATE}' "
            f"ELSE date_add(DATE'{AUDIT_BASE_DATE}', CAST({k} * {AUDIT_STEP_DAYS} AS INT)) END AS LAST_AUDIT_DATE",
            f"CASE WHEN {k} = {BAD_FLAG_AT} THEN 'X' WHEN {k} % {INACTIVE_MODULUS} = 0 THEN 'N' "
            f"ELSE 'Y' END AS IS_ACTIVE",
            f"CASE WHEN {k} = {BAD_REF_AT} THEN 'invalid_id' ELSE CAST({k} AS STRING) END AS BRANCH_REF",
        )
    )
    values = ", ".join(
        f"(CAST({bid} AS INT), '{region}', '{manager}', DATE'{audit}', '{active}', '{ref}')"
        for bid, region, manager, audit, active, ref in (ORPHAN_ROW, DUPLICATE_ROW)
    )
    extras = spark.sql(
        f"SELECT * FROM VALUES {values} "
        "AS t(BRANCH_ID, REGION, MANAGER_NAME, LAST_AUDIT_DATE, IS_ACTIVE, BRANCH_REF)"
    )
    return base.unionByName(extras)


class Entities:
    """The entities of one scale-factor directory, built on first use.

    Each attribute is a lazy DataFrame; building only what a query touches
    keeps driver-side planning cheap.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def _make(self, fn):
        return fn(self._spark, self._sf_dir)

    customer = cached_property(lambda self: self._make(customer))
    account = cached_property(lambda self: self._make(account))
    transaction = cached_property(lambda self: self._make(transaction))
    branch = cached_property(lambda self: self._make(branch))
    details = cached_property(lambda self: self._make(branch_operational_details))
    transaction_flat = cached_property(lambda self: self._make(transaction_flat))
    branch_flat = cached_property(lambda self: self._make(branch_flat))
    details_flat = cached_property(lambda self: self._make(branch_operational_details_flat))


def load_entities(spark: SparkSession, sf_dir: str) -> Entities:
    """All entities of one scale-factor directory, as lazy DataFrames."""
    return Entities(spark, sf_dir)
