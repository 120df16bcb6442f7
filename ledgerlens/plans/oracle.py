"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: plain joins, GROUP BY and
``row_number`` where Spark uses eager aggregation or ``max(struct)``.  The
entity CTEs restate ``sources.testdata`` in SQL; the two must change
together.  Every computed column is aliased to the Spark column name.
"""

from __future__ import annotations

from ledgerlens.functions.columns import MANAGER_NAME_PATTERN
from ledgerlens.sources import testdata as td

# Column lists of the entities and reports, in Spark output order.
ENTITY_COLUMNS = {
    "CUSTOMER": ("e_customer", ["CUSTOMER_ID", "NAME"]),
    "ACCOUNT": (
        "e_account",
        ["ACCOUNT_ID", "CUSTOMER_ID", "BRANCH_ID", "ACCOUNT_TYPE", "BALANCE", "OPENED_DATE"],
    ),
    "TRANSACTION": (
        "e_transaction",
        ["TRANSACTION_ID", "ACCOUNT_ID", "TRANSACTION_TYPE", "AMOUNT", "TRANSACTION_DATE"],
    ),
    "BRANCH": ("e_branch", ["BRANCH_ID", "BRANCH_NAME", "STATE"]),
    "BRANCH_OPERATIONAL_DETAILS": (
        "e_details",
        ["BRANCH_ID", "REGION", "MANAGER_NAME", "LAST_AUDIT_DATE", "IS_ACTIVE", "BRANCH_REF"],
    ),
    "AML_CUSTOMER_TRANSACTIONS": (
        "r_aml",
        [
            "CUSTOMER_ID",
            "NAME",
            "ACCOUNT_ID",
            "TRANSACTION_ID",
            "AMOUNT",
            "TRANSACTION_TYPE",
            "TRANSACTION_DATE",
        ],
    ),
    "BRANCH_SUMMARY_REPORT": (
        "r_enriched",
        ["BRANCH_ID", "BRANCH_NAME", "TOTAL_TRANSACTIONS", "TOTAL_AMOUNT", "REGION", "LAST_AUDIT_DATE"],
    ),
}
# Profiles registered on top of the seven above (not part of quality_verdict).
EXTRA_PROFILES = {
    "BRANCH_OPERATIONAL_DETAILS_BY_SUPPLIER": (
        "e_details_flat",
        ["BRANCH_ID", "REGION", "MANAGER_NAME", "LAST_AUDIT_DATE", "IS_ACTIVE", "BRANCH_REF"],
    ),
}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _details_cte() -> str:
    orphan, dup = td.ORPHAN_ROW, td.DUPLICATE_ROW

    def literal_row(row):
        bid, region, manager, audit, active, ref = row
        return (
            f"SELECT CAST({bid} AS INTEGER), {_q(region)}, {_q(manager)}, "
            f"DATE {_q(audit)}, {_q(active)}, {_q(ref)}"
        )

    return f"""e_details AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS BRANCH_ID,
    CASE WHEN n.n_nationkey = {td.NULL_REGION_AT} THEN NULL ELSE r.r_name END AS REGION,
    CASE WHEN n.n_nationkey = {td.NO_COMMA_MANAGER_AT} THEN 'NoComma'
         WHEN n.n_nationkey = {td.LONG_MANAGER_AT} THEN 'Long, ' || repeat('x', 100)
         ELSE 'Manager, ' || n.n_name END AS MANAGER_NAME,
    CASE WHEN n.n_nationkey = {td.NULL_AUDIT_AT} THEN NULL
         WHEN n.n_nationkey = {td.FUTURE_AUDIT_AT} THEN DATE {_q(td.FUTURE_AUDIT_DATE)}
         ELSE CAST(DATE {_q(td.AUDIT_BASE_DATE)} + n.n_nationkey * {td.AUDIT_STEP_DAYS} AS DATE) END
      AS LAST_AUDIT_DATE,
    CASE WHEN n.n_nationkey = {td.BAD_FLAG_AT} THEN 'X'
         WHEN n.n_nationkey % {td.INACTIVE_MODULUS} = 0 THEN 'N' ELSE 'Y' END AS IS_ACTIVE,
    CASE WHEN n.n_nationkey = {td.BAD_REF_AT} THEN 'invalid_id'
         ELSE CAST(n.n_nationkey AS VARCHAR) END AS BRANCH_REF
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey % {td.DETAILS_SKIP_MODULUS} <> 0
  UNION ALL {literal_row(orphan)}
  UNION ALL {literal_row(dup)}
)"""


def _hit(rule) -> str:
    modulus, remainder = rule
    return f"s.s_suppkey % {modulus} = {remainder}"


def _details_flat_cte() -> str:
    k = "s.s_suppkey"
    _, dup_region, dup_manager, dup_audit, dup_active, _ = td.DUPLICATE_ROW
    _, orph_region, orph_manager, orph_audit, orph_active, _ = td.ORPHAN_ROW
    rows = (
        "FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "JOIN region r ON n.n_regionkey = r.r_regionkey"
    )
    off = td.FLAT_ORPHAN_OFFSET
    return f"""e_details_flat AS (
  SELECT {k} AS BRANCH_ID,
    CASE WHEN {_hit(td.FLAT_NULL_REGION)} THEN NULL ELSE r.r_name END AS REGION,
    CASE WHEN {_hit(td.FLAT_NO_COMMA)} THEN 'NoComma'
         WHEN {_hit(td.FLAT_LONG_MANAGER)} THEN 'Long, ' || repeat('x', 100)
         ELSE 'Manager, ' || s.s_name END AS MANAGER_NAME,
    CASE WHEN {_hit(td.FLAT_NULL_AUDIT)} THEN NULL
         WHEN {_hit(td.FLAT_FUTURE_AUDIT)} THEN DATE {_q(td.FUTURE_AUDIT_DATE)}
         ELSE CAST(DATE {_q(td.AUDIT_BASE_DATE)} + CAST({k} % {td.FLAT_AUDIT_SPAN_DAYS} AS INTEGER) AS DATE)
    END AS LAST_AUDIT_DATE,
    CASE WHEN {_hit(td.FLAT_BAD_FLAG)} THEN 'X'
         WHEN {k} % {td.INACTIVE_MODULUS} = 0 THEN 'N' ELSE 'Y' END AS IS_ACTIVE,
    CASE WHEN {_hit(td.FLAT_BAD_REF)} THEN 'invalid_id' ELSE CAST({k} AS VARCHAR) END AS BRANCH_REF
  {rows}
  WHERE NOT ({_hit(td.FLAT_SKIP)})
  UNION ALL
  SELECT {k}, {_q(dup_region)}, {_q(dup_manager)}, DATE {_q(dup_audit)}, {_q(dup_active)},
    CAST({k} AS VARCHAR)
  {rows} WHERE {_hit(td.FLAT_DUPLICATE)}
  UNION ALL
  SELECT {k} + {off}, {_q(orph_region)}, {_q(orph_manager)}, DATE {_q(orph_audit)}, {_q(orph_active)},
    CAST({k} + {off} AS VARCHAR)
  {rows} WHERE {_hit(td.FLAT_ORPHAN)}
)"""


def _latest_cte(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT BRANCH_ID, REGION, MANAGER_NAME, LAST_AUDIT_DATE, IS_ACTIVE, BRANCH_REF FROM (
    SELECT *, row_number() OVER (PARTITION BY BRANCH_ID ORDER BY
      LAST_AUDIT_DATE DESC NULLS LAST, REGION DESC NULLS LAST, MANAGER_NAME DESC NULLS LAST,
      IS_ACTIVE DESC NULLS LAST, BRANCH_REF DESC NULLS LAST) AS rn
    FROM {source}) x
  WHERE rn = 1
)"""


def _ctes() -> str:
    idle_id, idle_name = td.IDLE_BRANCH
    return ",\n".join(
        [
            "e_customer AS (SELECT c_custkey AS CUSTOMER_ID, c_name AS NAME FROM customer)",
            """e_account AS (
  SELECT o.o_orderkey AS ACCOUNT_ID, o.o_custkey AS CUSTOMER_ID,
    CAST(c.c_nationkey AS BIGINT) AS BRANCH_ID, o.o_orderpriority AS ACCOUNT_TYPE,
    CAST(o.o_totalprice AS DECIMAL(15,2)) AS BALANCE, CAST(o.o_orderdate AS DATE) AS OPENED_DATE
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)""",
            """e_transaction AS (
  SELECT l_orderkey * 10 + l_linenumber AS TRANSACTION_ID, l_orderkey AS ACCOUNT_ID,
    l_returnflag AS TRANSACTION_TYPE, CAST(l_extendedprice AS DECIMAL(15,2)) AS AMOUNT,
    CAST(l_shipdate AS DATE) AS TRANSACTION_DATE
  FROM lineitem
)""",
            """e_transaction_flat AS (
  SELECT l_orderkey * 10 + l_linenumber AS TRANSACTION_ID, l_orderkey AS ACCOUNT_ID,
    l_suppkey AS BRANCH_ID, CAST(l_extendedprice AS DECIMAL(15,2)) AS AMOUNT,
    CAST(l_shipdate AS DATE) AS TRANSACTION_DATE
  FROM lineitem
)""",
            f"""e_branch AS (
  SELECT CAST(n_nationkey AS BIGINT) AS BRANCH_ID, n_name AS BRANCH_NAME, n_name AS STATE FROM nation
  UNION ALL SELECT CAST({idle_id} AS BIGINT), {_q(idle_name)}, {_q(idle_name)}
)""",
            """e_branch_flat AS (
  SELECT s.s_suppkey AS BRANCH_ID, s.s_name AS BRANCH_NAME, n.n_name AS STATE
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)""",
            _details_flat_cte(),
            _details_cte(),
            """r_summary AS (
  SELECT b.BRANCH_ID AS BRANCH_ID, b.BRANCH_NAME AS BRANCH_NAME,
    CAST(count(*) AS BIGINT) AS TOTAL_TRANSACTIONS, CAST(sum(t.AMOUNT) AS DOUBLE) AS TOTAL_AMOUNT
  FROM e_transaction t JOIN e_account a ON t.ACCOUNT_ID = a.ACCOUNT_ID
  JOIN e_branch b ON a.BRANCH_ID = b.BRANCH_ID
  GROUP BY b.BRANCH_ID, b.BRANCH_NAME
)""",
            _latest_cte("r_details_latest", "e_details"),
            _latest_cte("r_details_active_latest", "(SELECT * FROM e_details WHERE IS_ACTIVE = 'Y')"),
            _latest_cte("r_details_flat_latest", "e_details_flat"),
            _latest_cte(
                "r_details_flat_active_latest", "(SELECT * FROM e_details_flat WHERE IS_ACTIVE = 'Y')"
            ),
            """r_summary_flat AS (
  SELECT t.BRANCH_ID AS BRANCH_ID, b.BRANCH_NAME AS BRANCH_NAME,
    CAST(t.n AS BIGINT) AS TOTAL_TRANSACTIONS, CAST(t.amount AS DOUBLE) AS TOTAL_AMOUNT
  FROM (SELECT BRANCH_ID, count(TRANSACTION_ID) AS n, sum(AMOUNT) AS amount
        FROM e_transaction_flat GROUP BY BRANCH_ID) t
  JOIN e_branch_flat b ON t.BRANCH_ID = b.BRANCH_ID
)""",
            _latest_cte(
                "r_details_active_past_latest",
                f"(SELECT * FROM e_details WHERE IS_ACTIVE = 'Y' "
                f"AND NOT coalesce(LAST_AUDIT_DATE > DATE {_q(td.AS_OF)}, false))",
            ),
            """r_enriched AS (
  SELECT s.BRANCH_ID, s.BRANCH_NAME, s.TOTAL_TRANSACTIONS, s.TOTAL_AMOUNT, d.REGION,
    strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE
  FROM r_summary s LEFT JOIN r_details_active_latest d ON s.BRANCH_ID = CAST(d.BRANCH_ID AS BIGINT)
)""",
            """r_aml AS (
  SELECT c.CUSTOMER_ID, c.NAME, a.ACCOUNT_ID, t.TRANSACTION_ID, t.AMOUNT, t.TRANSACTION_TYPE,
    t.TRANSACTION_DATE
  FROM e_customer c JOIN e_account a ON c.CUSTOMER_ID = a.CUSTOMER_ID
  JOIN e_transaction t ON a.ACCOUNT_ID = t.ACCOUNT_ID
)""",
            """r_branch_keys AS (
  SELECT DISTINCT a.BRANCH_ID AS BRANCH_ID
  FROM e_transaction t JOIN e_account a ON t.ACCOUNT_ID = a.ACCOUNT_ID
)""",
        ]
    )


ENTITY_CTES = _ctes()


def with_ctes(body: str) -> str:
    return f"WITH {ENTITY_CTES}\n{body}"


def profile_sql(table_name: str) -> str:
    source, cols = {**ENTITY_COLUMNS, **EXTRA_PROFILES}[table_name]
    parts = [
        f"SELECT {_q(table_name)} AS table_name, {_q(c)} AS column_name, "
        f"CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count "
        f"FROM {source}"
        for c in cols
    ]
    return "\nUNION ALL\n".join(parts)


def verdict_sql(table_name: str) -> str:
    source, cols = ENTITY_COLUMNS[table_name]
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    with_nulls = " + ".join(f"(CASE WHEN count(*) - count({c}) > 0 THEN 1 ELSE 0 END)" for c in cols)
    return (
        f"SELECT {_q(table_name)} AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
        f"CAST({nulls} AS BIGINT) AS null_cells, CAST({with_nulls} AS BIGINT) AS columns_with_nulls, "
        f"count(*) > 0 AS passed_lenient, (count(*) > 0 AND ({nulls}) = 0) AS passed_strict "
        f"FROM {source}"
    )


def _edge_sql(edge: str, child_sql: str, key: str, parent_sql: str, parent_key: str) -> str:
    return (
        f"SELECT {_q(edge)} AS edge, CAST(count(*) AS BIGINT) AS missing_keys, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS missing_rows FROM ("
        f"SELECT {key} AS k, count(*) AS n FROM {child_sql} GROUP BY {key}) c "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent_sql} p WHERE p.{parent_key} = c.k)"
    )


def _required_sql() -> str:
    rules = [
        ("CUSTOMER", "e_customer", "NAME_required", "NAME IS NULL"),
        ("BRANCH", "e_branch", "BRANCH_NAME_required", "BRANCH_NAME IS NULL"),
        ("TRANSACTION", "e_transaction", "TRANSACTION_TYPE_required", "TRANSACTION_TYPE IS NULL"),
        ("TRANSACTION", "e_transaction", "AMOUNT_required", "AMOUNT IS NULL"),
        ("BRANCH_OPERATIONAL_DETAILS", "e_details", "REGION_required", "REGION IS NULL"),
        ("BRANCH_SUMMARY_REPORT", "r_enriched", "BRANCH_NAME_required", "BRANCH_NAME IS NULL"),
        ("BRANCH_SUMMARY_REPORT", "r_enriched", "TOTAL_TRANSACTIONS_not_negative", "TOTAL_TRANSACTIONS < 0"),
        ("BRANCH_SUMMARY_REPORT", "r_enriched", "TOTAL_AMOUNT_not_negative", "TOTAL_AMOUNT < 0"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT {_q(t)} AS table_name, {_q(rule)} AS rule, "
        f"CAST(count_if(coalesce({cond}, false)) AS BIGINT) AS violations FROM {src}"
        for t, src, rule, cond in rules
    )


def _oracle() -> dict[str, str]:
    valid_regions = _in_list(td.VALID_REGIONS)
    buckets = " ".join(
        f"WHEN STATE IN ({_in_list(members)}) THEN {_q(label)}"
        for label, members in td.STATE_BUCKETS.items()
    )
    bucket_case = f"CASE {buckets} ELSE {_q(td.STATE_BUCKET_DEFAULT)} END"
    sql = {
        "aml_customer_transactions": "SELECT * FROM r_aml",
        "aml_customer_transactions_split_hot": "SELECT * FROM r_aml",
        "aml_customer_transactions_salted": "SELECT * FROM r_aml",
        "branch_summary": "SELECT * FROM r_summary",
        "branch_summary_join_first": "SELECT * FROM r_summary",
        "branch_summary_broadcast": "SELECT * FROM r_summary",
        "branch_summary_enriched_flag_future": f"""
            SELECT s.*, d.REGION, strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE,
              CASE WHEN d.BRANCH_ID IS NOT NULL
                THEN coalesce(d.LAST_AUDIT_DATE > DATE {_q(td.AS_OF)}, FALSE) END AS AUDIT_DATE_IN_FUTURE
            FROM r_summary s LEFT JOIN r_details_active_latest d ON s.BRANCH_ID = CAST(d.BRANCH_ID AS BIGINT)""",
        "reconcile_corrupted_summary": """
            SELECT BRANCH_ID,
              CASE WHEN BRANCH_ID % 7 = 0 THEN NULL WHEN BRANCH_ID % 3 = 0 THEN TOTAL_TRANSACTIONS - 1
                ELSE TOTAL_TRANSACTIONS END AS summary_count,
              TOTAL_TRANSACTIONS AS detail_count,
              BRANCH_ID % 7 <> 0 AND BRANCH_ID % 3 <> 0 AS counts_match,
              BRANCH_ID % 7 <> 0 AND BRANCH_ID % 5 <> 0 AS amounts_match
            FROM r_summary WHERE BRANCH_ID % 7 = 0 OR BRANCH_ID % 3 = 0 OR BRANCH_ID % 5 = 0""",
        "sink_constant_column": "SELECT *, 'v2' AS REPORT_VERSION FROM r_summary",
        "sink_evolve_narrow_frame": """
            SELECT *, CAST(NULL AS VARCHAR) AS REGION, CAST(NULL AS VARCHAR) AS LAST_AUDIT_DATE FROM r_summary""",
        "seed_then_append": f"""
            SELECT CAST(BRANCH_ID AS INTEGER) AS BRANCH_ID, REGION, MANAGER_NAME, LAST_AUDIT_DATE, IS_ACTIVE FROM e_details_flat
            UNION ALL
            SELECT CAST(BRANCH_ID AS INTEGER) AS BRANCH_ID, {bucket_case} AS REGION,
              'TBD' AS MANAGER_NAME, DATE {_q(td.AS_OF)} AS LAST_AUDIT_DATE, 'Y' AS IS_ACTIVE
            FROM e_branch_flat b
            WHERE NOT EXISTS (SELECT 1 FROM e_details_flat d WHERE d.BRANCH_ID = b.BRANCH_ID)""",
        "branch_summary_enriched": "SELECT * FROM r_enriched",
        "branch_summary_enriched_reject_future": """
            SELECT s.*, d.REGION, strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE
            FROM r_summary s LEFT JOIN r_details_active_past_latest d
              ON s.BRANCH_ID = CAST(d.BRANCH_ID AS BIGINT)""",
        "branch_summary_left_no_rule": """
            SELECT s.*, d.REGION, strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE
            FROM r_summary s LEFT JOIN e_details d ON s.BRANCH_ID = d.BRANCH_ID""",
        "branch_summary_case_active": """
            SELECT s.*, CASE WHEN d.IS_ACTIVE = 'Y' THEN d.REGION END AS REGION,
              CASE WHEN d.IS_ACTIVE = 'Y' THEN strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') END
                AS LAST_AUDIT_DATE
            FROM r_summary s JOIN e_details d ON s.BRANCH_ID = d.BRANCH_ID""",
        "branch_summary_all_branches": """
            SELECT b.BRANCH_ID, b.BRANCH_NAME,
              CAST(coalesce(s.TOTAL_TRANSACTIONS, 0) AS BIGINT) AS TOTAL_TRANSACTIONS,
              CAST(coalesce(s.TOTAL_AMOUNT, 0.0) AS DOUBLE) AS TOTAL_AMOUNT
            FROM e_branch b LEFT JOIN r_summary s ON b.BRANCH_ID = s.BRANCH_ID""",
        "branch_summary_all_branches_enriched": """
            SELECT b.BRANCH_ID, b.BRANCH_NAME,
              CAST(coalesce(s.TOTAL_TRANSACTIONS, 0) AS BIGINT) AS TOTAL_TRANSACTIONS,
              CAST(coalesce(s.TOTAL_AMOUNT, 0.0) AS DOUBLE) AS TOTAL_AMOUNT,
              d.REGION, strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE
            FROM e_branch b LEFT JOIN r_summary s ON b.BRANCH_ID = s.BRANCH_ID
            LEFT JOIN r_details_active_latest d ON b.BRANCH_ID = d.BRANCH_ID""",
        "branch_summary_flat": """
            SELECT t.BRANCH_ID AS BRANCH_ID, b.BRANCH_NAME AS BRANCH_NAME,
              CAST(t.n AS BIGINT) AS TOTAL_TRANSACTIONS, CAST(t.amount AS DOUBLE) AS TOTAL_AMOUNT
            FROM (SELECT BRANCH_ID, count(TRANSACTION_ID) AS n, sum(AMOUNT) AS amount
                  FROM e_transaction_flat GROUP BY BRANCH_ID) t
            JOIN e_branch_flat b ON t.BRANCH_ID = b.BRANCH_ID""",
        "branch_summary_flat_enriched": """
            SELECT s.*, d.REGION, strftime(d.LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE
            FROM r_summary_flat s LEFT JOIN r_details_flat_active_latest d ON s.BRANCH_ID = d.BRANCH_ID""",
        "latest_details_by_supplier": "SELECT * FROM r_details_flat_latest",
        "active_details_by_supplier": """
            SELECT CAST(count(*) AS BIGINT) AS total_records,
              CAST(count_if(IS_ACTIVE = 'Y') AS BIGINT) AS active_records FROM e_details_flat""",
        "details_rules_by_supplier": f"""
            SELECT BRANCH_ID, 'region_domain' AS rule, REGION AS value FROM e_details_flat
            WHERE REGION NOT IN ({valid_regions})
            UNION ALL SELECT BRANCH_ID, 'active_flag_domain', IS_ACTIVE FROM e_details_flat
            WHERE IS_ACTIVE NOT IN ('Y', 'N')
            UNION ALL SELECT BRANCH_ID, 'audit_date_in_future', CAST(LAST_AUDIT_DATE AS VARCHAR)
            FROM e_details_flat WHERE LAST_AUDIT_DATE > DATE {_q(td.AS_OF)}
            UNION ALL SELECT BRANCH_ID, 'manager_name_format', MANAGER_NAME FROM e_details_flat
            WHERE NOT regexp_matches(MANAGER_NAME, {_q(MANAGER_NAME_PATTERN)})
            UNION ALL SELECT BRANCH_ID, 'region_length', REGION FROM e_details_flat WHERE length(REGION) > 50
            UNION ALL SELECT BRANCH_ID, 'manager_name_length', MANAGER_NAME FROM e_details_flat
            WHERE length(MANAGER_NAME) > 100
            UNION ALL SELECT BRANCH_ID, 'branch_ref_not_int', BRANCH_REF FROM e_details_flat
            WHERE BRANCH_REF IS NOT NULL AND TRY_CAST(BRANCH_REF AS BIGINT) IS NULL""",
        "orphan_details_by_supplier": """
            SELECT * FROM e_details_flat d
            WHERE NOT EXISTS (SELECT 1 FROM e_branch_flat b WHERE b.BRANCH_ID = d.BRANCH_ID)""",
        "duplicate_keys_by_supplier": """
            SELECT BRANCH_ID, CAST(count(*) AS BIGINT) AS row_count FROM e_details_flat
            GROUP BY BRANCH_ID HAVING count(*) > 1""",
        "details_coverage_by_supplier": """
            SELECT total_branches, branches_with_operational_details,
              total_branches - branches_with_operational_details AS missing_operational_details,
              CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) AS missing_share,
              coalesce(CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) > 0.05, false) AS breached
            FROM (SELECT CAST(count(*) AS BIGINT) AS total_branches,
                    CAST(count(d.BRANCH_ID) AS BIGINT) AS branches_with_operational_details
                  FROM e_branch_flat b LEFT JOIN e_details_flat d ON b.BRANCH_ID = d.BRANCH_ID) x""",
        "seed_missing_details_by_supplier": f"""
            SELECT CAST(BRANCH_ID AS INTEGER) AS BRANCH_ID, {bucket_case} AS REGION,
              'TBD' AS MANAGER_NAME, DATE {_q(td.AS_OF)} AS LAST_AUDIT_DATE, 'Y' AS IS_ACTIVE
            FROM e_branch_flat b
            WHERE NOT EXISTS (SELECT 1 FROM e_details_flat d WHERE d.BRANCH_ID = b.BRANCH_ID)""",
        "ref_integrity_by_supplier": "\nUNION ALL\n".join(
            [
                _edge_sql("transaction_branch", "e_transaction_flat", "BRANCH_ID", "e_branch_flat", "BRANCH_ID"),
                _edge_sql("details_branch", "e_details_flat", "BRANCH_ID", "e_branch_flat", "BRANCH_ID"),
                _edge_sql("summary_details", "r_summary_flat", "BRANCH_ID", "e_details_flat", "BRANCH_ID"),
            ]
        ),
        "region_bucket_by_supplier": f"SELECT BRANCH_ID, STATE, {bucket_case} AS REGION FROM e_branch_flat",
        "cast_audit_date_by_supplier": """
            SELECT BRANCH_ID, strftime(LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE FROM e_details_flat""",
        "summary_empty_details": """
            SELECT s.*, CAST(NULL AS VARCHAR) AS REGION, CAST(NULL AS VARCHAR) AS LAST_AUDIT_DATE
            FROM r_summary s""",
        "latest_details": "SELECT * FROM r_details_latest",
        "active_details": """
            SELECT CAST(count(*) AS BIGINT) AS total_records,
              CAST(count_if(IS_ACTIVE = 'Y') AS BIGINT) AS active_records FROM e_details""",
        "cast_audit_date": """
            SELECT BRANCH_ID, strftime(LAST_AUDIT_DATE, '%Y-%m-%d') AS LAST_AUDIT_DATE FROM e_details""",
        "cast_branch_id": "SELECT CAST(BRANCH_ID AS BIGINT) AS BRANCH_ID FROM e_details",
        "region_bucket": f"SELECT BRANCH_ID, STATE, {bucket_case} AS REGION FROM e_branch",
        "seed_missing_details": f"""
            SELECT CAST(BRANCH_ID AS INTEGER) AS BRANCH_ID, {bucket_case} AS REGION,
              'TBD' AS MANAGER_NAME, DATE {_q(td.AS_OF)} AS LAST_AUDIT_DATE, 'Y' AS IS_ACTIVE
            FROM e_branch b
            WHERE NOT EXISTS (SELECT 1 FROM e_details d WHERE d.BRANCH_ID = b.BRANCH_ID)""",
        "details_coverage": """
            SELECT total_branches, branches_with_operational_details,
              total_branches - branches_with_operational_details AS missing_operational_details,
              CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) AS missing_share,
              coalesce(CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) > 0.05, false) AS breached
            FROM (SELECT CAST(count(*) AS BIGINT) AS total_branches,
                    CAST(count(d.BRANCH_ID) AS BIGINT) AS branches_with_operational_details
                  FROM e_branch b LEFT JOIN e_details d ON b.BRANCH_ID = d.BRANCH_ID) x""",
        "details_coverage_distinct": """
            SELECT total_branches, branches_with_operational_details,
              total_branches - branches_with_operational_details AS missing_operational_details,
              CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) AS missing_share,
              coalesce(CAST(total_branches - branches_with_operational_details AS DOUBLE)
                / NULLIF(total_branches, 0) > 0.05, false) AS breached
            FROM (SELECT CAST(count(DISTINCT b.BRANCH_ID) AS BIGINT) AS total_branches,
                    CAST(count(DISTINCT d.BRANCH_ID) AS BIGINT) AS branches_with_operational_details
                  FROM e_branch b LEFT JOIN e_details d ON b.BRANCH_ID = d.BRANCH_ID) x""",
        "report_completeness": """
            SELECT CAST(count(*) AS BIGINT) AS total_records,
              CAST(count(REGION) AS BIGINT) AS records_with_region,
              CAST(count(LAST_AUDIT_DATE) AS BIGINT) AS records_with_audit_date,
              CAST(count(*) - count(REGION) AS BIGINT) AS missing_region_data
            FROM r_enriched""",
        "before_after_counts": """
            SELECT 'Before Enhancement' AS version, CAST(count(*) AS BIGINT) AS record_count,
              4 AS column_count FROM r_summary
            UNION ALL
            SELECT 'After Enhancement' AS version, CAST(count(*) AS BIGINT) AS record_count,
              6 AS column_count FROM r_enriched""",
        "quality_verdict": "\nUNION ALL\n".join(verdict_sql(t) for t in ENTITY_COLUMNS),
        "domain_violations": f"""
            SELECT BRANCH_ID, 'region_domain' AS rule, REGION AS value FROM e_details
            WHERE REGION NOT IN ({valid_regions})
            UNION ALL
            SELECT BRANCH_ID, 'active_flag_domain' AS rule, IS_ACTIVE AS value FROM e_details
            WHERE IS_ACTIVE NOT IN ('Y', 'N')""",
        "future_audit_dates": f"""
            SELECT BRANCH_ID, 'audit_date_in_future' AS rule,
              CAST(LAST_AUDIT_DATE AS VARCHAR) AS value
            FROM e_details WHERE LAST_AUDIT_DATE > DATE {_q(td.AS_OF)}""",
        "manager_name_format": f"""
            SELECT BRANCH_ID, 'manager_name_format' AS rule, MANAGER_NAME AS value FROM e_details
            WHERE NOT regexp_matches(MANAGER_NAME, {_q(MANAGER_NAME_PATTERN)})""",
        "length_violations": """
            SELECT BRANCH_ID, 'region_length' AS rule, REGION AS value FROM e_details
            WHERE length(REGION) > 50
            UNION ALL
            SELECT BRANCH_ID, 'manager_name_length' AS rule, MANAGER_NAME AS value FROM e_details
            WHERE length(MANAGER_NAME) > 100""",
        "conversion_errors": """
            SELECT BRANCH_ID, 'branch_ref_not_int' AS rule, BRANCH_REF AS value FROM e_details
            WHERE BRANCH_REF IS NOT NULL AND TRY_CAST(BRANCH_REF AS INTEGER) IS NULL""",
        "required_violations": _required_sql(),
        "orphan_details": """
            SELECT * FROM e_details d
            WHERE NOT EXISTS (SELECT 1 FROM e_branch b WHERE b.BRANCH_ID = d.BRANCH_ID)""",
        "duplicate_keys": """
            SELECT BRANCH_ID, CAST(count(*) AS BIGINT) AS row_count FROM e_details
            GROUP BY BRANCH_ID HAVING count(*) > 1""",
        "duplicate_transaction_ids": """
            SELECT TRANSACTION_ID, CAST(count(*) AS BIGINT) AS row_count FROM e_transaction
            GROUP BY TRANSACTION_ID HAVING count(*) > 1""",
        "ref_integrity": "\nUNION ALL\n".join(
            [
                _edge_sql("transaction_account", "e_transaction", "ACCOUNT_ID", "e_account", "ACCOUNT_ID"),
                _edge_sql("account_customer", "e_account", "CUSTOMER_ID", "e_customer", "CUSTOMER_ID"),
                _edge_sql("account_branch", "e_account", "BRANCH_ID", "e_branch", "BRANCH_ID"),
                _edge_sql("details_branch", "e_details", "BRANCH_ID", "e_branch", "BRANCH_ID"),
                _edge_sql("summary_details", "r_summary", "BRANCH_ID", "e_details", "BRANCH_ID"),
            ]
        ),
        "summary_key_equality": """
            SELECT CAST(count_if(l = 1) AS BIGINT) AS keys_left, CAST(count_if(r = 1) AS BIGINT) AS keys_right,
              CAST(count_if(l = 1 AND r = 0) AS BIGINT) AS only_left,
              CAST(count_if(l = 0 AND r = 1) AS BIGINT) AS only_right
            FROM (SELECT BRANCH_ID, max(l) AS l, max(r) AS r FROM (
                    SELECT DISTINCT BRANCH_ID, 1 AS l, 0 AS r FROM r_summary
                    UNION ALL SELECT BRANCH_ID, 0 AS l, 1 AS r FROM r_branch_keys) u
                  GROUP BY BRANCH_ID) k""",
        "reconcile_summary": """
            SELECT coalesce(s.BRANCH_ID, d.BRANCH_ID) AS BRANCH_ID,
              s.TOTAL_TRANSACTIONS AS summary_count, d.detail_count,
              s.TOTAL_AMOUNT AS summary_amount, d.detail_amount,
              coalesce(s.TOTAL_TRANSACTIONS = d.detail_count, false) AS counts_match,
              coalesce(abs(s.TOTAL_AMOUNT - d.detail_amount) < 0.01, false)
                OR (s.TOTAL_AMOUNT IS NULL AND d.detail_amount IS NULL
                    AND s.TOTAL_TRANSACTIONS IS NOT NULL AND d.detail_count IS NOT NULL)
                AS amounts_match
            FROM r_summary s FULL OUTER JOIN (
              SELECT a.BRANCH_ID, CAST(count(*) AS BIGINT) AS detail_count,
                CAST(sum(t.AMOUNT) AS DOUBLE) AS detail_amount
              FROM e_transaction t JOIN e_account a ON t.ACCOUNT_ID = a.ACCOUNT_ID
              GROUP BY a.BRANCH_ID) d ON s.BRANCH_ID = d.BRANCH_ID""",
        "amount_totals": """
            SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(sum(AMOUNT) AS DOUBLE) AS total_amount
            FROM e_transaction""",
        "row_counts": """
            SELECT 'TRANSACTION' AS source, s.n AS source_rows,
              'AML_CUSTOMER_TRANSACTIONS' AS target, t.n AS target_rows, s.n = t.n AS counts_match
            FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM e_transaction) s,
                 (SELECT CAST(count(*) AS BIGINT) AS n FROM r_aml) t""",
        "distinct_branch_keys": "SELECT BRANCH_ID FROM r_branch_keys",
        "stage_metrics": "\nUNION ALL\n".join(
            f"SELECT {_q(stage)} AS stage, CAST(count(*) AS BIGINT) AS record_count FROM {src}"
            for stage, (src, _) in ENTITY_COLUMNS.items()
        ),
        # Sink round trips: the table read back must equal the report.
        "sink_roundtrip_summary": "SELECT * FROM r_summary",
        "sink_roundtrip_aml": "SELECT * FROM r_aml",
        "sink_evolve_4_to_6": "SELECT * FROM r_enriched",
        "staged_write_summary": "SELECT * FROM r_enriched",
        "insert_with_defaults": """
            SELECT ACCOUNT_ID, CUSTOMER_ID, BRANCH_ID, ACCOUNT_TYPE,
              CAST(0 AS DECIMAL(15,2)) AS BALANCE FROM e_account""",
        "backup_restore": "SELECT * FROM r_summary",
        "alter_add_columns": """
            SELECT *, CAST(NULL AS VARCHAR) AS REGION, CAST(NULL AS VARCHAR) AS LAST_AUDIT_DATE
            FROM r_summary""",
        "rerun_identical": """
            SELECT CAST(count(*) AS BIGINT) AS rows_left, CAST(count(*) AS BIGINT) AS rows_right,
              CAST(0 AS BIGINT) AS differing_rows FROM r_enriched""",
        "aml_customer_transactions_landed": "SELECT * FROM r_aml",
        "branch_summary_landed": "SELECT * FROM r_summary",
        "published_reports": """
            SELECT r.*, r.BRANCH_ID IN (SELECT BRANCH_ID FROM e_details WHERE IS_ACTIVE = 'Y') AS HAS_ACTIVE_DETAILS
            FROM r_enriched r""",
        "insert_checked_accepted": "\nUNION ALL\n".join(
            f"SELECT {_q(table)} AS table_name, count(*) AS table_rows, count(*) AS rows_with_defaults FROM {src} WHERE {needed}"
            for table, src, needed in [
                ("CUSTOMER", "e_customer", "NAME IS NOT NULL"),
                ("BRANCH", "e_branch", "BRANCH_NAME IS NOT NULL"),
                ("ACCOUNT", "e_account", "TRUE"),
                ("TRANSACTION", "e_transaction", "TRANSACTION_TYPE IS NOT NULL AND AMOUNT IS NOT NULL"),
                ("BRANCH_OPERATIONAL_DETAILS", "e_details_flat", "REGION IS NOT NULL"),
            ]
        ),
        "insert_checked_refused": """
            SELECT * FROM (
              SELECT 'BRANCH' AS table_name, 'BRANCH_NAME_not_null' AS rule, count(*) AS refused_rows, 0::BIGINT AS table_rows
              FROM e_branch_flat WHERE BRANCH_NAME IS NULL OR BRANCH_ID % 7 = 0
              UNION ALL SELECT 'BRANCH_OPERATIONAL_DETAILS', 'IS_ACTIVE_domain', count(*), 0 FROM e_details_flat WHERE IS_ACTIVE NOT IN ('Y', 'N')
              UNION ALL SELECT 'BRANCH_OPERATIONAL_DETAILS', 'REGION_not_null', count(*), 0 FROM e_details_flat WHERE REGION IS NULL
            ) WHERE refused_rows > 0""",
        "schema_checks": """
            SELECT * FROM (WITH layout(field, position, kind) AS (VALUES ('BRANCH_ID', 0, 'bigint'), ('BRANCH_NAME', 1, 'string'), ('TOTAL_TRANSACTIONS', 2, 'bigint'),
              ('TOTAL_AMOUNT', 3, 'double'), ('REGION', 4, 'string'), ('LAST_AUDIT_DATE', 5, 'string'))
            SELECT 'BRANCH_SUMMARY_REPORT' AS table_name, field, position, kind AS expected, kind AS found, 'equal' AS verdict FROM layout
            UNION ALL SELECT 'BRANCH_SUMMARY_REPORT as v1', field, position, CASE WHEN position < 4 THEN kind END, kind, CASE WHEN position < 4 THEN 'equal' ELSE 'added' END FROM layout
            UNION ALL SELECT 'drifted', field, position, kind, CASE field WHEN 'REGION' THEN NULL WHEN 'TOTAL_TRANSACTIONS' THEN 'int' ELSE kind END,
              CASE field WHEN 'REGION' THEN 'missing' WHEN 'TOTAL_TRANSACTIONS' THEN 'type' ELSE 'equal' END FROM layout
            UNION ALL SELECT 'drifted', 'AREA', 6, NULL, 'string', 'added')""",
    }
    for table_name in ENTITY_COLUMNS:
        sql[f"null_profile_{_profile_key(table_name)}"] = profile_sql(table_name)
    sql["null_profile_details_by_supplier"] = profile_sql("BRANCH_OPERATIONAL_DETAILS_BY_SUPPLIER")
    return {key: with_ctes(body.strip()) for key, body in sql.items()}


def _profile_key(table_name: str) -> str:
    return {
        "CUSTOMER": "customer",
        "ACCOUNT": "account",
        "TRANSACTION": "transaction",
        "BRANCH": "branch",
        "BRANCH_OPERATIONAL_DETAILS": "details",
        "AML_CUSTOMER_TRANSACTIONS": "aml",
        "BRANCH_SUMMARY_REPORT": "summary",
    }[table_name]


ORACLE_SQL = _oracle()
