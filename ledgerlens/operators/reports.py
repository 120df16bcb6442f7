"""The two regulatory reports and their variants.

Plan shapes, chosen for a fact table far larger than its dimensions:

* ``aml_customer_transactions`` joins CUSTOMER to ACCOUNT first and the
  result to TRANSACTION last, so the largest table is shuffled once.  It is
  a row-level report: a hot account is split by AQE's skew join, or salted
  explicitly by ``salt_hot_accounts``.
* ``branch_summary`` aggregates transactions per account *before* the join
  (eager aggregation).  Map-side partial aggregation collapses a hot account
  to one row per task, and the join then moves one row per account instead
  of one per transaction.  COUNT and SUM stay exact under join fan-out: a
  duplicated account row repeats its partial totals just as it would repeat
  the transactions.
* Enrichment happens after aggregation, so duplicate details can repeat a
  report row but never inflate a total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import after, date_text, money_to_double, when_active, zero_if_null
from ledgerlens.functions.money import merged_sums, partial_sums, total
from ledgerlens.operators.dedupe import latest_per_key
from ledgerlens.operators.joins import (
    DEFAULT_MAX_BROADCAST_ROWS,
    ROWS_PER_SALT,
    broadcast_if_bounded,
    salted_join,
)
from ledgerlens.schemas import AML_COLUMNS

SUMMARY_COLUMNS = ["BRANCH_ID", "BRANCH_NAME", "TOTAL_TRANSACTIONS", "TOTAL_AMOUNT"]
ENRICHED_COLUMNS = SUMMARY_COLUMNS + ["REGION", "LAST_AUDIT_DATE"]
JOIN_MODES = ("left", "inner")
ACTIVE_RULES = ("filter", "case", "none")
FUTURE_AUDIT_MODES = ("accept", "reject", "flag")


def aml_customer_transactions(
    customer: DataFrame,
    account: DataFrame,
    transaction: DataFrame,
    *,
    salt_hot_accounts: bool = False,
    rows_per_salt: int = ROWS_PER_SALT,
    account_keys: Sequence[str] = ("ACCOUNT_ID",),
) -> DataFrame:
    """CUSTOMER ⋈ ACCOUNT ⋈ TRANSACTION (inner, USING keys), 7 columns.

    Skew on ACCOUNT_ID: by default AQE splits an oversized partition of the
    last join at run time.  ``salt_hot_accounts`` spreads every account with
    more than ``rows_per_salt`` transactions explicitly
    (``joins.salted_join``).  Tables from ``sources.landing`` are joined by
    ``account_keys=LANDED_KEYS``: they are salted already, and the fact side is
    not shuffled again.  The rows are the same each way.
    """
    keys = list(account_keys)
    c = customer.select("CUSTOMER_ID", "NAME")
    a = account.select(*keys, "CUSTOMER_ID")
    t = transaction.select(*keys, "TRANSACTION_ID", "AMOUNT", "TRANSACTION_TYPE", "TRANSACTION_DATE")
    customer_accounts = c.join(a, "CUSTOMER_ID")
    if salt_hot_accounts:
        joined = salted_join(t, customer_accounts, keys, rows_per_salt=rows_per_salt)
    else:
        joined = customer_accounts.join(t, keys)
    return joined.select(*AML_COLUMNS)


def _finish_summary(df: DataFrame, count_col: str, rows_col: str) -> DataFrame:
    return df.select(
        F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"),
        "BRANCH_NAME",
        F.col(count_col).cast("bigint").alias("TOTAL_TRANSACTIONS"),
        money_to_double(total(df.columns, rows_col)).alias("TOTAL_AMOUNT"),
    )


def branch_summary(
    transaction: DataFrame,
    account: DataFrame,
    branch: DataFrame,
    *,
    eager: bool = True,
    broadcast_branch: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    account_keys: Sequence[str] = ("ACCOUNT_ID",),
) -> DataFrame:
    """Per branch, ``count(*)`` and ``sum(AMOUNT)`` of
    TRANSACTION ⋈ ACCOUNT ⋈ BRANCH (inner), grouped by BRANCH_ID, BRANCH_NAME.

    Amounts are summed exactly (``functions.money``) and cast to DOUBLE last.  ``eager=False``
    gives the literal join-then-aggregate plan (same result).  With
    ``broadcast_branch`` the branch side is broadcast only if it has at most
    ``max_broadcast_rows`` rows.  ``account_keys`` as in
    ``aml_customer_transactions``.
    """
    keys = list(account_keys)
    t = transaction.select(*keys, "AMOUNT")
    a = account.select(*keys, "BRANCH_ID")
    b = branch.select("BRANCH_ID", "BRANCH_NAME")
    if broadcast_branch:
        b = broadcast_if_bounded(b, max_broadcast_rows)
    if not eager:
        joined = t.join(a, keys).join(b, "BRANCH_ID")
        out = joined.groupBy("BRANCH_ID", "BRANCH_NAME").agg(
            F.count(F.lit(1)).alias("_n"), *partial_sums(joined)
        )
        return _finish_summary(out, "_n", "_n")
    return summary_of_totals(account_totals(t, keys), a, b, keys)


def account_totals(transaction: DataFrame, account_keys: Sequence[str] = ("ACCOUNT_ID",)) -> DataFrame:
    """Per account the count ``_n`` and the partial sums of its transactions."""
    return transaction.groupBy(*account_keys).agg(F.count(F.lit(1)).alias("_n"), *partial_sums(transaction))


def summary_of_totals(
    totals: DataFrame, account: DataFrame, branch: DataFrame, account_keys: Sequence[str] = ("ACCOUNT_ID",)
) -> DataFrame:
    """The branch summary of ``account_totals``."""
    a, b = account.select(*account_keys, "BRANCH_ID"), branch.select("BRANCH_ID", "BRANCH_NAME")
    per_branch = (
        totals.join(a, list(account_keys))
        .groupBy("BRANCH_ID")
        .agg(F.sum("_n").alias("_n"), *merged_sums(totals.columns))
    )
    out = (
        per_branch.join(b, "BRANCH_ID")
        .groupBy("BRANCH_ID", "BRANCH_NAME")
        .agg(F.sum("_n").alias("_n"), *merged_sums(totals.columns))
    )
    return _finish_summary(out, "_n", "_n")


def branch_summary_flat(transaction: DataFrame, branch: DataFrame) -> DataFrame:
    """Flat grain, the transaction carries BRANCH_ID.

    Aggregates by BRANCH_ID with ``count(TRANSACTION_ID)`` (NULL ids not
    counted), then joins BRANCH (inner) for the name.
    """
    per_branch = transaction.groupBy("BRANCH_ID").agg(
        F.count("TRANSACTION_ID").alias("_n"), F.count(F.lit(1)).alias("_rows"), *partial_sums(transaction)
    )
    out = per_branch.join(branch.select("BRANCH_ID", "BRANCH_NAME"), "BRANCH_ID")
    return _finish_summary(out, "_n", "_rows")


def prepare_details(
    details: DataFrame,
    *,
    active_rule: str = "filter",
    active_col: str = "IS_ACTIVE",
    active_value: str = "Y",
    duplicates: str = "latest",
    audit_col: str = "LAST_AUDIT_DATE",
    future_audit: str = "accept",
    as_of: str | None = None,
) -> DataFrame:
    """F1 + W1 (+ Q9): the details side of the enrichment, before the join.

    ``filter`` keeps active rows first and then picks one per branch among
    them; ``case`` and ``none`` pick among all rows.  ``future_audit``
    ``reject`` drops rows audited after ``as_of`` before that choice.  All
    columns are kept; the caller projects what it joins.
    """
    d = details
    if future_audit == "reject":
        d = d.where(~F.coalesce(after(F.col(audit_col), as_of), F.lit(False)))
    if active_rule == "filter":
        d = d.where(F.col(active_col) == F.lit(active_value))
    if duplicates != "keep":
        d = latest_per_key(d, ["BRANCH_ID"], [audit_col], mode=duplicates)
    return d


def enrich_summary(
    summary: DataFrame,
    details: DataFrame,
    *,
    how: str = "left",
    active_rule: str = "filter",
    active_col: str = "IS_ACTIVE",
    active_value: str = "Y",
    duplicates: str = "latest",
    future_audit: str = "accept",
    as_of: str | None = None,
) -> DataFrame:
    """Add REGION and LAST_AUDIT_DATE.

    ``how``: ``left`` (default, D1) keeps every report row; ``inner`` drops
    branches without details.  ``active_rule`` (D2): ``filter`` uses only
    rows with ``active_col = active_value``; ``case`` joins every row and
    blanks both columns when inactive; ``none`` ignores the flag.
    ``duplicates`` (D14): ``latest`` (default), ``first``, ``keep``, ``error``.
    LAST_AUDIT_DATE is returned as ``yyyy-MM-dd`` text (D4).
    ``future_audit`` (Q9) handles audit dates after ``as_of``:
    ``accept`` keeps them, ``reject`` ignores those details rows, ``flag``
    keeps them and adds a boolean ``AUDIT_DATE_IN_FUTURE`` column.
    """
    if future_audit not in FUTURE_AUDIT_MODES:
        raise ValueError(f"future_audit must be one of {FUTURE_AUDIT_MODES}, got {future_audit!r}")
    if future_audit != "accept" and as_of is None:
        raise ValueError("future_audit other than 'accept' needs as_of")
    if how not in JOIN_MODES:
        raise ValueError(f"how must be one of {JOIN_MODES}, got {how!r}")
    if active_rule not in ACTIVE_RULES:
        raise ValueError(f"active_rule must be one of {ACTIVE_RULES}, got {active_rule!r}")
    d = prepare_details(
        details,
        active_rule=active_rule,
        active_col=active_col,
        active_value=active_value,
        duplicates=duplicates,
        future_audit=future_audit,
        as_of=as_of,
    )
    flag_col = []
    if future_audit == "flag":
        flag_col = [F.coalesce(after(F.col("LAST_AUDIT_DATE"), as_of), F.lit(False)).alias("AUDIT_DATE_IN_FUTURE")]
    d = d.select(
        F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"),
        "REGION",
        date_text(d, "LAST_AUDIT_DATE").alias("LAST_AUDIT_DATE"),
        *([active_col] if active_rule == "case" else []),
        *flag_col,
    )
    joined = summary.join(d, "BRANCH_ID", how)
    region, audit = F.col("REGION"), F.col("LAST_AUDIT_DATE")
    if active_rule == "case":
        region = when_active(region, active_col, active_value)
        audit = when_active(audit, active_col, active_value)
    base = [c for c in summary.columns if c in SUMMARY_COLUMNS]
    extra = ["AUDIT_DATE_IN_FUTURE"] if future_audit == "flag" else []
    return joined.select(*base, region.alias("REGION"), audit.alias("LAST_AUDIT_DATE"), *extra)


def all_branches(summary: DataFrame, branch: DataFrame) -> DataFrame:
    """J10, P14 (D7): every branch, zero totals where it had no transactions."""
    b = branch.select(F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"), "BRANCH_NAME")
    s = summary.drop("BRANCH_NAME")
    extra = [c for c in s.columns if c not in SUMMARY_COLUMNS]
    return b.join(s, "BRANCH_ID", "left").select(
        "BRANCH_ID",
        "BRANCH_NAME",
        zero_if_null(F.col("TOTAL_TRANSACTIONS"), 0).cast("bigint").alias("TOTAL_TRANSACTIONS"),
        zero_if_null(F.col("TOTAL_AMOUNT"), 0.0).cast("double").alias("TOTAL_AMOUNT"),
        *extra,
    )


def branch_keys_with_transactions(transaction: DataFrame, account: DataFrame) -> DataFrame:
    """Distinct BRANCH_ID reached by transactions through ACCOUNT.

    Distinct account ids first (partial aggregation shrinks the fact side
    before its shuffle), then the join, then distinct branch ids.
    """
    used = transaction.select("ACCOUNT_ID").distinct()
    return (
        used.join(account.select("ACCOUNT_ID", "BRANCH_ID"), "ACCOUNT_ID")
        .select(F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"))
        .distinct()
    )
