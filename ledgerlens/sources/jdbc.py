"""JDBC sources.

The reference reads each table as a single JDBC partition.  Here the large
tables are read by default as ``num_partitions`` ranges of a key that hold about
equally many rows each, whatever the keys' distribution: the database itself
cuts the sorted keys (``quantiles``), and every range is one predicate of its own
(``range_predicates``).  Equal steps between two bounds remain as an option.
Filters and column pruning reach the database through Spark's JDBC pushdown.

No database is started by this package or its tests, so these readers are
exercised only through their option handling (see README).
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

DETAILS_TABLE = "BRANCH_OPERATIONAL_DETAILS"
# Tables that grow with the business, and the key each is ranged by.
RANGE_KEYS = {"TRANSACTION": "TRANSACTION_ID", "ACCOUNT": "ACCOUNT_ID", "CUSTOMER": "CUSTOMER_ID"}
PARTITIONS = 32


def quantile_query(table: str, column: str, num_partitions: int) -> str:
    """SQL for the least key of each of ``num_partitions`` equal parts of the
    sorted keys.  Keys are counted once per value before they are cut, so the
    database sorts distinct keys, and a key with very many rows is one entry."""
    return (
        f"(SELECT MIN(k) AS lo FROM (SELECT k, FLOOR((SUM(n) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) - n) * {num_partitions} / SUM(n) OVER ()) AS part "
        f"FROM (SELECT {column} AS k, CAST(COUNT(*) AS DECIMAL(18,0)) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}) c) q GROUP BY part) b"
    )


def quantiles(spark: SparkSession, url: str, table: str, column: str, properties: Mapping[str, str], num_partitions: int) -> list[object]:
    """The cuts between the parts, in order: one query, at most
    ``num_partitions`` rows."""
    rows = spark.read.jdbc(url=url, table=quantile_query(table, column, num_partitions), properties=dict(properties)).collect()
    return sorted({r[0] for r in rows if r[0] is not None})[1:]


def literal(value: object) -> str:
    """A SQL literal of a key: number, text, date or timestamp."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """One condition per range: below the first cut (with NULLs), between
    neighbours, from the last on.  Every row fulfils exactly one."""
    if not cuts:
        return []
    at = [literal(c) for c in cuts]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return [f"{column} < {at[0]} OR {column} IS NULL", *inner, f"{column} >= {at[-1]}"]


def read_balanced(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    column: str | None = None,
    num_partitions: int = PARTITIONS,
    fetch_size: int | None = None,
) -> DataFrame:
    """``table`` in ranges of about equal row counts on ``column`` (default:
    the table's own key; tables without one are read by one task).

    A single key is never cut, so a range holds at most its share plus one
    key's rows; with fewer keys than ranges there are fewer ranges.
    """
    props = dict(properties) | ({"fetchsize": str(fetch_size)} if fetch_size else {})
    column = column or RANGE_KEYS.get(table.rsplit(".", 1)[-1].upper())
    cuts = quantiles(spark, url, table, column, props, num_partitions) if column and num_partitions > 1 else []
    if not cuts:
        return spark.read.jdbc(url=url, table=table, properties=props)
    return spark.read.jdbc(url=url, table=table, predicates=range_predicates(column, cuts), properties=props)


def bounds(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    properties: Mapping[str, str],
) -> tuple[object, object]:
    """MIN and MAX of ``column``, computed by the database (one tiny query).

    Read by position: databases differ in the case of unquoted aliases.
    """
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = spark.read.jdbc(url=url, table=query, properties=dict(properties)).first()
    return row[0], row[1]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    column: str | None = None,
    lower_bound: object | None = None,
    upper_bound: object | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """Read ``table`` over JDBC.

    With ``column`` and ``num_partitions`` the read is split into range
    partitions on ``column``; missing bounds are fetched with ``bounds``.
    Bounds only shape the ranges, they never filter rows.  Errors (missing
    table, no access) raise before any write happens (Q20).
    """
    props = dict(properties)
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    if column is None or not num_partitions or num_partitions <= 1:
        return spark.read.jdbc(url=url, table=table, properties=props)
    if lower_bound is None or upper_bound is None:
        lo, hi = bounds(spark, url, table, column, props)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi if upper_bound is None else upper_bound
    if lower_bound is None:  # empty table
        return spark.read.jdbc(url=url, table=table, properties=props)
    return spark.read.jdbc(
        url=url,
        table=table,
        column=column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def read_branch_operational_details(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    **partitioning,
) -> DataFrame:
    """BRANCH_OPERATIONAL_DETAILS over JDBC (``read_jdbc`` options apply)."""
    return read_jdbc(spark, url, DETAILS_TABLE, properties, **partitioning)
