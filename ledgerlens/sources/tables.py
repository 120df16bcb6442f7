"""Catalog tables as sources and sinks.

Writes go through ``DataFrameWriter.saveAsTable`` / ``insertInto`` and
statements through ``spark.sql``; the table format is a parameter
(``parquet`` by default, ``delta`` when its package is on the classpath).

Parquet tables have no transactions, so ``staged_overwrite`` writes a
staging table, checks it, and only then swaps it in: a failed write or a
failed check leaves the old table untouched.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.schemas import ddl

LOG = logging.getLogger(__name__)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_table(
    df: DataFrame,
    name: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    evolve: bool = False,
    partition_by: Sequence[str] | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` as table ``name``.

    ``mode="overwrite"`` is a full reload: rerunning gives the same table,
    never duplicates.  With ``evolve`` the table's schema only grows: columns
    that ``df`` adds are added, columns that it lacks stay and read NULL, and a
    column of another type is refused (``mergeSchema`` does this for Delta;
    other formats get the missing columns before the write).  ``bucket_by``
    (n, columns) lays the table out so later joins on those columns need no
    shuffle.
    """
    if evolve and fmt != "delta" and mode == "overwrite" and table_exists(df.sparkSession, name):
        df = widened(df, df.sparkSession.table(name).schema)
    writer = df.write.format(fmt).mode(mode)
    if evolve:
        writer = writer.option("mergeSchema", "true")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.saveAsTable(name)


def widened(df: DataFrame, old: StructType) -> DataFrame:
    """``df`` with the columns of ``old`` first, those it lacks as typed NULLs,
    then its own; a column whose type differs raises ``ValueError``."""
    mine = {f.name.lower(): f for f in df.schema.fields}
    changed = [f"{f.name}: {f.dataType.simpleString()} -> {mine[f.name.lower()].dataType.simpleString()}"
               for f in old.fields if f.name.lower() in mine and mine[f.name.lower()].dataType != f.dataType]
    if changed:
        raise ValueError(f"evolution would change column types: {changed}")
    kept = [F.col(f"`{f.name}`") if f.name.lower() in mine else F.lit(None).cast(f.dataType).alias(f.name) for f in old.fields]
    known = {f.name.lower() for f in old.fields}
    return df.select(*kept, *(F.col(f"`{f.name}`") for f in df.schema.fields if f.name.lower() not in known))


def staging_name(name: str, run: str = "") -> str:
    """The staging table of a run; each run has its own."""
    return f"{name}__staging{'_' + run if run else ''}"


def write_staging(df: DataFrame, name: str, *, fmt: str = "parquet", run: str = "") -> str:
    """S16, step 1: write ``df`` to the run's staging table of ``name``; returns it.

    The target is untouched.  The staging table is a written table, so it
    also cuts the lineage: checks and the swap never re-run the job.
    """
    spark = df.sparkSession
    staging = staging_name(name, run)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    write_table(df, staging, fmt=fmt)
    return staging


def previous_name(name: str) -> str:
    return f"{name}__previous"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def recover(spark: SparkSession, names: Sequence[str]) -> None:
    """Finish or undo a publication of ``names`` that died half-way.

    A publication first renames all old tables aside, then all staging tables
    in, then drops the old ones, each in the order of ``names``.  So if every
    name exists the new tables are complete and what is left aside goes; if
    one is missing all old tables come back, and a table before them that had
    no old version goes.
    """
    aside = [n for n in names if table_exists(spark, previous_name(n))]
    if not aside:
        return
    if all(table_exists(spark, n) for n in names):
        for n in aside:
            spark.sql(f"DROP TABLE {previous_name(n)}")
        return
    last = names.index(aside[-1])
    for n in names:
        if n in aside:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
            _rename(spark, previous_name(n), n)
        elif names.index(n) < last:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def publish_all(spark: SparkSession, names: Sequence[str], run: str = "") -> None:
    """S16, step 2: swap the run's staging tables in for ``names``, all or none.

    If any step fails, every table is back as it was; if the process dies, the
    next publication (or ``recover``) completes or undoes it.
    """
    names = list(names)
    recover(spark, names)
    had = [n for n in names if table_exists(spark, n)]
    moved, published = [], []
    try:
        for n in had:
            _rename(spark, n, previous_name(n))
            moved.append(n)
        for n in names:
            _rename(spark, staging_name(n, run), n)
            published.append(n)
    except Exception:
        for n in published:
            _rename(spark, n, staging_name(n, run))
        for n in moved:
            _rename(spark, previous_name(n), n)
        raise
    for n in had:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {previous_name(n)}")
        except Exception:  # the new tables stand; the next publication drops it
            LOG.warning("could not drop %s", previous_name(n), exc_info=True)


def publish_staging(spark: SparkSession, name: str, run: str = "") -> None:
    """``publish_all`` for one table."""
    publish_all(spark, [name], run)


def discard_staging(spark: SparkSession, name: str, run: str = "") -> None:
    spark.sql(f"DROP TABLE IF EXISTS {staging_name(name, run)}")


def staged_overwrite(
    df: DataFrame,
    name: str,
    *,
    fmt: str = "parquet",
    check: Callable[[DataFrame], bool] | None = None,
) -> None:
    """Replace ``name`` with ``df`` only after the new data is written
    and passes ``check`` (run on the staged table, not on a recomputation).

    A failed job or a failed check leaves the old table untouched.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex[:8]
    try:
        staging = write_staging(df, name, fmt=fmt, run=run)
        if check is not None and not check(spark.table(staging)):
            raise ValueError(f"staged data for {name} failed its check; {name} left unchanged")
        publish_all(spark, [name], run)
    finally:
        discard_staging(spark, name, run)


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType | str,
    *,
    fmt: str = "parquet",
    if_not_exists: bool = True,
    defaults: Mapping[str, str] | None = None,
    not_null: Sequence[str] = (),
    checks: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """``CREATE TABLE [IF NOT EXISTS] name (...) USING fmt``.

    ``defaults`` maps a column to a SQL default expression (``0``,
    ``CURRENT_DATE``, ``'Y'``).  Parquet tables enforce neither NOT NULL nor
    CHECK, so ``not_null`` columns and ``checks`` (name to SQL condition) are kept
    as table properties, by which ``insert_checked`` refuses a batch.
    """
    defaults = defaults or {}
    rules = {f"{RULE}{c}_not_null": f"`{c}` IS NOT NULL" for c in not_null} | {f"{RULE}{n}": c for n, c in (checks or {}).items()}
    properties = {**rules, **(properties or {})}
    if isinstance(schema, StructType):
        cols = ", ".join(
            f"{f.name} {f.dataType.simpleString().upper()}"
            + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
            for f in schema.fields
        )
    else:
        cols = schema
    clause = "IF NOT EXISTS " if if_not_exists else ""
    props = ""
    if properties:
        quoted = ((k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in properties.items())
        props = " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in quoted) + ")"
    spark.sql(f"CREATE TABLE {clause}{name} ({cols}) USING {fmt}{props}")


def insert_columns(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> None:
    """``INSERT INTO name (columns) SELECT columns`` (by name; columns
    left out take their DEFAULT, else NULL)."""
    spark = df.sparkSession
    columns = list(columns or df.columns)
    view = f"_ledgerlens_insert_{uuid.uuid4().hex}"
    df.select(*columns).createOrReplaceTempView(view)
    try:
        col_list = ", ".join(columns)
        spark.sql(f"INSERT INTO {name} ({col_list}) SELECT {col_list} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


RULE = "rule."


class RefusedBatch(ValueError):
    """Rows of a batch break rules of their table; nothing was inserted.
    ``broken`` maps each broken rule to the number of rows."""

    def __init__(self, name: str, broken: Mapping[str, int]):
        super().__init__(f"batch for {name} refused, rows that break a rule: {dict(broken)}")
        self.broken = dict(broken)


def table_rules(spark: SparkSession, name: str) -> dict[str, str]:
    """The conditions that rows of the table must not fail, by name."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"].removeprefix(RULE): r["value"] for r in found if r["key"].startswith(RULE)}


def insert_checked(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> int:
    """Insert a batch only if no row breaks a rule of its table.

    The batch is staged first, columns left out with their DEFAULT; the rows
    that break each rule are counted on that write (``DataFrame.observe``), so
    checking costs no pass of its own.  As in SQL a CHECK that is NULL holds.
    Any broken rule raises ``RefusedBatch`` and leaves the table as it was; else
    the staged rows are appended.  Returns how many.
    """
    spark, staging = df.sparkSession, f"{name}__batch_{uuid.uuid4().hex[:8]}"
    columns = list(columns or df.columns)
    rules = table_rules(spark, name)
    given = {c.lower() for c in columns}
    target = spark.table(name).schema
    row = []
    for f in target.fields:
        default = f.metadata.get("CURRENT_DEFAULT")
        value = F.col(f"`{f.name}`") if f.name.lower() in given else F.expr(default) if default else F.lit(None)
        row.append(value.cast(f.dataType).alias(f.name))
    observation = Observation(f"batch for {name}")
    counts = [F.count_if(~F.coalesce(F.expr(c), F.lit(True))).alias(f"r{i}") for i, c in enumerate(rules.values())]
    staged = df.select(*columns).select(*row).observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
    try:
        write_table(staged, staging)
        broken = {rule: observation.get[f"r{i}"] for i, rule in enumerate(rules) if observation.get[f"r{i}"]}
        if broken:
            raise RefusedBatch(name, broken)
        spark.table(staging).write.insertInto(name)
        return observation.get["rows"]
    finally:
        drop_table(spark, staging)


def backup_table(spark: SparkSession, source: str, backup: str, *, fmt: str = "parquet") -> None:
    """``CREATE TABLE backup AS SELECT * FROM source`` (replacing an old backup)."""
    spark.sql(f"DROP TABLE IF EXISTS {backup}")
    spark.sql(f"CREATE TABLE {backup} USING {fmt} AS SELECT * FROM {source}")


def add_columns(spark: SparkSession, name: str, columns: StructType | str) -> None:
    """``ALTER TABLE name ADD COLUMNS (...)``; existing rows read NULL."""
    cols = ddl(columns) if isinstance(columns, StructType) else columns
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")


def restore_table(
    spark: SparkSession,
    backup: str,
    target: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
) -> None:
    """Rollback: drop ``target``, recreate it narrow with ``schema`` and
    insert those columns from ``backup``."""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    create_table(spark, target, schema, fmt=fmt, if_not_exists=False)
    names = [f.name for f in schema.fields]
    spark.table(backup).select(*names).write.insertInto(target)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
