"""Publication of several reports at once, without a gap.

A report is a view over a table of its run (a version).  Publishing is

1. each view is replaced by one over both versions, the old and the new one,
   of which the row of one pointer view chooses;
2. the pointer is replaced: from here on every report is the new one;
3. each view is replaced by one over the new version alone;
4. versions older than the former one are dropped; the former stays, so that a
   query which is still reading it can finish.

Replacing a view is one catalog operation, so a reader meets a report at any
moment, and the pointer makes all of them change together: a run that dies at
any step leaves all old or all new, and ``recover`` (which each publication runs
first) brings the views in line with the pointer.

While step 1 holds, a view has the columns of both versions, those that the old
one lacks reading NULL; columns must keep their types.  Before a first
publication the reports do not exist; between its first steps they are empty.
A plain table under a report's name is taken over as the former version; only
this once, between renaming the table and creating its view, the name is missing
(``recover`` then creates it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ledgerlens.sources import tables as T

RUN, FORMER = "ledgerlens.run", "ledgerlens.former"
ADOPTED = "adopted"


def version_name(name: str, run: str) -> str:
    return f"{name}__v_{run}"


def pointer_name(names: Sequence[str]) -> str:
    return f"{names[0]}__publication"


def _run(spark: SparkSession, sql: str) -> None:
    spark.sql(sql)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not T.table_exists(spark, name):
        return {}
    try:
        return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    except AnalysisException:  # dropped in the meantime
        return {}


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def published(spark: SparkSession, names: Sequence[str]) -> tuple[str, str]:
    """The run the pointer names and the one before it ('' for none)."""
    found = _properties(spark, pointer_name(names))
    return found.get(RUN, ""), found.get(FORMER, "")


def _set_pointer(spark: SparkSession, names: Sequence[str], run: str, former: str) -> None:
    properties = f"TBLPROPERTIES ('{RUN}' = '{run}', '{FORMER}' = '{former}')"
    _run(spark, f"CREATE OR REPLACE VIEW {pointer_name(names)} {properties} AS SELECT '{run}' AS run")


def _columns(schema: StructType, wanted: StructType) -> str:
    mine = {f.name.lower(): f for f in schema.fields}
    out = []
    for f in wanted.fields:
        have = mine.get(f.name.lower())
        if have is not None and have.dataType != f.dataType:
            raise ValueError(f"publication would change column {f.name}: {have.dataType.simpleString()} -> {f.dataType.simpleString()}")
        out.append(f"`{f.name}`" if have is not None else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`")
    return ", ".join(out)


def _show(spark: SparkSession, name: str, run: str) -> None:
    """The view ``name`` over its version of ``run`` alone."""
    _run(spark, f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{RUN}' = '{run}') AS SELECT * FROM {version_name(name, run)}")


def _show_either(spark: SparkSession, names: Sequence[str], name: str, old: str, new: str) -> None:
    """The view ``name`` over the version that the pointer names."""
    fresh = spark.table(version_name(name, new)).schema
    parts = [(new, fresh)]
    if old and T.table_exists(spark, version_name(name, old)):
        parts.insert(0, (old, spark.table(version_name(name, old)).schema))
    wanted = StructType(list(fresh.fields))
    for f in parts[0][1].fields:
        if f.name.lower() not in {x.name.lower() for x in fresh.fields}:
            wanted = wanted.add(f)
    chosen = f"(SELECT run FROM {pointer_name(names)})"
    selects = [f"SELECT {_columns(schema, wanted)} FROM {version_name(name, run)} WHERE {chosen} = '{run}'" for run, schema in parts]
    _run(spark, f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{RUN}' = '') AS " + " UNION ALL ".join(selects))


def recover(spark: SparkSession, names: Sequence[str]) -> None:
    """Bring every report in line with the pointer after a run that died."""
    run, former = published(spark, names)
    for name in names:
        adopted = version_name(name, ADOPTED)
        if not run and T.table_exists(spark, adopted) and (not T.table_exists(spark, name) or _is_view(spark, name)):
            _show(spark, name, ADOPTED)  # a table that was being taken over
        elif run and T.table_exists(spark, version_name(name, run)):
            if _properties(spark, name).get(RUN) != run:
                _show(spark, name, run)
        elif T.table_exists(spark, name) and _is_view(spark, name) and _properties(spark, name).get(RUN) != ADOPTED:
            _run(spark, f"DROP VIEW IF EXISTS {name}")  # never published


def publish(spark: SparkSession, names: Sequence[str], run: str) -> None:
    """Make the tables ``version_name(name, run)`` the reports ``names``, all or none."""
    names = list(names)
    recover(spark, names)
    old, former = published(spark, names)
    for name in names:
        if T.table_exists(spark, name) and not _is_view(spark, name):
            _run(spark, f"ALTER TABLE {name} RENAME TO {version_name(name, ADOPTED)}")
            _show(spark, name, ADOPTED)
    if not old:
        old = ADOPTED if any(T.table_exists(spark, version_name(n, ADOPTED)) for n in names) else ""
        _set_pointer(spark, names, old, "")
    for name in names:
        _show_either(spark, names, name, old, run)
    _set_pointer(spark, names, run, old)
    for name in names:
        _show(spark, name, run)
    if former and former not in (old, run):
        for name in names:
            _run(spark, f"DROP TABLE IF EXISTS {version_name(name, former)}")


def discard(spark: SparkSession, names: Sequence[str], run: str) -> None:
    """Drop the versions of a run that was not published, once no view names them."""
    recover(spark, names)
    if run not in published(spark, names):
        for name in names:
            T.drop_table(spark, version_name(name, run))


def unpublish(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop the reports, their pointer and the versions it names."""
    runs = {r for r in published(spark, names) if r} | {ADOPTED}
    spark.sql(f"DROP VIEW IF EXISTS {pointer_name(names)}")
    for name in names:
        if T.table_exists(spark, name):
            spark.sql(f"DROP {'VIEW' if _is_view(spark, name) else 'TABLE'} IF EXISTS {name}")
        for run in runs:
            T.drop_table(spark, version_name(name, run))
