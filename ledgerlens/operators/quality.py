"""Data-quality and reconciliation operators.

Each check is one Spark job that returns rows, not a driver loop of
``count()`` actions: a NULL profile of an n-column table is one aggregate,
not 1 + n scans.  Checks over keys pre-aggregate the keys before any
shuffle, so a key holding a third of the rows moves as a handful of partial
rows.  The boolean helpers (``passes``, ``check_schema``) collect one row or
read only the schema.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.functions import money
from ledgerlens.functions.columns import BEFORE_AFTER_LABELS


# ---- NULL profile and verdict (Q1, Q2, A6, A7, F2) --------------------------


def _label_map(labels: Sequence[str], prefix: str):
    """Literal map from internal column aliases back to the original labels
    (labels may hold dots or spaces, which column names cannot carry safely)."""
    pairs = []
    for i, label in enumerate(labels):
        pairs += [F.lit(f"{prefix}{i}"), F.lit(label)]
    return F.create_map(*pairs)


def profile(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: ``table_name, column_name, row_count, null_count``.

    A single aggregate pass computes every column's NULL count; ``unpivot``
    turns the one wide row into rows.  An empty table gives zero counts.
    """
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("row_count")] + [
        F.count_if(df[f"`{c}`"].isNull()).alias(f"_n{i}") for i, c in enumerate(names)
    ]
    wide = df.agg(*aggs)
    long = wide.unpivot("row_count", [f"_n{i}" for i in range(len(names))], "_column", "null_count")
    return long.select(
        F.lit(table_name).alias("table_name"),
        _label_map(names, "_n")[F.col("_column")].alias("column_name"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("null_count").cast("bigint").alias("null_count"),
    )


def verdict(profiles: DataFrame) -> DataFrame:
    """Q1/Q2 verdict per table from ``profile`` rows.

    ``passed_lenient``: the table has rows (NULLs are reported, not fatal).
    ``passed_strict``: the table has rows and no NULL anywhere.
    """
    per_table = profiles.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.sum("null_count").cast("bigint").alias("null_cells"),
        F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
    )
    return per_table.select(
        "table_name",
        "row_count",
        "null_cells",
        "columns_with_nulls",
        (F.col("row_count") > 0).alias("passed_lenient"),
        ((F.col("row_count") > 0) & (F.col("null_cells") == 0)).alias("passed_strict"),
    )


def passes(df: DataFrame, table_name: str, strict: bool = False) -> bool:
    """Q1 (lenient) / Q2 (strict) as a bool; one job, one row to the driver."""
    row = verdict(profile(df, table_name)).first()
    return bool(row["passed_strict"] if strict else row["passed_lenient"])


# ---- schema checks (Q3-Q5) ----------------------------------------------


class SchemaMismatch(ValueError):
    """Raised by ``check_schema``."""


def check_schema(df: DataFrame, expected: StructType, mode: str = "equal") -> None:
    """Q3-Q5: compare names and types, ignoring nullability.

    ``equal``: same fields in the same order.  ``compatible``: every
    expected field is present with the same type; extra fields are allowed
    (backward-compatible evolution).
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    if mode == "equal":
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in expected.fields]
        if got != want:
            raise SchemaMismatch(f"schema differs: expected {want}, got {got}")
        return
    if mode != "compatible":
        raise ValueError(f"mode must be 'equal' or 'compatible', got {mode!r}")
    for field in expected.fields:
        if field.name not in actual:
            raise SchemaMismatch(f"missing column {field.name}")
        if actual[field.name] != field.dataType:
            raise SchemaMismatch(
                f"column {field.name} has type {actual[field.name]}, expected {field.dataType}"
            )


def schema_diff(df: DataFrame, expected: StructType, table_name: str) -> DataFrame:
    """Q3-Q5 as rows: ``table_name, field, position, expected, found, verdict``,
    one row per field of either schema.

    ``verdict``: ``equal``; ``moved`` (same type, another place among the
    expected fields' order); ``type`` (another type); ``missing``; ``added``
    (compatible evolution).  Nullability is ignored.  The rows come from the
    schemas, so no data is read.
    """
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    known = [c for c in have if c in want]  # in the frame's order
    order = [c for c in want if c in have]  # in the expected order
    rows = []
    for i, (name, kind) in enumerate(want.items()):
        found = have.get(name)
        if found is None:
            verdict_ = "missing"
        elif found != kind:
            verdict_ = "type"
        else:
            verdict_ = "equal" if known.index(name) == order.index(name) else "moved"
        rows.append((table_name, name, i, kind, found, verdict_))
    rows += [(table_name, c, len(want) + i, None, t, "added") for i, (c, t) in enumerate((c, t) for c, t in have.items() if c not in want)]
    schema = "table_name string, field string, position int, expected string, found string, verdict string"
    return df.sparkSession.createDataFrame(rows, schema)


def require_columns(df: DataFrame, table_name: str, columns: Sequence[str]) -> None:
    """Q3 for sources (Q20): stop before any job if a needed column
    was removed or renamed; the message names the table and the columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"{table_name} lacks required columns {missing}; has {df.columns}")


# ---- keys: duplicates, integrity, key sets (A8, A10, Q6, U2, J8) -------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: key values that occur more than once, with ``row_count``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def _key_pairs(child_keys: Sequence[str], parent_keys: Sequence[str] | None):
    parent_keys = list(parent_keys or child_keys)
    if len(parent_keys) != len(child_keys):
        raise ValueError("child and parent key lists differ in length")
    return list(child_keys), parent_keys


def missing_parents(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose key has no parent row (NOT EXISTS semantics).

    A NULL child key has no parent and is returned, as NOT EXISTS does.
    Parent keys are made distinct first (combined map-side), so a parent key
    repeated a billion times is one row in the anti join; a hot child key is
    on the side AQE's skew join can split.
    """
    ck, pk = _key_pairs(keys, parent_keys)
    p = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]).distinct()
    cond = [child[c] == p[f"_p{i}"] for i, c in enumerate(ck)]
    return child.join(p, cond, "left_anti")


def missing_parent_keys(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """U2, Q6 at scale: distinct orphan keys with their ``child_rows``.

    The child side is reduced to one row per key (partial aggregation) before
    the anti join, so a hot key costs one row in the shuffle.
    """
    ck, _ = _key_pairs(keys, parent_keys)
    per_key = child.groupBy(*ck).agg(F.count(F.lit(1)).alias("child_rows"))
    return missing_parents(per_key, parent, ck, parent_keys)


@dataclass(frozen=True)
class Edge:
    """A child -> parent reference checked by ``integrity_report``.

    ``rows`` names a column of the child with the number of rows each of its
    rows stands for (a child that is aggregated already)."""

    name: str
    child: DataFrame
    parent: DataFrame
    keys: Sequence[str]
    parent_keys: Sequence[str] | None = None
    rows: str | None = None


WHOLE = ("byte", "short", "integer", "long")


def _plain_numbers(edges: Sequence[Edge]) -> bool:
    """True when every key is one whole number."""
    sides = [side for e in edges for side in zip((e.child, e.parent), _key_pairs(e.keys, e.parent_keys))]
    if any(len(keys) > 1 for _, keys in sides):
        return False
    used: dict[int, tuple[DataFrame, set[str]]] = {}
    for df, keys in sides:
        used.setdefault(id(df), (df, set()))[1].update(keys)
    return all(f.dataType.typeName() in WHOLE for df, keys in used.values() for f in df.schema.fields if f.name in keys)


def _key(keys: Sequence[str], number: bool) -> Column:
    """The key as a number, else as an array of texts, in which equal whole
    numbers of any width agree."""
    return F.col(f"`{keys[0]}`").cast("bigint") if number else F.array(*[F.col(f"`{k}`").cast("string") for k in keys])


def integrity_report(edges: Sequence[Edge]) -> DataFrame:
    """One row per edge: ``edge, missing_keys, missing_rows``.

    Empty means pass: both counts are zero.  All edges are checked in one
    aggregate: every frame is read once and gives, for each edge in which it is
    the child and each parent key it holds, a key tagged with that role; the
    keys of a parent and of all its children meet in one group, combined
    map-side, so a hot key on either side is one row per task.  A NULL in a
    child's key has no parent (NOT EXISTS); one in a parent's key is no parent.
    """
    number = _plain_numbers(edges)
    parents: list[tuple[DataFrame, tuple[str, ...]]] = []  # the key spaces
    roles: dict[int, tuple[DataFrame, list[Column]]] = {}  # by frame

    def role(df: DataFrame, space: int, keys: Sequence[str], edge: int, rows: Column) -> None:
        tag = F.struct(F.lit(space).alias("space"), _key(keys, number).alias("key"), F.lit(edge).alias("edge"), rows.cast("bigint").alias("rows"))
        roles.setdefault(id(df), (df, []))[1].append(tag)

    for i, edge in enumerate(edges):
        ck, pk = _key_pairs(edge.keys, edge.parent_keys)
        space = next((j for j, (p, k) in enumerate(parents) if p is edge.parent and k == tuple(pk)), None)
        if space is None:
            space = len(parents)
            parents.append((edge.parent, tuple(pk)))
            role(edge.parent, space, pk, -1, F.lit(0))
        role(edge.child, space, ck, i, F.lit(1) if edge.rows is None else F.col(edge.rows))
    tagged = None
    for df, tags in roles.values():
        one = df.select(F.explode(F.array(*tags)).alias("t")).select("t.*") if len(tags) > 1 else df.select(tags[0].alias("t")).select("t.*")
        tagged = one if tagged is None else tagged.unionByName(one)
    whole = F.col("key").isNotNull() if number else F.forall("key", lambda k: k.isNotNull())
    per_key = tagged.groupBy("space", "key").agg(
        F.max((F.col("edge") == -1) & whole).alias("present"),
        *[F.sum(F.when(F.col("edge") == i, F.col("rows"))).alias(f"_e{i}") for i in range(len(edges))],
    )
    missing = per_key.where(~F.col("present"))
    counts = missing.agg(
        *[F.count(f"_e{i}").alias(f"_k{i}") for i in range(len(edges))],
        *[F.coalesce(F.sum(f"_e{i}"), F.lit(0)).cast("bigint").alias(f"_n{i}") for i in range(len(edges))],
    )
    found = F.array(*[
        F.struct(F.lit(e.name).alias("edge"), F.col(f"_k{i}").alias("missing_keys"), F.col(f"_n{i}").alias("missing_rows")) for i, e in enumerate(edges)
    ])
    return counts.select(F.inline(found))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key values."""
    return df.select(*keys).distinct()


# ---- row rules (Q7, Q9, Q10, Q12, Q13, Q16) ---------------------------------


@dataclass(frozen=True)
class Rule:
    """A named row rule: ``flags`` is TRUE for an offending row; NULL passes."""

    name: str
    flags: Column
    value: Column


def violations(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Offending rows as ``keys..., rule, value`` (value as text).

    One pass over ``df`` for all rules: each row builds an array of the
    rules it breaks, which is exploded; rows that break nothing vanish.
    No shuffle.
    """
    hits = F.array(
        *[
            F.when(r.flags, F.struct(F.lit(r.name).alias("rule"), r.value.cast("string").alias("value")))
            for r in rules
        ]
    )
    found = F.filter(hits, lambda h: h.isNotNull())
    return df.select(*keys, F.explode(found).alias("_hit")).select(
        *keys, F.col("_hit.rule").alias("rule"), F.col("_hit.value").alias("value")
    )


def violation_counts(df: DataFrame, table_name: str, rules: Sequence[Rule]) -> DataFrame:
    """Per rule: ``table_name, rule, violations``; one aggregate pass."""
    wide = df.agg(*[F.count_if(F.coalesce(r.flags, F.lit(False))).alias(f"_r{i}") for i, r in enumerate(rules)])
    long = wide.unpivot([], [f"_r{i}" for i in range(len(rules))], "_rule", "violations")
    return long.select(
        F.lit(table_name).alias("table_name"),
        _label_map([r.name for r in rules], "_r")[F.col("_rule")].alias("rule"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def flag(df: DataFrame, rule: Rule, mode: str = "flag") -> DataFrame:
    """Q9 handling: ``accept`` keeps rows as they are, ``reject`` drops
    offending rows, ``flag`` adds a boolean column named after the rule."""
    offending = F.coalesce(rule.flags, F.lit(False))
    if mode == "accept":
        return df
    if mode == "reject":
        return df.where(~offending)
    if mode == "flag":
        return df.withColumn(rule.name, offending)
    raise ValueError(f"mode must be accept, reject or flag, got {mode!r}")


# ---- reconciliation and equality (Q8, Q11, U3) ------------------------------


def reconcile(
    summary: DataFrame,
    detail: DataFrame,
    keys: Sequence[str] = ("BRANCH_ID",),
    *,
    summary_count: str = "TOTAL_TRANSACTIONS",
    summary_amount: str = "TOTAL_AMOUNT",
    detail_amount: str = "AMOUNT",
    detail_count: str | None = None,
    tolerance: float = 0.01,
    only_mismatches: bool = False,
) -> DataFrame:
    """Q8: re-aggregate ``detail`` by ``keys`` and compare with ``summary``.

    Counts must be equal and amounts within ``tolerance``.  Keys present on
    one side only do not match.  The detail side is aggregated before the
    full outer join, so the join moves one row per key.  ``detail_count``
    names a column of partial row counts when ``detail`` is already
    pre-aggregated (e.g. per account); its values are summed instead of
    counting rows.
    """
    keys = list(keys)
    n = F.count(F.lit(1)) if detail_count is None else F.sum(detail_count)
    d = detail.groupBy(*keys).agg(
        n.cast("bigint").alias("detail_count"),
        F.sum(detail_amount).cast("double").alias("detail_amount"),
    )
    s = summary.select(
        *keys,
        F.col(summary_count).cast("bigint").alias("summary_count"),
        F.col(summary_amount).cast("double").alias("summary_amount"),
    )
    j = s.join(d, keys, "full")
    counts_match = F.coalesce(F.col("summary_count") == F.col("detail_count"), F.lit(False))
    both_null = F.col("summary_amount").isNull() & F.col("detail_amount").isNull()
    amounts_match = F.coalesce(
        F.abs(F.col("summary_amount") - F.col("detail_amount")) < F.lit(tolerance), F.lit(False)
    ) | (both_null & F.col("summary_count").isNotNull() & F.col("detail_count").isNotNull())
    out = j.select(
        *keys,
        "summary_count",
        "detail_count",
        "summary_amount",
        "detail_amount",
        counts_match.alias("counts_match"),
        amounts_match.alias("amounts_match"),
    )
    if only_mismatches:
        out = out.where(~(F.col("counts_match") & F.col("amounts_match")))
    return out


def _tagged(a: DataFrame, b: DataFrame) -> tuple[list[str], DataFrame]:
    cols = a.columns
    if sorted(cols) != sorted(b.columns):
        raise ValueError(f"frames have different columns: {cols} vs {b.columns}")
    left = a.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    right = b.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    return cols, left.unionByName(right)


def frame_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs between ``a`` and ``b``.

    Output: the row, ``diff_side`` ('left_only' / 'right_only') and
    ``diff_rows`` (how many more copies that side has).  Equivalent to
    ``exceptAll`` both ways, in one aggregate: identical rows (NULL-safe)
    collapse map-side, so a repeated row never gathers in one task.
    """
    cols, tagged = _tagged(a, b)
    per_row = tagged.groupBy(*cols).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    net = F.col("_l") - F.col("_r")
    return per_row.where(net != 0).select(
        *cols,
        F.when(net > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("diff_side"),
        F.abs(net).cast("bigint").alias("diff_rows"),
    )


def diff_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q11: one row ``rows_left, rows_right, differing_rows``; 0 means equal."""
    cols, tagged = _tagged(a, b)
    per_row = tagged.groupBy(*cols).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).cast("bigint").alias("rows_left"),
        F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias("rows_right"),
        F.coalesce(F.sum(F.abs(F.col("_l") - F.col("_r"))), F.lit(0)).cast("bigint").alias("differing_rows"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row ``rows, h0, h1`` that depends on the rows of ``df`` as a multiset:
    their number and the exact sums of two 64-bit hashes of each row.

    One aggregate combined in every task: no row is shuffled, whatever the size.
    NULLs are told apart by a flag per column.  Frames with equal rows have equal
    fingerprints; others differ but for a chance of about 2**-128 a pair.
    """
    cols = [F.col(f"`{c}`") for c in (columns or df.columns)]
    flags = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    hashes = [F.xxhash64(F.lit(seed), flags, *cols).cast("decimal(20,0)") for seed in ("first", "second")]
    sums = [F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").alias(f"h{i}") for i, h in enumerate(hashes)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)


def compare_frames(a: DataFrame, b: DataFrame) -> DataFrame:
    """Q11: ``diff_summary`` without moving a row where the frames are equal.

    The fingerprints of both sides are taken first (two rows to the driver); if
    they agree, the row counts are the answer, else the exact comparison runs.
    Read both frames from tables: on a mismatch they are read twice.
    """
    cols = a.columns
    if sorted(cols) != sorted(b.columns):
        raise ValueError(f"frames have different columns: {cols} vs {b.columns}")
    left, right = fingerprint(a, cols).first(), fingerprint(b, cols).first()
    if left != right:
        return diff_summary(a, b)
    schema = "rows_left bigint, rows_right bigint, differing_rows bigint"
    return a.sparkSession.createDataFrame([(left["rows"], right["rows"], 0)], schema)


def key_set_compare(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``keys_left, keys_right, only_left, only_right`` over the
    distinct key sets of ``a`` and ``b``; equal sets give zeros on the right."""
    keys = list(keys)
    left = a.select(*keys).distinct().select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    right = b.select(*keys).distinct().select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    per_key = left.unionByName(right).groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return per_key.agg(
        F.count_if(F.col("_l") == 1).alias("keys_left"),
        F.count_if(F.col("_r") == 1).alias("keys_right"),
        F.count_if((F.col("_l") == 1) & (F.col("_r") == 0)).alias("only_left"),
        F.count_if((F.col("_l") == 0) & (F.col("_r") == 1)).alias("only_right"),
    )


# ---- coverage and completeness (J7, Q15, P13) -------------------------------


def coverage(
    branch: DataFrame,
    details: DataFrame,
    key: str = "BRANCH_ID",
    *,
    max_missing: float = 0.05,
    distinct: bool = False,
) -> DataFrame:
    """BRANCH LEFT JOIN details, counted.

    The literal form counts join rows, so a duplicated detail row counts a
    branch twice; ``distinct=True`` counts distinct branch keys instead.
    ``breached`` is TRUE when the missing share exceeds ``max_missing``.

    Details are reduced to one row per key with its row count before the
    join (a hot key costs one row), and the literal counts are rebuilt from
    those counts: a branch row matching n details rows stands for n join
    rows, one without a match for one.
    """
    b = branch.select(F.col(key).cast("bigint").alias("_bk"))
    d = details.groupBy(F.col(key).cast("bigint").alias("_dk")).agg(F.count(F.lit(1)).alias("_n"))
    if distinct:
        # one row per branch key first, so the counts need no further distinct
        b = b.where(F.col("_bk").isNotNull()).distinct()
    j = b.join(d, b["_bk"] == d["_dk"], "left")
    if distinct:
        total, present = F.count(F.lit(1)), F.count("_dk")
    else:
        total = F.sum(F.coalesce(F.col("_n"), F.lit(1)))
        present = F.sum(F.coalesce(F.col("_n"), F.lit(0)))
    counts = j.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total_branches"),
        F.coalesce(present, F.lit(0)).cast("bigint").alias("branches_with_operational_details"),
    )
    missing = F.col("total_branches") - F.col("branches_with_operational_details")
    share = F.try_divide(missing.cast("double"), F.col("total_branches").cast("double"))
    return counts.select(
        "total_branches",
        "branches_with_operational_details",
        missing.alias("missing_operational_details"),
        share.alias("missing_share"),
        F.coalesce(share > F.lit(max_missing), F.lit(False)).alias("breached"),
    )


def report_completeness(report: DataFrame) -> DataFrame:
    """Q15: completeness of the enriched report's new columns, one row."""
    return report.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("REGION").alias("records_with_region"),
        F.count("LAST_AUDIT_DATE").alias("records_with_audit_date"),
        F.count_if(F.col("REGION").isNull()).alias("missing_region_data"),
    )


def amount_totals(df: DataFrame, amount: str = "AMOUNT") -> DataFrame:
    """A5: global ``row_count`` and exact ``total_amount`` (as DOUBLE)."""
    out = df.agg(F.count(F.lit(1)).alias("row_count"), *money.partial_sums(df, amount))
    return out.select("row_count", money.total(out.columns, "row_count").cast("double").alias("total_amount"))


# ---- counts and stage metrics (A6, Q14, Q17) ---------------------------------


def record_counts(frames: Mapping[str, DataFrame], *, with_timestamp: bool = False) -> DataFrame:
    """``stage, record_count`` for each named frame (lazy, one job).

    ``with_timestamp`` adds the query's ``current_timestamp()`` as
    ``timestamp`` (left out of compared output: it differs per run).
    """
    rows = None
    for stage, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(stage).alias("stage"), "record_count"
        )
        rows = one if rows is None else rows.unionByName(one)
    if with_timestamp:
        rows = rows.withColumn("timestamp", F.current_timestamp())
    return rows


def count_match(source: DataFrame, target: DataFrame, source_name: str, target_name: str) -> DataFrame:
    """Q14: one row ``source, source_rows, target, target_rows, counts_match``.

    Both counts come from one aggregate over the union of the two inputs
    (no columns are read, only rows counted).
    """
    s = source.select(F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t = target.select(F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    counts = s.unionByName(t).agg(
        F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("target_rows"),
    )
    return counts.select(
        F.lit(source_name).alias("source"),
        "source_rows",
        F.lit(target_name).alias("target"),
        "target_rows",
        (F.col("source_rows") == F.col("target_rows")).alias("counts_match"),
    )


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Q17 without a second job: attach a row counter to ``df``.

    After the first action on the returned frame (e.g. its write),
    ``observation.get`` holds ``{"record_count": n}``.
    """
    observation = Observation(stage)
    return df.observe(observation, F.count(F.lit(1)).alias("record_count")), observation


def observed_profile(df: DataFrame, table_name: str) -> tuple[DataFrame, Observation]:
    """Q1/Q17 during another action: row count and per-column NULL counts
    are collected while ``df`` is written, with no extra pass.

    Read the result with ``verdict_from_observation`` after the action.
    """
    observation = Observation(f"profile {table_name}")
    metrics = [F.count(F.lit(1)).alias("row_count")] + [
        F.count_if(F.col("`" + c.replace("`", "``") + "`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)
    ]
    return df.observe(observation, *metrics), observation


def verdict_from_observation(table_name: str, columns: Sequence[str], observation: Observation) -> dict:
    """The ``verdict`` row of an observed profile, as a dict."""
    metrics = observation.get
    rows = int(metrics["row_count"])
    nulls = [int(metrics[f"null_{i}"]) for i in range(len(columns))]
    return {
        "table_name": table_name,
        "row_count": rows,
        "null_cells": sum(nulls),
        "columns_with_nulls": sum(1 for n in nulls if n > 0),
        "passed_lenient": rows > 0,
        "passed_strict": rows > 0 and sum(nulls) == 0,
        "null_counts": dict(zip(columns, nulls)),
    }


VERDICT_SCHEMA = (
    "table_name string, row_count bigint, null_cells bigint, columns_with_nulls bigint, passed_lenient boolean, passed_strict boolean"
)


def verdict_frame(spark: SparkSession, verdicts: Sequence[Mapping]) -> DataFrame:
    """Verdicts from observations as rows like those of ``verdict``."""
    names = [c.split()[0] for c in VERDICT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(v[n] for n in names) for v in verdicts], VERDICT_SCHEMA)


def before_after_counts(
    before: DataFrame,
    after: DataFrame,
    labels: tuple[str, str] = BEFORE_AFTER_LABELS,
) -> DataFrame:
    """``version, record_count, column_count`` for two report versions."""
    rows = None
    for label, df in zip(labels, (before, after)):
        one = df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(label).alias("version"),
            "record_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows
