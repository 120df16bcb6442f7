"""Merkle manifest of a table, verified by a recursive query (operator 11).

Every row is a leaf: the SHA-256 of its columns, each written as byte count,
colon and value, or ``-`` for null.  Leaves are numbered within their group by
key; each run of ``FAN`` consecutive nodes becomes a parent, level by level,
until one node per group is left; these subroots, in the groups' order, are
reduced to the root the same way.

The levels are stored as parent-linked node rows: for each parent the digests
of its run, under the cell of leaves that climbs through it.  The climb is
one recursive query of Spark SQL: each turn joins every leaf with its next
parent, folds the leaf's (tampered) hash with its siblings there, left and right,
and appends these siblings to the leaf's path.  As a turn's rows are written, a
path holds them by reference, which is the leaf's place in each run it came
through: fifteen digests a level for every leaf would be many times the table.
The proof takes the digests from the node rows by that path, in one join with
the leaf's own run and one with the runs above it, which 256 leaves share.

A high node has very many leaves below it, and in the join with the climbing
leaves it would be a hot key.  Its row is therefore stored once for each cell of
``CELL`` leaves, so no key of the climb serves more than ``CELL`` rows.  Leaves
are numbered by range partitions and running totals of their counts, so a group
with a third of all rows is spread over many tasks.  Everything a turn needs is
in written tables; a lost executor costs the turns it held.

Defined results: null keys come first; rows equal in key are ordered by digest,
so which of two equal rows comes first changes nothing; a null group is a group
and comes first; an empty text has its count ``0:``; a very long text is one
hash input; a lone leaf is its subroot, a lone subroot the root, and the proof of
a table of one row is the hash of nothing; tampering leaves null texts as they
are; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import durable_table, numbered, small

FAN = 16
CELL = 256  # leaves; a power of FAN
FEW = 1024  # copies of a node row written by one step
MAX_LEVELS = 15  # above the groups; FAN to this power is still a long
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(run: Column) -> Column:
    """The digest of a run: hash of its digests as hex text."""
    return F.unhex(F.sha2(hex_text(run), 256))


def levels(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (g, n, size, digest), n from 0 within g and size the nodes of g:
    the parents of all levels (g, level, n, run) and the last node of each g
    (g, digest, height)."""
    size = nodes.agg(F.max("size")).first()[0] or 0
    parents, tops, level = [], [], 0
    while True:
        tops.append(nodes.where("size = 1").select("g", "digest", F.lit(level).alias("height")))
        if size <= 1:
            break
        size, level = -(-size // FAN), level + 1
        run = F.sort_array(F.collect_list(F.struct("n", "digest")))  # at most FAN
        run = F.unhex(F.concat_ws("", F.transform(run, lambda x: F.hex(x["digest"]))))
        up = nodes.where("size > 1").groupBy("g", F.expr(f"n div {FAN}L").alias("n"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size")).agg(run.alias("run"))
        nodes = durable_table(up.withColumn("digest", fold(F.col("run"))))
        parents.append(nodes.select("g", F.lit(level).alias("level"), "n", "run"))
    none = nodes.sparkSession.createDataFrame([], "g long, level int, n long, run binary")
    return reduce(DataFrame.union, parents, none), reduce(DataFrame.union, tops)


def node_rows(parents: DataFrame, roots: DataFrame, groups: DataFrame) -> DataFrame:
    """Node rows (g, level, cell, at, run): the run that a leaf of group g in that
    cell meets on its way from level - 1 to level.  ``at`` is its place in the
    run where the whole cell shares one, else null (then it follows from the
    leaf's number).  ``groups``: g, r (its number), size, height."""
    # inside a group: a low parent is a cell of its own, a high one covers many
    low = parents.where(f"pow({FAN}, level) <= {CELL}").select("g", "level", F.col("n").alias("cell"), F.lit(None).cast("int").alias("at"), "run")
    wide = F.expr(f"cast(pow({FAN}, level) AS bigint) div {CELL}L")
    cells = F.expr(f"(size + {CELL - 1}) div {CELL}")
    high = parents.where(f"pow({FAN}, level) > {CELL}").join(small(groups.select("g", cells.alias("cells"))), "g")
    high = high.withColumn("wide", wide).withColumn("first", F.col("n") * F.col("wide"))
    high = high.withColumn("copies", F.least("wide", F.col("cells") - F.col("first")))
    at = F.expr(f"cast(cell div (wide div {FAN}L) % {FAN}L AS int)")
    high = _spread(high, "g", "level", "run", "wide").select("g", "level", "cell", at.alias("at"), "run")
    # above the groups: every cell of a group meets the group's own ancestors
    up = groups.select("g", "r", "height", cells.alias("copies"), F.lit(0).cast("long").alias("first"))
    up = up.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(MAX_LEVELS))))
    up = up.withColumn("n", F.expr(f"r div cast(pow({FAN}, step) AS bigint)")).withColumn("at", F.expr(f"cast(r div cast(pow({FAN}, step - 1) AS bigint) % {FAN}L AS int)"))
    above = up.join(roots.select(F.col("level").alias("step"), "n", "run"), ["step", "n"])
    above = _spread(above.withColumn("level", F.col("height") + F.col("step")), "g", "level", "run", "at")
    above = above.select("g", "level", "cell", "at", "run")
    return low.union(high).union(above)


def _spread(df: DataFrame, *keep: str) -> DataFrame:
    """A row for each of ``copies`` cells from ``first`` on, written by many
    tasks where they are many."""
    chunks = df.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {FEW})"))).repartition("g", "level", "first", "chunk")
    return chunks.select(*keep, F.explode(F.expr(f"sequence(first + chunk * {FEW}, first + least(chunk * {FEW} + {FEW}, copies) - 1)")).alias("cell"))


CLIMB = """
WITH RECURSIVE climb(g, n, level, hash, path) AS (
  SELECT g, n, 0, start, CAST(array() AS array<int>) FROM {leaves}
  UNION ALL
  SELECT g, n, level, unhex(sha2(lower(concat(hex(substring(run, 1, 32 * spot)), hex(hash), hex(substring(run, 32 * spot + 33)))), 256)), concat(path, array(spot))
  FROM (
    SELECT c.g, c.n, t.level, c.hash, c.path, t.run, coalesce(t.at, cast(c.n div CASE c.level WHEN 0 THEN 1L ELSE {fan}L END % {fan}L AS int)) AS spot
    FROM climb c JOIN {nodes} t
      ON t.g = c.g AND t.level = c.level + 1 AND t.cell = c.n div CASE c.level WHEN 0 THEN {fan}L ELSE {cell}L END
  )
)
SELECT g, n, level, hash, path FROM climb
"""


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """For every leaf (g, n, start) one row per level it reaches, from 0: the
    hash folded so far and the places it had in the runs on its way."""
    spark = leaves.sparkSession
    names = {k: f"{k}_{uuid.uuid4().hex}" for k in ("leaves", "nodes")}
    leaves.createOrReplaceTempView(names["leaves"])
    nodes.createOrReplaceTempView(names["nodes"])
    limit = "spark.sql.cteRecursionRowLimit"
    former = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # every leaf climbs, however many there are
    try:
        return durable_table(spark.sql(CLIMB.format(**names, fan=FAN, cell=CELL)))
    finally:
        spark.conf.set(limit, former)
        for name in names.values():
            spark.catalog.dropTempView(name)


def siblings(run: Column, at: Column) -> Column:
    """The digests of a run without the one at a place, as hex text."""
    return F.concat(hex_text(F.substring(run, F.lit(1), at * 32)), hex_text(F.substring(run, at * 32 + 33, F.lit(32 * FAN))))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified; digests as lowercase hex text."""
    leaf = lambda text: digest(*(F.col(c) for c in COLUMNS[:-1]), text)
    lowered = F.translate("text", UPPER, LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = docs.select(
        "doc_id",
        # sorts as the source does, null first, and is never null itself
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source"),
        leaf(F.col("text")).alias("leaf"),
        F.when(chosen, leaf(lowered)).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = durable_table(rows)
    sizes = durable_table(rows.groupBy("source").agg(F.count(F.lit(1)).alias("size")).withColumn("all", F.lit(0).cast("long")))
    groups = durable_table(numbered(sizes, ["all"], ["source"], "g"))
    rows = rows.join(small(groups.select("source", "g", "size")), "source").drop("source")
    rows = durable_table(numbered(durable_table(rows), ["g"], ["doc_id", "leaf", "tie"], "n"))

    parents, subroots = levels(rows.select("g", "n", "size", F.col("leaf").alias("digest")))
    groups = groups.join(small(durable_table(subroots)), "g").select("all", "g", F.col("g").alias("r"), "size", "height", F.col("digest").alias("subroot"))
    groups = durable_table(groups)
    roots, root = levels(groups.select(F.col("all").alias("g"), F.col("r").alias("n"), F.lit(groups.count()).cast("long").alias("size"), F.col("subroot").alias("digest")))
    nodes = durable_table(node_rows(parents, roots, groups))

    # each leaf's last row, at the height of its group and of the tree above
    whole = root.select(F.col("g").alias("all"), F.col("digest").alias("root"), F.col("height").alias("above"))
    tops = groups.join(F.broadcast(whole), "all")  # one row
    tops = small(durable_table(tops.select("g", "subroot", "root", (F.col("height") + F.col("above")).alias("level"))))
    ends = climb(rows.select("g", "n", F.coalesce("tampered", "leaf").alias("start")), nodes).join(tops, ["g", "level"])

    low = nodes.where("level = 1").select("g", F.col("cell").alias("own"), "run")
    high = nodes.where("level > 1").groupBy("g", "cell").agg(F.sort_array(F.collect_list(F.struct("level", "run"))).alias("runs"))  # one for each level
    ends = ends.withColumn("own", F.expr(f"n div {FAN}L")).withColumn("cell", F.expr(f"n div {CELL}L"))
    ends = ends.join(low, ["g", "own"], "left").join(high, ["g", "cell"], "left")
    first = F.coalesce(siblings(F.col("run"), F.get("path", F.lit(0))), F.lit(""))
    upper = F.transform("runs", lambda x, i: siblings(x["run"], F.get("path", i + 1)))
    proof = F.sha2(F.concat(first, F.coalesce(F.array_join(upper, ""), F.lit(""))), 256)
    ends = ends.select("g", "n", "subroot", "root", "hash", proof.alias("proof_sha256"))
    return rows.join(ends, ["g", "n"]).select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), hex_text(F.col("root")).alias("root"),
        "proof_sha256", hex_text(F.col("hash")).alias("folded_root"), (F.col("hash") == F.col("root")).alias("verified"),
    )
