"""Shards of equal bytes by histogram sort (operator 7, native).

Documents are ordered by (h, doc_id), h being 60 bits of the text's MD5, so
equal texts lie together and shards are otherwise a random mix.  The splitters
of that order are found without sorting: each round counts, in one aggregate
over all partitions, the exact bytes and rows in the cells of a grid of probes
inside the intervals still open, and narrows every splitter's interval to the
cell that holds its target, until the boundary is within the tolerance or the
cell is a single row.  An interval that has shrunk to one h, a text with very
many copies, goes on by doc_id, and one of rows that repeat both by the row
number that was written with them.  Only the histogram (at most ``PROBES`` rows
a round) comes to the driver.

Besides the shards' own splitters the search finds others by rows instead of
bytes, at most ``PART_ROWS`` rows apart on average, so that very many tiny texts
are many parts too.  Then the rows move once, to their parts, where they are
numbered; the histogram already tells how many rows of the shard lie before
each part, so slots run through the shard without a gap.

Defined results: a null text counts as empty (size 1, checksum 0); null
doc_ids come first among equal texts; rows that repeat both text and doc_id
are split like any others; a very long text is one row, so its shard may be
larger by it; an empty table gives an empty result, and with fewer documents than
shards some shards are empty.  Other columns are carried along if asked for.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.llm.common import durable_table, text_of

SHARDS = 16
PROBES = 4096
TOLERANCE = 0  # bytes off the target at which a splitter is settled
PART_ROWS = 500_000
AT_ONCE = 256  # splitters searched for in the same rounds
BITS = 60
LOWEST = -(1 << 63)


class Splitter(NamedTuple):
    """Rows from (h, d, t) on lie to its right; rows: how many lie to its left."""

    h: int
    d: int
    t: int
    rows: int


class _Cell(NamedTuple):
    """A range of one part of the key, the parts before it being fixed."""

    level: int  # 0: h; 1: d at one h; 2: t at one h and d
    lo: int
    hi: int  # exclusive
    below: int  # bytes left of lo
    below_rows: int
    h: int = 0
    d: int = 0

    def edge(self, at: int, rows: int) -> Splitter:
        key = (at, LOWEST, LOWEST) if self.level == 0 else (self.h, at, LOWEST) if self.level == 1 else (self.h, self.d, at)
        return Splitter(*key, rows)


def size_of(text: Column) -> Column:
    return F.octet_length(text_of(text)).cast("long") + 1


def text_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text_of(text)), 1, BITS // 4), 16, 10).cast("long")


def _count(keys: DataFrame, cells: list[_Cell], probes: int) -> dict[int, list]:
    """For each open interval, its grid cells that hold rows, in order."""
    which, grid = F.lit(None).cast("int"), F.lit(None).cast("long")
    for j, c in enumerate(cells):
        step = -(-(c.hi - c.lo) // probes)
        key = "hdt"[c.level]
        wide = F.col(key).cast("decimal(20,0)")  # differences of longs may not fit a long
        inside = (wide >= F.lit(c.lo).cast("decimal(20,0)")) & (wide < F.lit(c.hi).cast("decimal(20,0)"))
        at = F.expr(f"cast((cast({key} AS decimal(20,0)) - ({c.lo})) div {step} AS bigint)")
        if c.level == 0:  # 60 bits: plain longs do
            inside, at = (F.col("h") >= c.lo) & (F.col("h") < c.hi), F.expr(f"(h - {c.lo}L) div {step}L")
        else:
            inside &= F.col("h") == c.h
        if c.level == 2:
            inside &= F.col("d") == F.lit(c.d)
        which, grid = F.when(inside, j).otherwise(which), F.when(inside, at).otherwise(grid)
    rows = keys.select(which.alias("j"), grid.alias("g"), "h", "d", "t", "size").where("j IS NOT NULL")
    counted = rows.groupBy("j", "g").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
        *(f(k).alias(f"{k}{i}") for k in "hdt" for i, f in enumerate((F.min, F.max))),
    )
    out: dict[int, list] = {j: [] for j in range(len(cells))}
    for r in sorted(counted.collect(), key=lambda r: (r.j, r.g)):  # at most PROBES rows
        out[r.j].append(r)
    return out


def splitters(keys: DataFrame, parts: int, tolerance: int = TOLERANCE, probes: int = PROBES) -> tuple[list[Splitter], int]:
    """The ``parts - 1`` splitters of rows (h, d, t, size) into parts of nearly
    equal bytes, each on the boundary nearest its target, and the row count."""
    out, n = [], 0
    for first in range(1, max(2, parts), AT_ONCE):
        found, n = _splitters(keys, parts, range(first, min(parts, first + AT_ONCE)), tolerance, probes)
        out += found
    return out, n


def _splitters(keys: DataFrame, parts: int, which: range, tolerance: int, probes: int) -> tuple[list[Splitter], int]:
    total, n = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n:
        return [], 0
    whole = _Cell(0, 0, 1 << BITS, 0, 0)
    found: dict[int, Splitter] = {}
    waiting = dict.fromkeys(which, whole)
    while waiting:
        cells = list(dict.fromkeys(waiting.values()))
        counted = _count(keys, cells, max(2, probes // len(cells)))
        new = {}
        for i, cell in waiting.items():
            # all compared times `parts`, so that targets are whole numbers
            target, below, rows = total * i, cell.below, cell.below_rows
            for r in counted[cells.index(cell)]:
                ranges = ((r.h0, r.h1), (r.d0, r.d1), (r.t0, r.t1))[cell.level :]
                lo, hi = ranges[0]
                if below * parts >= target - tolerance * parts:
                    found[i] = cell.edge(lo, rows)
                    break
                after = below + r.bytes
                if after * parts >= target:
                    if all(x == y for x, y in ranges):  # a single row
                        first = target - below * parts <= after * parts - target
                        found[i] = Splitter(r.h0, r.d0, r.t0, rows) if first else Splitter(r.h0, r.d0, r.t0 + 1, rows + r.rows)
                    elif (after * parts - target) <= tolerance * parts:
                        below, rows = after, rows + r.rows
                        continue
                    elif lo == hi:  # on by the next part of the key
                        new[i] = _Cell(cell.level + 1, ranges[1][0], ranges[1][1] + 1, below, rows, r.h0, r.d0)
                    else:
                        new[i] = _Cell(cell.level, lo, hi + 1, below, rows, cell.h, cell.d)
                    break
                below, rows = after, rows + r.rows
            else:
                found[i] = cell.edge(cell.hi, rows)
        waiting = new
    return [found[i] for i in which], n


def _part(cuts: list[Splitter], first: int = 0) -> Column:
    """How many splitters are at or left of the row, by halving."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    h, d, t, _ = cuts[mid]
    left = (F.col("h") < h) | ((F.col("h") == h) & ((F.col("d") < F.lit(d)) | ((F.col("d") == F.lit(d)) & (F.col("t") < F.lit(t)))))
    return F.when(left, _part(cuts[:mid], first)).otherwise(_part(cuts[mid + 1 :], first + mid + 1))


def shard(docs: DataFrame, shards: int = SHARDS, carry: list[str] | None = None, tolerance: int = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` of the columns ``carry``
    (default: all), size, text_crc32, shard and slot."""
    d = F.coalesce("doc_id", F.lit(LOWEST))
    full = docs.select(
        F.struct(*(docs.columns if carry is None else carry)).alias("row"),
        text_key(F.col("text")).alias("h"), d.alias("d"), size_of(F.col("text")).alias("size"),
        F.crc32(text_of("text")).alias("text_crc32"), F.monotonically_increasing_id().alias("t"),
    )
    keyed = durable_table(full)
    keys = keyed.select("h", "d", "t", "size")
    own, n = splitters(keys, shards, tolerance)
    many = max(4 * shards, -(-n // PART_ROWS))
    rows, _ = splitters(keys.withColumn("size", F.lit(1).cast("long")), many, n // (4 * many))
    # left to right; a part's shard is the number of the shards' splitters up to it
    cuts = sorted([(c, 1) for c in own] + [(c, 0) for c in rows])
    part_shard, part_before, at, start = [0], [0], 0, 0
    for c, new in cuts:
        at, start = at + new, c.rows if new else start
        part_shard.append(at)
        part_before.append(c.rows - start)
    lookup = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("part"))
    placed = keyed.withColumn("part", _part([c for c, _ in cuts]))
    number = F.row_number().over(W.partitionBy("part").orderBy("h", "d", "t"))
    return placed.select(
        "row", "size", "text_crc32",
        lookup(part_shard, "int").alias("shard"),
        (number - 1 + lookup(part_before, "long")).cast("long").alias("slot"),
    )
