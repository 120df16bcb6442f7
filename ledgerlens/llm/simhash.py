"""SimHash near-duplicates by covering locality-sensitive hashing (operator 10).

A fingerprint has one bit for each of 64 positions: 1 if more than half of the
text's word-shingle hashes have it set.  Two fingerprints link if at most
``RADIUS`` bits differ; groups are the connected components of the links.

Covering hashing gives every bit position i a vector m(i) in F_2^(r+1), r the
radius.  Table v, for each v other than 0, keeps the bits whose m(i) has inner
product 1 with v.  The at most r vectors of the bits in which two linked
fingerprints differ span less than the space, so some v is orthogonal to all
of them: in that table the two have the same key.  No linked pair is missed,
whatever the data.  With r = 2 there are 7 tables of 36 or 37 bits each.

Equal fingerprints are one node, merged by a partial aggregate before any
table is built, so thousands of copies cost one row.  A bucket of at most
``BUCKET`` different fingerprints is compared in full within one row and gives
a spanning star of each of its groups, never all pairs.  Larger buckets are
never gathered: each of their fingerprints is spread over itself and its
single-bit changes in the bits that the table leaves open; two of them differ
in at most 2 bits exactly if they share such a value, so each value's minimum
(a partial aggregate) joined back gives all links needed, exactly and in work
linear in the bucket (this way is for radius 2 at most; a larger radius is
refused).

Defined results: a null, empty or wordless text has fingerprint 0 and links
like any other; fewer words than a shingle make one shingle of the whole;
repeated rows each get their row; rows with a null doc_id get a fingerprint
and their group's smallest doc_id that is not null (null if there is none); an
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import durable, ship
from ledgerlens.llm.graph import components
from ledgerlens.llm.pywords import word_blocks

SHINGLE = 3
RADIUS = 2
SEED = 42
BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    counts, total = np.zeros(64, np.int64), 0

    def add(shingles) -> int:
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        for at in range(0, len(h), 1 << 16):
            bits = np.unpackbits(h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            np.add(counts, bits.sum(axis=0, dtype=np.int64), out=counts)
        return len(h)

    # bytes.lower() changes A-Z alone
    tail: list[bytes] = []
    for block in word_blocks((text or "").encode().lower()):
        w = tail + block
        total += add(map(b" ".join, zip(*(w[i:] for i in range(shingle)))))
        tail = w[-(shingle - 1) :] if shingle > 1 else []
    if not total and tail:
        total = add([b" ".join(tail)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return fingerprints(text)


def masks(radius: int = RADIUS) -> list[int]:
    """The tables' bit masks as signed 64-bit integers."""
    n = 1 << (radius + 1)
    out = []
    for v in range(1, n):
        mask = sum(1 << i for i in range(64) if bin((i % (n - 1) + 1) & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _stars(buckets: pd.Series, radii: pd.Series) -> pd.Series:
    """Each bucket's links as a spanning star of each of its groups."""
    out = []
    for bucket, radius in zip(buckets, radii):
        x = np.sort(np.asarray(bucket, np.int64)).view(np.uint64)
        near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
        root = np.arange(len(x))
        while True:  # smallest index among the neighbours until nothing changes
            new = np.where(near, root[None, :], len(x)).min(axis=1)
            if (new == root).all():
                break
            root = new
        x = x.view(np.int64)
        out.append([{"a": int(x[i]), "b": int(x[r])} for i, r in enumerate(root) if i != r])
    return pd.Series(out)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between different fingerprints ``fp`` that have the same
    connected components as all links within the radius."""
    if not 0 <= radius <= 2:
        raise ValueError("the way for large buckets needs a radius of at most 2")
    tables = masks(radius)
    open_bits = [[1 << b for b in range(64) if not (m >> b) & 1] for m in tables]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in tables))).alias("t", "key"))
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = durable(rows.join(sizes, ["t", "key"]))
    stars = F.pandas_udf(_stars, "array<struct<a:long,b:long>>")
    few = met.where(F.col("n") <= BUCKET).groupBy("t", "key").agg(F.collect_list("fp").alias("bucket"))
    few = few.select(F.explode(stars("bucket", F.lit(radius))).alias("e")).select("e.a", "e.b")
    changes = F.array(*(F.array(F.lit(0).cast("long"), *(F.lit(signed(b)) for b in bits)) for bits in open_bits))
    spread = met.where(F.col("n") > BUCKET).select("fp", F.explode(F.get(changes, F.col("t"))).alias("x"))
    spread = spread.select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("z")).distinct()
    least = spread.groupBy("z").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b <> top").select("z", "b")
    many = spread.join(least, "z").where("fp <> b").select(F.col("fp").alias("a"), "b")
    if radius < 2:
        many = many.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return few.union(many).distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id."""
    ship(docs.sparkSession)
    light = durable(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint_column(F.col("text"), shingle).alias("fp")))
    nodes = light.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = durable(nodes)
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.join(ids, "root").select("fp", "component_id", "root")
    return light.join(member, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the document
    with the smallest doc_id stays (of rows that repeat it, one; of several
    texts under it, the one whose hash is smallest).  All columns stay."""
    found = groups(docs, shingle, radius)
    # null doc_ids last, so that they stay only where a group has no other
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = found.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("k_id"), F.col("k.text_hash").alias("k_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("r_id"), F.xxhash64("text").alias("r_hash"))
    rows = rows.join(kept, F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_hash") == F.col("k_hash")), "left_semi")
    return rows.dropDuplicates(["r_id", "r_hash"]).select("row.*")
