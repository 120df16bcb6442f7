"""Exact top-k inner products by a pivot-distance index (operator 4).

Vectors are integer vectors, floor(SCALE * x).  Inner product becomes distance
by one more coordinate, sqrt(M2 - |x|^2) with M2 the largest squared norm: for
a query q (extra coordinate 0), |q' - x'|^2 = |q|^2 + M2 - 2 <q, x>.  There the
triangle inequality holds.

The index keys every vector by its nearest pivot and its distance to it.  A
pivot's vectors, sorted by distance, are cut into rings (annuli) at quantiles
of the distances, and large rings into chunks of about ``CHUNK`` vectors.  The
directory of rings (pivot, smallest and largest distance, count) and the
pivots are small constants and go to all tasks.

A query at distance t from a pivot can meet in a ring [a, b] nothing nearer
than max(t - b, a - t), nor nearer than half of t minus its distance to its
nearest pivot; so the ring has an upper bound of scores.  Rings are visited in
the order of their bounds: first the best few, which give the query a k-th best
score to beat; then all that can still hold that score, within them only the
distances the inequality leaves open.  A query stops at the rings whose bound
is below its k-th best score, so no result is lost; scores are exact integers.

Chunks and blocks of queries travel as packed rows, in the narrowest integers
that hold all components.  A block holds queries of like pivot and distance; a
chunk it visits gets one row of those of its queries that need the chunk, so
vectors are never copied to a block that does not visit them, and a chunk's own
vectors move once.  A task holds one chunk and one such row at a time, and
scores them in slices.  In high dimension few rings can be ruled out and the
work is that of comparing each query with each vector, in blocks.

Defined results: rows with a null vec_id and vectors that are null or hold
null or non-finite components take no part; vectors of unequal length are
padded with zeros; rows that repeat both id and vector are merged before the
index and come out as often as they are there; a query never meets rows of its
own vec_id; equal scores are ranked by vec_id; one query id with several
vectors is answered for each; fewer candidates than k give fewer rows; an
empty table gives an empty result; vectors whose squared norm passes 2^62 raise
an error, as scores could pass a long.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.llm.common import durable, durable_table, ship

SCALE = 64
PIVOTS = 16
RINGS = 4
CHUNK = 16_384
QUERY_BLOCK = 16_384
SLICE = 256  # queries scored at a time
SEEDS = 2  # rings visited first
SPREAD = 256  # chunks that one task sends a block's queries to


def integer_vectors(df: DataFrame, vec: str, id_col: str, scale: int) -> DataFrame:
    """vec_id, x (array of long, all of one length) and copies, of the valid rows."""
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    df = df.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).where(~bad)
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vec, lambda v: F.floor(scale * v.cast("double"))).alias("x"))
    return df.groupBy("vec_id", "x").agg(F.count(F.lit(1)).alias("copies"))


def _matrix(packed: bytes, index: Index) -> np.ndarray:
    return np.frombuffer(packed, index.kind).reshape(-1, index.dims).astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: through floats where they are exact, else integers."""
    top = lambda m: int(np.abs(m).max(initial=0))
    if a.shape[1] * top(a) * top(b) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Index:
    """The pivots and the rings' directory: what every task knows."""

    def __init__(self, pivots: np.ndarray, m2: int, top: int) -> None:
        self.pivots, self.m2, self.dims = pivots, m2, pivots.shape[1]
        self.kind = next(k for k in ("<i2", "<i4", "<i8") if top <= np.iinfo(k).max)  # holds all components
        self.lift = np.sqrt(np.maximum(0, m2 - (pivots**2).sum(axis=1)))
        self.rings = pd.DataFrame()

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of vectors to the pivots."""
        lift = np.sqrt(np.maximum(0, self.m2 - (x**2).sum(axis=1)))
        return np.sqrt(np.maximum(0, 2.0 * self.m2 - 2.0 * (_products(x, self.pivots) + lift[:, None] * self.lift[None, :])))

    def query_distances(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (q**2).sum(axis=1)[:, None] + self.m2 - 2.0 * _products(q, self.pivots)))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of each query in each ring."""
        t = self.query_distances(q)
        at = t[:, self.rings["pivot"].to_numpy()]
        least = np.maximum(at - self.rings.far.to_numpy(), self.rings.near.to_numpy() - at)
        least = np.maximum(least, (at - t.min(axis=1)[:, None]) / 2)
        least = np.maximum(0, least * (1 - 1e-9) - 1e-6)  # distances are rounded
        return ((q**2).sum(axis=1)[:, None] + self.m2 - least**2) / 2 + 1e-6


def _key_rows(index: Index):
    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array(b.x.tolist(), np.int64).reshape(len(b), index.dims)
                t = index.distances(x)
                nearest = t.argmin(axis=1)
                yield pd.DataFrame({"vec_id": b.vec_id, "v": [r.tobytes() for r in x.astype(index.kind)], "copies": b.copies, "pivot": nearest, "dist": t[np.arange(len(b)), nearest]})

    return rows


def _pack_chunk(keys: tuple, data: pd.DataFrame) -> pd.DataFrame:
    """One chunk as one row, sorted by the distance to its pivot."""
    data = data.sort_values(["dist", "vec_id"])
    whole = {c: [data[c].to_numpy().tobytes()] for c in ("vec_id", "copies", "dist")}
    return pd.DataFrame({"pivot": keys[:1], "ring": keys[1:2], "chunk": keys[2:], **whole, "v": [b"".join(data.v)]})


def _pack_block(keys: tuple, asked: pd.DataFrame) -> pd.DataFrame:
    """One block of queries as one row."""
    whole = {c: [asked[c].to_numpy().tobytes()] for c in ("q", "query_id", "least")}
    return pd.DataFrame({"block": keys, **whole, "qv": [b"".join(asked.v)]})


def _visits(index: Index, first: bool, spread: int):
    """For each block and chunk to visit, one row of the queries that visit it."""

    def wanted(block: tuple) -> np.ndarray:
        q, least = _matrix(block.qv, index), np.frombuffer(block.least)
        out = np.zeros((len(q), len(index.rings)), bool)
        for at in range(0, len(q), SLICE):
            bound = index.bounds(q[at : at + SLICE])
            if first:
                np.put_along_axis(out[at : at + SLICE], np.argsort(-bound, axis=1)[:, :SEEDS], True, axis=1)
            else:
                out[at : at + SLICE] = bound >= least[at : at + SLICE, None]
        return out

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block in b.itertuples():
                want = wanted(block)
                number = 0
                for r, ring in enumerate(index.rings.itertuples()):
                    need = np.flatnonzero(want[:, r])
                    part = {c: np.frombuffer(getattr(block, c), "i8")[need].tobytes() for c in ("q", "query_id", "least")}
                    part["qv"] = np.frombuffer(block.qv, index.kind).reshape(-1, index.dims)[need].tobytes()
                    for chunk in range(1 if first else ring.chunks):
                        if len(need) and number // spread == block.share:
                            yield pd.DataFrame([{"pivot": ring.pivot, "ring": ring.ring, "chunk": chunk, **part}])
                        number += 1

    return rows


def _score(index: Index, k: int):
    """The best k of a chunk for the queries that visit it."""

    def best(pair: tuple) -> Iterator[pd.DataFrame]:
        x, dist = _matrix(pair.v, index), np.frombuffer(pair.dist)
        ids, copies = np.frombuffer(pair.vec_id, "i8"), np.frombuffer(pair.copies, "i8")
        queries, number, query_ids, least = _matrix(pair.qv, index), np.frombuffer(pair.q, "i8"), np.frombuffer(pair.query_id, "i8"), np.frombuffer(pair.least)
        t = index.query_distances(queries)[:, pair.pivot]
        reach = np.sqrt(np.maximum(0, (queries**2).sum(axis=1) + index.m2 - 2 * least)) * (1 + 1e-9) + 1e-6
        near = np.argsort(t, kind="stable")  # so that a slice needs one stretch
        for at in range(0, len(near), SLICE):
            some = near[at : at + SLICE]
            # of the sorted annulus, the stretch any of the queries can need
            a, b = np.searchsorted(dist, (t - reach)[some].min()), np.searchsorted(dist, (t + reach)[some].max(), "right")
            if b <= a:
                continue
            out = []
            for i, s in zip(some, _products(queries[some], x[a:b])):
                may = np.flatnonzero((s >= least[i]) & (ids[a:b] != query_ids[i]))
                if len(may) > k:  # keep the k-th best score's ties, then rank
                    kth = np.partition(s[may], len(may) - k)[len(may) - k]
                    may = may[s[may] >= kth]
                j = may[np.lexsort((ids[a:b][may], -s[may]))[:k]]
                out.append((np.full(len(j), number[i]), np.full(len(j), query_ids[i]), ids[a:b][j], s[j], copies[a:b][j]))
            yield pd.DataFrame(dict(zip(("q", "query_id", "vec_id", "score", "copies"), map(np.concatenate, zip(*out)))))

    def hits(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for pair in b.itertuples():
                yield from best(pair)

    return hits


def top_k(df: DataFrame, queries, k: int = 20, vec: str = "embedding", id_col: str = "vec_id", scale: int = SCALE, chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row whose
    ``vec_id`` fulfils the condition ``queries`` (a column)."""
    ship(df.sparkSession)
    merged = durable(integer_vectors(df, vec, id_col, scale))
    spark, result = df.sparkSession, "query_id long, rank int, vec_id long, score long"
    rough = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    top, dims, rough = merged.agg(F.max(F.array_max(F.transform("x", F.abs))), F.max(F.size("x")), F.max(rough)).first()
    if rough is None:
        return spark.createDataFrame([], result)
    if rough > 2.0**62:
        raise ValueError("scores of these vectors can pass a long")
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v * v)
    m2 = merged.agg(F.max(norm)).first()[0]
    dims = max(1, dims)  # without components all scores are 0
    merged = merged.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))))
    sample = merged.orderBy(F.xxhash64("vec_id"), "vec_id").select("x").limit(PIVOTS).collect()
    index = Index(np.array([r.x for r in sample], np.int64).reshape(len(sample), dims), m2, top or 0)

    keyed = durable(merged.mapInPandas(_key_rows(index), "vec_id long, v binary, copies long, pivot int, dist double"))
    cuts = [i / RINGS for i in range(1, RINGS)]
    edges = {r.pivot: r.q for r in keyed.groupBy("pivot").agg(F.percentile_approx("dist", cuts).alias("q")).collect()}
    edge = F.element_at(F.create_map(*(c for p, q in edges.items() for c in (F.lit(p), F.array(*map(F.lit, q))))), F.col("pivot"))
    keyed = keyed.withColumn("ring", F.size(F.filter(edge, lambda e: e < F.col("dist"))))
    rings = keyed.groupBy("pivot", "ring").agg(F.min("dist").alias("near"), F.max("dist").alias("far"), F.count(F.lit(1)).alias("n"))
    index.rings = pd.DataFrame([r.asDict() for r in rings.collect()]).sort_values(["pivot", "ring"], ignore_index=True)  # PIVOTS * RINGS rows
    index.rings["chunks"] = -(-index.rings.n // chunk)
    pieces = F.create_map(*(c for r in index.rings.itertuples() for c in (F.lit(r.pivot * RINGS + r.ring), F.lit(r.chunks))))
    keyed = keyed.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.element_at(pieces, F.col("pivot") * RINGS + F.col("ring"))).cast("int"))

    keys = ["pivot", "ring", "chunk"]
    chunks = keyed.groupBy(*keys).applyInPandas(_pack_chunk, "pivot int, ring int, chunk int, vec_id binary, copies binary, dist binary, v binary")
    chunks = durable_table(chunks)

    # blocks of queries: by pivot and ring, about query_block in each
    asked = keyed.where(queries).select("pivot", "ring", F.col("vec_id").alias("query_id"), "v").distinct()
    counts = {(r.pivot, r.ring): r.n for r in asked.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n")).collect()}  # PIVOTS * RINGS rows
    if not counts:
        return spark.createDataFrame([], result)
    before = np.cumsum([0, *(n for _, n in sorted(counts.items()))])
    cell = F.col("pivot") * RINGS + F.col("ring")
    start = F.element_at(F.create_map(*(c for (key, _), at in zip(sorted(counts.items()), before) for c in (F.lit(key[0] * RINGS + key[1]), F.lit(int(at))))), cell)
    held = F.element_at(F.create_map(*(c for key, n in counts.items() for c in (F.lit(key[0] * RINGS + key[1]), F.lit(n)))), cell)
    place = start + F.pmod(F.xxhash64("query_id", "v"), held)
    asked = durable(asked.select(F.monotonically_increasing_id().alias("q"), "query_id", "v", F.floor(place / query_block).cast("int").alias("block")))

    total = int(index.rings.chunks.sum())
    tasks = min(total, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 4))
    packed = "q binary, query_id binary, least binary, qv binary"

    def search(asked: DataFrame, first: bool) -> DataFrame:
        number = len(index.rings) if first else total
        blocks = asked.groupBy("block").applyInPandas(_pack_block, f"block int, {packed}")
        shares = blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit((number - 1) // SPREAD)))).repartition("block", "share")
        visits = shares.mapInPandas(_visits(index, first, SPREAD), f"pivot int, ring int, chunk int, {packed}")
        pairs = visits.repartition(tasks, *keys).join(chunks, keys)
        return pairs.mapInPandas(_score(index, k), "q long, query_id long, vec_id long, score long, copies long")

    seen = search(asked.withColumn("least", F.lit(float("-inf"))), True)
    kth = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).cast("double")  # SEEDS * k scores
    least = seen.groupBy("q").agg(kth.alias("kth"))
    asked = durable(asked.join(least, "q", "left").select("q", "query_id", "v", "block", F.coalesce("kth", F.lit(float("-inf"))).alias("least")))
    found = search(asked, False)
    found = found.select("q", "query_id", "vec_id", "score", F.explode(F.array_repeat(F.lit(0), F.least("copies", F.lit(k)).cast("int"))))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
