"""The Merkle manifest against a brute-force version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle

SCHEMA = "text string, doc_id long, source string, lang string, n_chars long, leaf string, root int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reduce_levels(nodes):
    """All levels from the nodes to the one that is left."""
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def siblings(levels, n):
    """(left, right) on the way up from node n."""
    out = []
    for nodes in levels[:-1]:
        first = n - n % 16
        run = nodes[first : first + 16]
        out.append(("".join(run[: n - first]), "".join(run[n - first + 1 :])))
        n //= 16
    return out


def leaf_of(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: reduce_levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = reduce_levels([trees[s][-1][0] for s in order])
    out = []
    for rank, s in enumerate(order):
        for n, (_, _, leaf, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = siblings(trees[s], n) + siblings(top, rank)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of(r, text)
            for a, b in path:
                folded = sha(a + folded + b)
            out.append((r["doc_id"], leaf, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return out


def table(sizes, seed=3):
    rnd = random.Random(seed)
    rows = []
    for source, size in sizes:
        for _ in range(size):
            text = rnd.choice(["", None, "Ab C", "abc", "É x\x00", "Zz " * 40])
            rows.append({"text": text, "doc_id": rnd.choice([None, rnd.randrange(10**6)]) if rnd.random() < 0.1 else rnd.randrange(-5, 10**6), "source": source,
                         "lang": rnd.choice([None, "en", ""]), "n_chars": rnd.choice([None, 3]), "leaf": "clash", "root": 1})
    return rows


key = lambda r: tuple((v is not None, v) for v in r)


@pytest.mark.parametrize(
    "sizes",
    [[("one", 1)], [(None, 1), ("", 1)], [("a", 16), ("b", 17), (None, 2)], [("hot", 4700), ("é", 257), ("z", 256)], [(f"s{i}", i % 3 + 1) for i in range(40)]],
)
def test_manifest(spark, sizes):
    rows = table(sizes)
    rows += rows[:3]  # repeated rows
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, merkle.manifest(df).collect()), key=key) == sorted(brute(rows), key=key)


def test_very_long_text(spark):
    rows = [{"text": "Word " * 1_000_000, "doc_id": i, "source": "s", "lang": "en", "n_chars": 1, "leaf": "", "root": 0} for i in range(3)]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    assert sorted(map(tuple, merkle.manifest(df).collect())) == sorted(brute(rows))


def test_one_row_of_a_high_node_for_each_cell(spark):
    size = merkle.CELL * 20 + 1
    leaves = spark.range(size).select(F.lit(0).cast("long").alias("g"), F.col("id").alias("n"), F.lit(size).cast("long").alias("size"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    parents, top = merkle.levels(leaves)
    groups = top.select("g", F.lit(0).cast("long").alias("r"), F.lit(size).cast("long").alias("size"), "height")
    nodes = merkle.node_rows(parents, parents.limit(0), groups)
    held = {r.level: r["count"] for r in nodes.groupBy("level").count().collect()}
    assert held == {1: merkle.CELL * 20 // 16 + 1, 2: 21, 3: 21, 4: 21}
    assert nodes.groupBy("g", "level", "cell").count().where("count > 1").count() == 0
