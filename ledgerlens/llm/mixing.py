"""Mixing sources to target weights by Sainte-Lague apportionment (operator 8, native).

The mix is made of equal blocks of ``BLOCK`` words.  A source's target is its
weight's share of ``SHARE`` times all words, at most ``REPEAT`` times its own
words, the excess reshared by weight until no target is above.  A target is so
many whole blocks and a rest, which is one last, partial block, so every source
is taken to the whole words of its target.  The blocks are seats, the targets
votes: seats go to the highest quotients target / (2k + 1), and a source whose
blocks are all given hands on what would be its next seat.  Sainte-Lague never
takes a seat back as seats are added, so the first seats make the first shard of
the mix, the next the second, and each shard has whole quotas of its own.
Partial blocks go round the shards by the source's place.

Without limits a source's quota after n seats differs from its exact share by
at most 1/2 + share * sources / 2, and a limit hands on at most one seat, so only
the quotients in that range are ranked: a few rows per source, however many
blocks there are.

The seed orders each source's documents at random (MD5 of seed, doc_id and
text).  Laid end to end in that order they form a ring of words, of which the
source's blocks, however many, take consecutive stretches: a document is taken
as often as the blocks go over it, whole but for the one where the last block
ends.  Each shard's quota owns the next stretch of the way round, so every word
taken belongs to one shard.  Positions in a ring are running sums over ranged
partitions of light rows (``numbered``), and the texts are joined to them by a
row number that was written with both: a source with a third of all rows, or a
third of all rows being equal, is spread over many tasks.

Defined results: null and wordless texts have size 0, are taken 0 times and
left out of the mixed corpus; a null source is a source, last in order; a source
takes nothing only where its target is under one word; repeated rows each have
their place in the ring, next to each other; a very long text is one document,
cut at a word where the last block ends in it; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.llm.common import durable, durable_table, numbered, small, text_of, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2
BLOCK = 64
SHARDS = 16
SEED = 17


def order_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """60 random bits of the document."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``sources`` (s, s_null, source_size) plus pos, weight and target.

    Sources are capped in the order of their cap per weight, so one pass over
    the sorted sources finds the level at which the rest share the remainder.
    The windows run over one row per source.
    """
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("pos") - 1) % len(WEIGHTS))
    df = sources.withColumn("pos", F.row_number().over(W.orderBy("s_null", "s"))).withColumn("weight", weight)
    df = df.withColumn("cap", repeat * F.col("source_size")).withColumn("reach", F.col("cap") / F.col("weight"))
    every = W.partitionBy()
    before = W.orderBy("reach", "pos").rowsBetween(W.unboundedPreceding, -1)
    rest = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    df = df.withColumn("level", rest / open_weight)
    level = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", "pos", "level"))).over(every)["level"]
    df = df.withColumn("chosen", F.coalesce(level, F.lit(0.0)))
    target = F.least(F.col("weight") * F.col("chosen"), F.col("cap").cast("double"))
    return df.select("s", "s_null", "source_size", "pos", "weight", target.alias("target"))


def quotas(voted: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """One row per source of ``targets`` with a whole block, and shard of the mix
    (shard from 1): ``upto``, the blocks the source has in this and all earlier
    shards."""
    every = W.partitionBy()
    df = voted.withColumn("limit", F.floor(F.col("target") / block)).where("limit > 0")
    df = df.withColumn("votes", F.sum("target").over(every)).withColumn("n", F.count(F.lit(1)).over(every)).withColumn("seats", F.sum("limit").over(every))
    df = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("shard"))
    df = df.withColumn("seats", F.expr(f"seats * shard div {shards}")).withColumn("portion", F.col("target") / F.col("votes"))
    exact, off = F.col("portion") * F.col("seats"), F.col("portion") * (F.col("n") / 2 + 1) + 1
    handed_on = F.col("portion") * F.col("n") + 1
    df = df.withColumn("low", F.least(F.greatest(F.floor(exact - off), F.lit(0).cast("long")), "limit"))
    df = df.withColumn("high", F.least(F.ceil(exact + off + handed_on), F.col("limit") - 1))
    df = df.withColumn("open", F.col("seats") - F.sum("low").over(W.partitionBy("shard")))
    seats = F.when(F.col("low") <= F.col("high"), F.sequence("low", "high")).otherwise(F.array().cast("array<bigint>"))
    ranked = df.select("*", F.explode_outer(seats).alias("k"))
    quotient = F.col("target") / (2 * F.col("k") + 1)
    rank = F.row_number().over(W.partitionBy("shard").orderBy(quotient.desc_nulls_last(), "pos"))
    ranked = ranked.withColumn("rank", rank)
    return ranked.groupBy("s", "s_null", "shard").agg((F.min("low") + F.count_if(F.col("k").isNotNull() & (F.col("rank") <= F.col("open")))).alias("upto"))


def mix(docs: DataFrame, carry: list[str] | None = None, block: int = BLOCK, seed: int = SEED, share: float = SHARE, repeat: int = REPEAT, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` of the columns ``carry``
    (default: all), size, source_size, target, whole (times the document is
    taken in full), part (words from its start that are taken once more) and
    shards, an array of (shard, words): how many of the words taken, in the
    order of the way round, go to which shard."""
    text = text_of("text")
    full = durable_table(
        docs.select(
            F.struct(*(docs.columns if carry is None else carry)).alias("row"),
            F.coalesce("source", F.lit("")).alias("s"),
            F.col("source").isNull().alias("s_null"),
            order_key(F.col("doc_id"), text, seed).alias("o"),
            F.size(words(text)).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    sources = durable(full.groupBy("s", "s_null").agg(F.sum("size").alias("source_size")))
    voted = durable(targets(sources, share, repeat))
    # as many as shards
    upto = quotas(voted, block, shards).groupBy("s", "s_null").agg(F.sort_array(F.collect_list(F.struct("shard", "upto"))).alias("each"))
    none = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: F.struct(j.alias("shard"), F.lit(0).cast("long").alias("upto")))
    plan = voted.join(upto, ["s", "s_null"], "left").withColumn("each", F.coalesce("each", none)).withColumn("taken", F.floor("target"))
    # the partial block's shard, and the words up to the end of each shard
    own = F.expr(f"(pos - 1) % {shards} + 1")
    rest = F.expr(f"taken % {block}")
    ends = F.transform("each", lambda x: F.struct(x["shard"].alias("shard"), (x["upto"] * block + F.when(x["shard"] >= own, rest).otherwise(0)).alias("end")))
    plan = plan.select(
        "s", "s_null", "source_size", "target",
        F.expr("coalesce(taken div nullif(source_size, 0), 0L)").alias("whole"),
        F.expr("coalesce(taken % nullif(source_size, 0), 0L)").alias("rest"),
        ends.alias("ends"),
    )
    plan = small(durable(plan))

    light = numbered(full.select("s", "s_null", "o", "size", "tie"), ["s_null", "s"], ["o", "tie"], "at", value="size")
    df = light.join(plan, ["s", "s_null"])
    at, zero = F.col("at"), F.lit(0).cast("long")
    part = F.greatest(zero, F.least(F.col("size"), F.col("rest") - at))
    # the words of the document on the first x words of the way round
    on = lambda x: F.coalesce(
        F.call_function("div", x, F.nullif("source_size", zero)) * F.col("size") + F.greatest(zero, F.least(F.col("size"), F.pmod(x, F.nullif("source_size", zero)) - at)), zero
    )
    owned = F.transform("ends", lambda e, i: F.struct(e["shard"].cast("int").alias("shard"), (on(e["end"]) - on(F.when(i > 0, F.get("ends", i - 1)["end"]).otherwise(zero))).alias("words")))
    owned = F.coalesce(F.filter(owned, lambda x: x["words"] > 0), F.array().cast("array<struct<shard:int,words:bigint>>"))
    df = df.select("tie", "source_size", "target", "whole", part.alias("part"), owned.alias("shards"))
    return full.select("row", "size", "tie").join(df, "tie").select("row", "size", "source_size", "target", "whole", "part", "shards")


def mixed_corpus(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each document as often as
    it is taken in full, and its first words where a last block ends in it."""
    planned = mix(docs, **settings)
    whole = F.array_repeat("row.text", F.col("whole").cast("int") + F.when(F.col("part") == F.col("size"), 1).otherwise(0))
    cut = F.array_join(F.slice(words(text_of("row.text")), 1, F.col("part").cast("int")), " ")
    texts = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), F.concat(whole, F.array(cut))).otherwise(whole)
    rows = planned.where("size > 0").select("row", F.explode(texts).alias("new"))
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
