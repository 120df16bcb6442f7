"""Join helpers: broadcast only behind a size check.

Spark already broadcasts a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans with runtime
sizes; these helpers add an explicit, counted bound for hints a caller asks
for, and fall back to the shuffle join Spark would pick anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir

DEFAULT_MAX_BROADCAST_ROWS = 100_000
DEFAULT_MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def counted_size(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about how many bytes they take in memory: one
    aggregate, combined in every task, so one row per task is shuffled."""
    width = F.lit(8)
    for f in df.schema.fields:
        plain = f.dataType.typeName() in ("string", "binary")
        if plain:
            width = width + F.lit(16) + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            width = width + F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            width = width + F.lit(16)
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, size


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, so that counting it and each use
    in a plan read what one job wrote; as it is where the session names none."""
    return df if checkpoint_dir(df.sparkSession) is None else df.checkpoint()


def size_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes."""
    rows, size = counted_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_bounded(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when its rows and bytes are counted to be small, else ``df`` as is."""
    return F.broadcast(df) if size_at_most(df, max_rows, max_bytes) else df


# ---- hot keys ---------------------------------------------------------------
#
# AQE's skew join already splits an oversized shuffle partition at run time
# (``spark.sql.adaptive.skewJoin.enabled``) and stays the default.
# ``salted_join`` is the explicit form for a row-level join whose fact side has
# keys with very many rows.

ROWS_PER_SALT = 1_000_000


def key_salts(fact: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """The keys of ``fact`` with more than ``rows_per_salt`` rows, each with its
    own number of salts: ``_salts`` = rows / ``rows_per_salt``, rounded up.

    Counts are exact, from the key columns alone, combined map-side.  There
    can be at most ``rows(fact) / rows_per_salt`` such keys.
    """
    return hot_keys(fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), keys, rows_per_salt)


def hot_keys(counts: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``key_salts`` of rows that are counted already (``_rows``)."""
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    salts = F.ceil(F.col("_rows") / rows_per_salt).cast("int")
    return counts.where(valid & (F.col("_rows") > rows_per_salt)).select(*keys, salts.alias("_salts"))


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    *,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Inner equi-join ``fact ⋈ dim`` on ``keys`` with every hot key salted.

    A key with more than ``rows_per_salt`` fact rows is spread over as many
    salts as it has multiples of that; its dimension rows are replicated once
    per salt, so all replicas together are at most ``rows / rows_per_salt`` plus
    one per hot key and dimension row.  All other rows carry salt 0.  There is
    no other threshold, no limit on the number of hot keys or salts and no
    fallback: the plan is the same whatever the sizes.

    A fact row's salt comes from its position in its partition, so rows equal
    in every column spread as well.  Positions repeat when a task is retried
    as long as the partition's order does: true for files and tables; cut a
    fact side that comes out of a shuffle with ``checkpoint()`` or a written
    table first.
    """
    salts = broadcast_if_bounded(computed_once(key_salts(fact, keys, rows_per_salt)))
    none = F.coalesce("_salts", F.lit(1))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    spread = fact.withColumn("_place", place).join(salts, keys, "left")
    spread = spread.withColumn("_salt", F.pmod(F.col("_place"), none.cast("bigint")).cast("int")).drop("_place", "_salts")
    copies = dim.join(salts, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), none - 1))).drop("_salts")
    return spread.join(copies, [*keys, "_salt"]).drop("_salt")
