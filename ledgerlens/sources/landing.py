"""Landing TRANSACTION and ACCOUNT for both reports.

The rows of each account are counted first, from the key column alone and
combined in every task.  From these counts follows the layout: how many buckets
keep each near ``BUCKET_BYTES``, and from how many rows on an account is spread
over several salts.  Then the source is read, once, and its rows move, once, to
their bucket: one task and one file a bucket, keyed by (ACCOUNT_ID,
ACCOUNT_SALT).  ACCOUNT is laid out the same way, its rows repeated once for
each salt of a hot account, so the per-account aggregate and the join of both
reports find their rows in one bucket and shuffle the fact table no more, and
one account with most of the rows is many buckets.

Counting before reading is no snapshot: rows that a source gains in between
only make buckets less even, never a result wrong.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import broadcast_if_bounded, hot_keys
from ledgerlens.session import MAX_SHUFFLE_BLOCKS, concurrently
from ledgerlens.sources import tables as T

KEY, SALT = "ACCOUNT_ID", "ACCOUNT_SALT"
LANDED_KEYS = (KEY, SALT)
SUFFIXES = ("_transaction", "_account", "_account_rows")
BUCKET_BYTES = 512 * 1024 * 1024
LEAST_BYTES = 2 * 1024 * 1024
WIDTHS = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8, "date": 4, "timestamp": 8, "decimal": 16}
PIECES = 32  # an account over this part of a bucket's rows is salted, so that the hashed salts fill buckets evenly


@dataclass(frozen=True)
class Layout:
    buckets: int
    rows_per_salt: int


def layout(rows: int, width: int, *, bucket_bytes: int = BUCKET_BYTES, max_buckets: int = 100_000, cores: int = 1) -> Layout:
    """Buckets of about ``bucket_bytes`` each for ``rows`` rows of ``width`` bytes,
    and as many as cores where each still has ``LEAST_BYTES``.

    Beyond ``max_buckets``, or where map tasks times buckets would pass
    ``MAX_SHUFFLE_BLOCKS``, buckets grow instead (100 TiB: about 5,000 of 20 GiB).
    No account keeps more than a ``PIECES``-th of a bucket's rows under one salt.
    """
    size = rows * width
    wanted = max(1, -(-size // bucket_bytes))
    buckets = min(max(wanted, min(cores, -(-size // LEAST_BYTES))), max_buckets, max(1, MAX_SHUFFLE_BLOCKS // wanted))
    return Layout(max(1, buckets), max(1, -(-rows // (max(1, buckets) * PIECES))))


def declared_width(df: DataFrame) -> int:
    """About how many bytes a row takes, by its columns' types."""
    return 8 + sum(WIDTHS.get(f.dataType.typeName(), 24) for f in df.schema.fields)


def _bucketed(df: DataFrame, name: str, buckets: int, fmt: str) -> DataFrame:
    # repartition and bucketBy hash alike, so each task writes one bucket's file
    T.write_table(df.repartition(buckets, *LANDED_KEYS), name, fmt=fmt, bucket_by=(buckets, list(LANDED_KEYS)))
    return T.read_table(df.sparkSession, name)


def plan_layout(transaction: DataFrame, name: str, *, bucket_bytes: int = BUCKET_BYTES, fmt: str = "parquet") -> tuple[Layout, DataFrame]:
    """The layout for ``transaction``, and its hot accounts with their salts.

    Counts per account are written to table ``name`` (one row per account) and
    read twice from there: for the rows in all, and for the hot ones."""
    spark = transaction.sparkSession
    T.write_table(transaction.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows")), name, fmt=fmt)
    counts = T.read_table(spark, name)
    rows = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    limit = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = layout(rows, declared_width(transaction), bucket_bytes=bucket_bytes, max_buckets=limit, cores=cores)
    return plan, hot_keys(counts, [KEY], plan.rows_per_salt)


def spread(transaction: DataFrame, salts: DataFrame) -> DataFrame:
    """``transaction`` with ACCOUNT_SALT, from a row's position in its file split:
    rows equal in every column spread, and a retried task gives the same salts
    if it reads its rows in the same order, as from files; for other sources the
    session needs ``session.RETRY_CONF``.
    Rows without an account meet nothing and go round all buckets."""
    many = F.coalesce("_salts", F.lit(1))
    salt = F.pmod("_place", F.when(F.col(KEY).isNull(), F.lit(1 << 20)).otherwise(many).cast("bigint")).cast("int")
    joined = transaction.withColumn("_place", F.monotonically_increasing_id()).join(salts, KEY, "left")
    return joined.select(*(F.col(f"`{c}`") for c in transaction.columns), salt.alias(SALT))


def copies(account: DataFrame, salts: DataFrame) -> DataFrame:
    """``account`` with ACCOUNT_SALT, each row once for every salt of its account."""
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    return account.join(salts, KEY, "left").select(*(F.col(f"`{c}`") for c in account.columns), each.alias(SALT))


def land(
    transaction: DataFrame,
    account: DataFrame,
    prefix: str,
    *,
    bucket_bytes: int = BUCKET_BYTES,
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame, Layout]:
    """Both sources laid out as bucketed tables, named ``prefix`` plus one of
    ``SUFFIXES``.  Metrics that the frames observe come with these writes."""
    spark = transaction.sparkSession
    names = [f"{prefix}{s}" for s in SUFFIXES]
    plan, salts = plan_layout(transaction, names[2], bucket_bytes=bucket_bytes, fmt=fmt)
    salts = broadcast_if_bounded(salts)
    transaction, account = concurrently(
        spark,
        lambda: _bucketed(spread(transaction, salts), names[0], plan.buckets, fmt),
        lambda: _bucketed(copies(account, salts), names[1], plan.buckets, fmt),
    )
    return transaction, account, plan
