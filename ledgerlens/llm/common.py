"""Helpers shared by the operators: words, durable lineage cuts, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.session import checkpoint_dir

# The characters that separate words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package's modules along with the Python tasks of the session,
    so that executors need no installation of their own."""
    if getattr(spark, "_ledgerlens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "ledgerlens.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.addArtifacts(str(archive), pyfile=True)
    spark._ledgerlens_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The array of words of a text that is not null."""
    return F.array_remove(F.split(text, SPACES), "")


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Where none is set a local session
    takes a folder of its own; on a cluster, whose executors could not read
    that, this raises."""
    if checkpoint_dir(spark) is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return checkpoint_dir(spark)


def durable(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder: its lineage ends there, so a
    lost executor costs one read, not a recomputation."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def write_table(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, and its path."""
    path = f"{_shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of ``write_table``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def durable_table(df: DataFrame) -> DataFrame:
    """As ``durable``, written as a Parquet table, which is a fraction of a
    checkpoint's size.  The table stays in the shared folder, as other files
    of the job there do, until the folder is cleared or the block of
    ``dropping`` ends in which it was made."""
    table, path = write_table(df)
    if _made.get() is not None:
        _made.get().append(path)
    return table


@contextmanager
def dropping(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that operators write in this block when it ends; what
    is needed of them must have been written elsewhere by then."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for path in made:
            drop_table(spark, path)


def small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as
    it is (a shuffle join, which AQE splits on hot keys).  ``df`` should be
    durable, or it is computed twice.  Meant for narrow rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, value: str | None = None) -> DataFrame:
    """``df`` (written already) with each row's number from 0 within ``group``, in
    the order of ``order``; with ``value`` the sum of that column over the rows
    before it instead.  Groups must not be null, and ``order`` should leave no
    ties.  Rows are ranged over partitions once; a partition's total of a group
    and the totals before it place the rows without a window over a whole group."""
    ranged = df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id())
    ranged = durable_table(ranged)
    each = F.lit(1).cast("long") if value is None else F.col(value)
    held = ranged.groupBy(*group, "part").agg(F.sum(each).alias("held"))
    # at most one row per partition in each window
    before = F.sum("held").over(W.partitionBy(*group).orderBy("part")) - F.col("held")
    held = durable_table(held.select(*group, "part", before.alias("before")))
    within = F.sum(each).over(W.partitionBy(*group, "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - each
    placed = ranged.withColumn("within", within).join(small(held), [*group, "part"])
    return placed.withColumn(out, F.col("before") + F.col("within")).drop("part", "within", "before")
