"""Session acquisition (S17) and the shared folder for lineage cuts.

Library functions never stop a session: the caller (or the driver) owns it.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Salts come from a row's place in its task.  A source that gives its rows in
# another order when a lost task runs again (a database, a shuffle) would send some
# rows twice and others never; with these, Spark sees that a map task's output
# changed and runs the whole reading stage again, or fails the job.
RETRY_CONF = {
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}

# Settings a reporting job wants on any cluster.  Skew join and partition
# coalescing are AQE's runtime answers to hot keys and tiny partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    **RETRY_CONF,
}


def get_spark_session(
    app_name: str = "ledgerlens",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with ``DEFAULT_CONF``.

    An active session is returned untouched (it may be shared, e.g. by a
    Spark Connect client), so its configuration stays the owner's.  The
    library never touches ``sparkContext`` except as an optional fallback.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session's configuration (works under Spark Connect too);
    callers set their own only where it is unset (tests do this with a
    scratch folder).  In a classic session the folder is also registered
    with the SparkContext so ``DataFrame.checkpoint()`` can use it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def concurrently(spark: SparkSession, *actions: Callable[[], T]) -> list[T]:
    """Run independent actions (writes, counts) at the same time and return their
    results in order: the tasks of one fill the cores that another leaves free.
    All have ended when this returns; the first error is raised then."""
    with ThreadPoolExecutor(max_workers=max(1, len(actions))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
        wait(running)
    return [r.result() for r in running]


# Map tasks times reducers: about how many shuffle blocks the driver keeps track of.
MAX_SHUFFLE_BLOCKS = 1_000_000_000


def scale_conf(
    input_bytes: int,
    total_cores: int,
    *,
    shuffle_bytes: int | None = None,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``total_cores``.

    Scan splits and reducers take about ``target_partition_bytes`` each (of the
    input, and of ``shuffle_bytes``, the largest shuffle projected; default: the
    input), with at least two waves of reducers per core.  Beyond a few TB the
    splits grow and the reducers are limited so that map tasks times reducers
    stay near ``MAX_SHUFFLE_BLOCKS``, which bounds what the driver holds of map
    statuses; reducers then spill, and AQE still coalesces small shuffles
    (per-account partials, per-branch totals) to the advisory size.  A partition
    counts as skewed past four times the median and the target size.
    """
    mib = 1024 * 1024
    side = int(MAX_SHUFFLE_BLOCKS**0.5)
    split = max(target_partition_bytes, -(-input_bytes // side))
    split = -(-split // mib) * mib
    maps = max(1, -(-input_bytes // split))
    wanted = -(-(input_bytes if shuffle_bytes is None else shuffle_bytes) // target_partition_bytes)
    partitions = max(2 * total_cores, min(wanted, MAX_SHUFFLE_BLOCKS // maps))
    size = f"{target_partition_bytes // mib}m"
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": f"{split // mib}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        **RETRY_CONF,
    }
