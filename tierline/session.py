"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

# A file stream lists the files of each micro-batch by a job of a task per file,
# up to 10,000 by default; starting the tasks then takes longer than the listing.
LISTING_TASKS = 100
_LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_DEFAULT = 10_000

# Settings every tierline job expects. Timestamps are interpreted in UTC, ANSI
# mode stays on (Spark 4 default) so that real faults surface, and adaptive
# execution re-plans joins, coalesces small shuffle partitions and splits
# skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete reliable-checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state (incremental gold) in RocksDB: off the JVM heap, so
    # millions of keys do not pressure executors; changelog checkpointing
    # uploads only the changes of each micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    _LISTING_SETTING: str(LISTING_TASKS),
}


def build_session(
    master: str | None = None,
    app_name: str = "tierline",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with tierline's defaults.

    ``master`` is left to spark-submit when None, so a cluster deployment is
    never overridden from code.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (runtime setting)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def file_stream(spark: SparkSession) -> DataStreamReader:
    """A reader for streams of files, whose listing takes ``LISTING_TASKS`` tasks
    at most (runtime setting; a number that the session chose itself stays)."""
    if int(spark.conf.get(_LISTING_SETTING)) == _LISTING_DEFAULT:
        spark.conf.set(_LISTING_SETTING, str(LISTING_TASKS))
    return spark.readStream


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    distributed file system every executor can reach). Only when the session
    has none and runs on a ``local`` master, as in tests, a temporary folder
    is created and registered as the session's checkpoint directory; on a
    cluster that would be each machine's own disk, so it is refused there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        if context is None or not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tierline-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions raise on access
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under :func:`scratch_root`."""
    return f"{scratch_root(spark)}/tierline/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once: written under :func:`scratch_root` and read back.

    Cuts the lineage like a reliable checkpoint, but computes the rows a single
    time (an eager checkpoint counts them first) and keeps them in columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
