"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "wattframe", **extra: str) -> SparkSession:
    """A session with the settings every job here expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


UNSET_PARTITIONS = 200  # Spark's own default for spark.sql.shuffle.partitions
SHUFFLE_BYTES = 256 * 1024 * 1024
MOST_PARTITIONS = 32_768  # beyond this, blocks per map task grow too many and small


def fit_shuffles(df: DataFrame) -> None:
    """Raises the number of shuffle partitions for jobs over ``df`` to suit its size.

    Adaptive execution merges partitions that turn out small but cannot split a
    shuffle that began with too few, so large inputs need more than the default,
    and larger scan and output pieces to keep the number of blocks and files low.
    Sessions whose settings already suffice stay as they are.
    """
    conf = df.sparkSession.conf
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(-(-size // SHUFFLE_BYTES), MOST_PARTITIONS)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if wanted > int(conf.get(key, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(key, str(wanted))
        conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_BYTES))
        if wanted == MOST_PARTITIONS:
            conf.set("spark.sql.files.maxPartitionBytes", str(2 * SHUFFLE_BYTES))


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session fit for stateful streams; the caller's settings stay as they are.

    Watermarks need zoned timestamps, so the zone must be UTC for readings to
    come back unchanged.  The number of state partitions is fixed when a stream
    first starts and is never merged at run time, so unless the session chose
    one it follows the cores at hand.
    """
    child = spark.newSession()
    for key, value in SETTINGS.items():
        child.conf.set(key, value)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions == UNSET_PARTITIONS:
        partitions = spark.sparkContext.defaultParallelism
    child.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return child


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back on a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="wattframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base.rstrip("/"), f"run-{uuid.uuid4().hex}")
