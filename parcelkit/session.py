"""Session construction and the shared scratch location.

Every job that must write intermediate files (landed CSV pages, JSON
sinks, external tables) writes under the folder named by
``spark.checkpoint.dir``.  On a cluster that setting points at shared
storage; it is only filled in here when it is unset *and* the master is
local (tests, single-node benchmarks).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that shape every plan in this package.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (hundreds of TB, ~1000 executors).  AQE merges
# small shuffle partitions up to ~256 MB but does not split those of a plain
# aggregate or window, so their number must fit the input: see
# ``shuffle_partitions_for``.  Skewed join partitions (> 5x median and
# > 512 MB) are split; scans read 256 MB splits.  Broadcast hints are only on
# sides whose row count is fixed by arguments; all others are left to Spark's
# own size check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def shuffle_partitions_for(input_bytes: float, per_partition: int = 256 << 20, least: int = 200) -> int:
    """Shuffle partitions for a job whose largest shuffle is about its input."""
    return max(least, int(-(-input_bytes // per_partition)))


def cluster_conf(extra: dict | None = None, input_bytes: float | None = None) -> dict:
    """Settings to pass at submit time for a cluster run; with ``input_bytes`` the
    number of shuffle partitions follows the input (100 TB: about 400,000)."""
    conf = dict(BASE_CONF)
    conf.update(CLUSTER_CONF)
    if input_bytes is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    conf.update(extra or {})
    return conf


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parcelkit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext)
        master = spark.conf.get("spark.master", "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns checkpointing)
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return (sc.getCheckpointDir() if sc else None) or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder there")
    local = tempfile.mkdtemp(prefix="parcelkit-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir()
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: later uses neither recompute it nor depend on
    the executors that made it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt evenly, whatever their keys, over ``spark.sql.shuffle.partitions`` tasks.  For work per
    row that takes far longer than reading it (parsing and testing geometry): a scan has tasks by its files' bytes and
    row groups, one or a few for a million short rows.  The number is given, so AQE does not merge them again."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
