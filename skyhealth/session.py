"""Session construction and lineage helpers.

Everything here is plain SparkSession configuration. The engine relies on
Catalyst + AQE for physical planning; the settings below only size shuffles
and keep the UI (an HTTP server) off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner can prove small (parquet stats); the
    # explicit broadcasts in this package are all on bounded dimensions.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    # AQE sizes post-shuffle partitions from runtime statistics: start from a
    # high partition count (below) and let small shuffles — most of ours are
    # post-partial-aggregation — coalesce to ~advisory-size partitions.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

# Initial shuffle partitions on a cluster. AQE coalesces them downwards but can
# split only those of joins, so a shuffle of S bytes wants S / 256 MB of them: a
# raw shuffle of 100 TB wants 400,000, set by SKYHEALTH_SHUFFLE_PARTITIONS. The
# default suits shuffles of up to 2 TB, which the daily aggregates stay under.
CLUSTER_SHUFFLE_PARTITIONS = 8000


def get_spark(master: str | None = None, app: str = "skyhealth",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only when no master is
    configured by the launcher (spark-submit sets it on a cluster).
    """
    builder = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER"):
        cpus = os.environ.get("BENCH_CPUS", "*")
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor; size its heap.
        conf["spark.driver.memory"] = os.environ.get("SKYHEALTH_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not (master and master.startswith("local")):
        conf["spark.sql.shuffle.partitions"] = os.environ.get(
            "SKYHEALTH_SHUFFLE_PARTITIONS", str(CLUSTER_SHUFFLE_PARTITIONS))
        # On a cluster coalesce to the advisory size rather than to maximum
        # parallelism (thousands of tiny post-aggregation tasks otherwise).
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared filesystem path. Only when
    it is unset (local tests) do we create a scratch folder and register it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="skyhealth-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and truncates long
    plans such as iterative merges.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for staged writes."""
    base = checkpoint_dir(spark)
    if "://" not in base:
        os.makedirs(base, exist_ok=True)
    return base.rstrip("/") + "/" + name
