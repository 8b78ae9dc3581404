"""Spark session helpers.

Cluster settings (shuffle partitions, broadcast threshold, checkpoint dir) come
from the session the caller already has; the helpers here only fill in values
that are unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults used only when the session does not say otherwise.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Suggested settings for large clusters (applied by whoever builds the session; the
# library never overrides a session it is given). Partitions of ~256 MB keep tasks
# well inside executor memory; AQE coalesces small shuffles and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.gridpanel.broadcastMaxBytes": str(256 * 1024 * 1024),
    # checkpointed panels/covers are per run: remove their files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "gridpanel") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.master(f"local[{n}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
    b = b.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local_master(master: str) -> bool:
    """One JVM only: ``local``, ``local[4]``, ``local[*, 2]`` (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it the job stops here, because a machine-local folder would give
    every executor its own disk. Only ``local`` / ``local[...]`` masters (tests,
    bench) get a fresh scratch directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local_master(sc.master):
            raise RuntimeError(
                f"set spark.checkpoint.dir to a shared folder (master is {sc.master}); "
                "a machine-local folder is used in local mode only")
        conf_dir = tempfile.mkdtemp(prefix="gridpanel-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
