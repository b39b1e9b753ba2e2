"""SparkSession construction with the settings the operators assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every armlens job relies on. AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Added when the master comes from spark-submit (a cluster): start shuffles
# wide and let AQE coalesce them to ~256 MB partitions, so a 100 TB shuffle
# does not run with a handful of huge partitions.
#
# Broadcasts on a cluster happen only for proven sizes: the library's explicit,
# bounded broadcasts (plans/sizing.py) and AQE's runtime conversion, which
# uses the measured size of a finished stage. The static planner's
# estimate-based broadcast (file sizes, underestimated after explode) is off.
CLUSTER_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "4096",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, app: str = "armlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide (``CLUSTER_CONF`` applies); locally ``local[N]``
    (tiny inputs: Spark's default estimate-based broadcast stays on)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("ARMLENS_DRIVER_MEMORY", "16g")
    elif not master:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is respected as is.
    Only when it is unset (local tests) a scratch folder is created."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # Local runs only: a cluster names a shared folder in spark.checkpoint.dir.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="armlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
