"""Session helpers: a tuned local/test session and the shared scratch folder.

On a cluster the session is created by the platform; the library only *reads*
its settings. ``shared_path`` resolves scratch locations under the folder named
by ``spark.checkpoint.dir`` so that every round trip (sink then source,
stream checkpoints, saved models) lives on storage all executors can reach.
A private temporary folder is chosen only when that setting is missing, which
is the case for local test sessions.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins and
# coalesces/splits shuffle partitions from runtime statistics, and splits
# skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "millrace", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests (UI off, AQE on)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_base(spark: SparkSession) -> str:
    base = None
    try:
        base = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        base = None
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # A private temporary folder is only valid when driver and executors
        # share one machine; a cluster must name a shared folder.
        master = ""
        try:
            master = spark.sparkContext.master
        except Exception:  # Spark Connect
            master = spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:
            spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_RUN = uuid.uuid4().hex


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique location below the shared checkpoint folder. What a query
    writes there is read by the frame that it returns; ``release`` deletes it."""
    return f"{_checkpoint_base(spark)}/millrace/{_RUN}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all that this process has written below the shared folder. Frames
    that still read from there fail afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_checkpoint_base(spark)}/millrace/{_RUN}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
