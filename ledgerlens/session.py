"""Session helpers: build a tuned SparkSession and locate the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in the package relies on. AQE re-plans joins from measured sizes
# (size-checked broadcast), coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints of ranked results go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "ledgerlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None so spark-submit decides; ``spark.checkpoint.dir``
    must then be set by the cluster to a shared folder.
    """
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
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir). Only when
    neither is set and the master is local (tests) a private folder under the temp dir is
    created and registered; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            # a driver-local folder would scatter written tables over executor disks
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) on a cluster")
        current = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def folder_of(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the maker of its path objects."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem so it works on any shared store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))
