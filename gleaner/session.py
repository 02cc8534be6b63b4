"""Session settings the library relies on, kept in one place."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

#: Settings that change results or plans.  Cluster sizing (executors, memory, shuffle partitions) stays with the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is worth splitting even when an extra exchange follows it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Only settable when the session is built: checkpoints no longer referenced are deleted.
BUILD_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app_name: str = "gleaner", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; `extra` uses `__` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **BUILD_SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the same runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables, from `spark.checkpoint.dir`.

    Only a local session may do without: it gets a temporary folder.  On a cluster the executors would not see it.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def folders(spark: SparkSession, path: str, prefix: str = "batch=") -> list[int]:
    """Numbers of the subfolders `prefix`N of a folder, in order; none if it is not there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def drop_folder(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
