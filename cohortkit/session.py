"""Session helpers: a local session for tests / bench, and the shared folder.

On a cluster the session comes from ``spark-submit``; the library only reads
``spark.checkpoint.dir`` from it.  A folder is set here only when a local
session has none, never over an existing setting.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cohortkit", driver_memory: str = "8g",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session.  Its shared folder is fixed before the session starts:
    ``checkpoint_dir`` if given, else a fresh temporary folder (one machine,
    so driver and executor threads see it)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="cohortkit-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and written tables.

    Read from ``spark.checkpoint.dir`` or from the context's checkpoint
    folder; never set over either.  A ``local[...]`` session that has neither
    (a test on one machine) gets a temporary folder through
    ``setCheckpointDir``; any other session is refused with an error, since a
    machine-local folder would not reach the other executors.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortkit-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared folder (unique per call)."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, "cohortkit", *parts, uuid.uuid4().hex])


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
