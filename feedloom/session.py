"""Session settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later step has to shuffle again for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A batch of long texts is held several times over by a Python worker; 10,000 rows alone do not bound it.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

#: Folders of single-process sessions, by application.
_OWN: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a running session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Recording the call site of every column costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: `spark.checkpoint.dir`.

    Only a single-process session (tests, the benchmark) may leave it unset; it then gets one
    folder below the machine's temporary folder. On a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="feedloom-")
    return _OWN[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), "feedloom", f"{label}-{uuid.uuid4().hex}")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and go on from there.

    Cuts the lineage between steps that use their input several times; a lost executor
    reads the written table again instead of repeating everything before it.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path on the cluster's file system is a folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()
