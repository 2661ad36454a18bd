"""Session helpers: a local session for tests, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", partitions: int = 8, app: str = "pairloom") -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # joins on blocks cost far more than their bytes say: keep small shuffles on all cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a folder of its own; anywhere else a missing
    setting is an error, since a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="pairloom-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_root(spark: SparkSession) -> str:
    """The part of the shared folder that holds this application's staged tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/staged/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged table inside the shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def staged(df, name: str):
    """Write a table that several later steps read, and read it back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all staged tables of this application, once its results are written elsewhere."""
    discard(spark, scratch_root(spark))
