"""Session settings the plans in this package count on."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Per-clip dimensions are joined without a broadcast hint:
# Spark broadcasts them only below its own measured size threshold, and beyond
# it adaptive execution splits the partitions of a hot clip.
TUNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in TUNED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, name: str = "motionweave", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every expression costs more than planning it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, else a fresh one in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="motionweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table that several later steps read, and go on from the written copy.

    Parquet in the shared folder survives lost executors and lets each reader take only
    the columns it needs. The copy is deleted when the session's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written: it does so for plans that nobody holds."""
    gc.collect()
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession) -> str:
    """A new path in a folder of its own in the shared one; the folder is deleted when the session's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/motionweave-{uuid.uuid4().hex}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)  # only what exists can be marked
    store.deleteOnExit(folder)
    return f"{folder.toString()}/data"
