"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UNSET = ""
#: shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "trackloom") -> SparkSession:
    """A session for tests and the bench; on a cluster pass your own session to the operators instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share for lineage cuts: `spark.checkpoint.dir`.

    Only a local master may go without it; a scratch folder is then made and remembered in the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", _UNSET)
    if path:
        return path
    path = spark.conf.get("spark.trackloom.scratch", _UNSET)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="trackloom-")
    spark.conf.set("spark.trackloom.scratch", path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later steps start from files, not from lineage.

    Used where a result feeds several branches or a loop, so nothing upstream is computed twice and a lost
    executor costs no more than re-reading a file. The shuffle files of the write are deleted when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trackloom/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that `stage` wrote and no later step reads."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    spark = df.sparkSession
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
