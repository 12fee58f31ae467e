"""Recordings and dataset versions found in file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.text import recording_parts, route_key, version_index


def recordings(spark: SparkSession, root: str, suffix: str = ".bag") -> DataFrame:
    """(path, name, course, number, started, route) of every recording below `root`; sort by `route` for route order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), rf"\{suffix}$", "")
    f = files.select("path", F.col("length").alias("bytes"), name.alias("name")).dropDuplicates(["path"])
    part = recording_parts(F.col("name"))
    return f.select("path", "bytes", "name", part["course"].alias("course"), part["number"].alias("number"), part["started"].alias("started"),
                    route_key(F.col("name")).alias("route"))


def companions(recs: DataFrame, others: DataFrame, within_s: int = 5) -> DataFrame:
    """Side files that belong to a recording: same course and number, started at most `within_s` seconds apart.

    `others`: path, course, number, started."""
    o = others.select("course", "number", F.col("path").alias("companion"), F.col("started").alias("_o"))
    j = recs.join(o, ["course", "number"])
    apart = F.abs(F.unix_micros("_o") - F.unix_micros("started"))
    return j.where(apart <= within_s * 1_000_000).drop("_o")


def dataset_versions(paths: DataFrame, base: str) -> DataFrame:
    """(path, version) of the folders of a dataset family, `base`, `base_2`, ..., in numeric order."""
    v = paths.select("path", version_index(F.col("path"), base).alias("version"))
    return v.where("version is not null").orderBy("version")
