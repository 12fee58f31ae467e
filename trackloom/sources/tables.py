"""The normalized tables: JSON array files in, versioned Parquet out, with an atomic switch and undo."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.schema import TABLES
from trackloom.sources import json_array

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def read_json_tables(spark: SparkSession, root: str) -> dict[str, DataFrame] | None:
    """The 13 tables from `<root>/<table>.json` (one JSON array each); a missing file is an empty table.

    None when there is no scene. Large files are read by ranges, by many tasks; land the tables with `commit` before heavy
    use, since every use of what is returned parses them again.
    """
    out = {}
    for name, schema in TABLES.items():
        path = f"{root}/{name}.json"
        if exists(spark, path):
            out[name] = json_array.read(spark, path, schema)
        else:
            out[name] = spark.createDataFrame([], schema)
    return None if out["scene"].isEmpty() else out


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed and abandoned version numbers under `root`, in order."""
    fs, p, _ = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version readers use, from the one-line pointer file."""
    path = f"{root}/{POINTER}"
    if not exists(spark, path):
        return None
    return int(spark.read.text(path).first()["value"])


def _point(spark: SparkSession, root: str, version: int) -> None:
    fs, _, jvm = _fs(spark, root)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    ctx = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    ctx.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), options)


def commit(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """Write all tables as a new version, then switch the pointer to it. A run that dies halfway leaves the old
    version in use; the tables may be derived from it, since files of a version never change."""
    known = versions(spark, root)
    version = (known[-1] if known else 0) + 1
    for name, df in tables.items():
        df.write.parquet(f"{root}/v={version}/{name}")
    _point(spark, root, version)
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame] | None:
    """The tables of the current (or a given) version."""
    v = current_version(spark, root) if version is None else version
    if v is None:
        return None
    return {n: spark.read.schema(s).parquet(f"{root}/v={v}/{n}") for n, s in TABLES.items() if exists(spark, f"{root}/v={v}/{n}")}


def undo(spark: SparkSession, root: str) -> int:
    """Point back at the version before the current one; nothing is deleted."""
    now = current_version(spark, root)
    older = [v for v in versions(spark, root) if now is not None and v < now]
    if not older:
        raise ValueError("no earlier version to go back to")
    _point(spark, root, older[-1])
    return older[-1]


def fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, checksum): equal for equal content in any order; the key under which derived results are kept.

    The checksum holds the exclusive or and the sum of the rows' hashes: repeated rows cancel in the one, not in the other.
    """
    out = None
    for name, df in sorted(tables.items()):
        row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
        both = F.concat_ws(":", F.coalesce(F.bit_xor(row), F.lit(0)), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)))
        one = df.agg(F.count(F.lit(1)).alias("rows"), both.alias("checksum")).select(F.lit(name).alias("table"), "rows", "checksum")
        out = one if out is None else out.unionByName(one)
    return out


def write_sidecars(messages: DataFrame, scene: str, topic: str, path: str) -> None:
    """One folder per scene and topic with the messages as JSON lines. Only the folders in `messages` are replaced, so
    a repeated run leaves the same files."""
    messages.write.partitionBy(scene, topic).mode("overwrite").option("partitionOverwriteMode", "dynamic").json(path)


def write_report(df: DataFrame, path: str, as_text: str | None = None) -> None:
    """A report as CSV with header, or one text column as plain lines."""
    if as_text:
        df.select(F.col(as_text).cast("string").alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)
