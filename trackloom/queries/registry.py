"""Registry of queries and helpers to read the tables they run on."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.clock import as_micros
from trackloom.operators.ordered import fit_span

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR = 3_600_000_000
DAY = 24 * HOUR


def query(sql: str | None = None):
    """Register a function under its name; `sql` is its DuckDB twin."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = re.sub(r'(?<![\w"])at(?![\w"])', '"at"', sql)  # a reserved word in DuckDB
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # the tables hold wall-clock times without a zone; they are read as UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sensor frames: user = recording, event_type = channel, `at` in microseconds."""
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", "props", as_micros("ts").alias("at")
    )


def fitted(df: DataFrame, *keys: str) -> int:
    """Block width for scans of `df` (at: microseconds) per `keys`: its whole time, halved until the fullest block is small."""
    first, last = df.agg(F.min("at"), F.max("at")).first()
    span = DAY
    while first is not None and span < last - first:
        span *= 2
    return fit_span(df, list(keys), "at", span)


@cache
def _width(application: str, sf: str, keys: tuple[str, ...]) -> int:
    return fitted(events(SparkSession.active(), sf), *keys)


def width(spark: SparkSession, sf: str, *keys: str) -> int:
    """Block width for scans of the event table per `keys`: measured once, from the table's whole time halved until the
    fullest block is small. Keys of few rows stay in one block; blocks of a few rows each cost a summary as long as the table."""
    return _width(spark.sparkContext.applicationId, sf, keys)


def r6(c: Column | str) -> Column:
    return F.round(c, 6)
