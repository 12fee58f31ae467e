"""The interval in which every required stream has data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_extents(frames: DataFrame, keys: list[str], at: str, channel: str) -> DataFrame:
    """First and last stamp per stream."""
    return frames.groupBy(*keys, channel).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def coverage_window(
    frames: DataFrame, keys: list[str], at: str, channel: str, streams: list[str], margin: int
) -> DataFrame:
    """One row per key: start and end of the common interval shrunk by `margin`, the overall extent, what is cut at
    either end, and which stream starts last and which ends first (on a tie the earlier one of `streams`).

    Streams without frames are left out; a key without any frame has no row.
    """
    rank = F.create_map(*[x for i, s in enumerate(streams) for x in (F.lit(s), F.lit(i))])
    ext = stream_extents(frames.where(F.col(channel).isin(streams)), keys, at, channel)
    ext = ext.withColumn("_r", rank[F.col(channel)])
    out = ext.groupBy(*keys).agg(
        F.max("first_at").alias("_start"),
        F.min("last_at").alias("_end"),
        F.min("first_at").alias("earliest"),
        F.max("last_at").alias("latest"),
        F.min_by(channel, F.struct((-F.col("first_at")).alias("f"), "_r")).alias("last_start"),
        F.min_by(channel, F.struct("last_at", "_r")).alias("first_end"),
    )
    start, end = F.col("_start") + margin, F.col("_end") - margin
    return out.select(
        *keys, start.alias("start_at"), end.alias("end_at"), "earliest", "latest", "last_start", "first_end",
        (start - F.col("earliest")).alias("head_cut"), (F.col("latest") - end).alias("tail_cut"),
    )
