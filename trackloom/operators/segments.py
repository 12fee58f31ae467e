"""Bursts, runs, segments and fixed-length scenes of ordered streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, islands, prev, running_max, scan


def burst_instants(
    frames: DataFrame, keys: list[str], at: str, channel: str, channels: list[str], gap: int, span: int
) -> DataFrame:
    """Group the frames of several channels into capture instants.

    Merged stamps are split where two neighbours lie more than `gap` apart. One row per instant: its earliest
    stamp `at`, and one column per channel with that channel's stamp (its last one if it fired twice), null
    where the channel has no frame.
    """
    wanted = frames.where(F.col(channel).isin(channels)).select(*keys, at, channel)
    axis = Axis(tuple(keys), at, span, (channel,))
    runs = islands(wanted, axis, [at], lambda p, c: c(at) - p(at) > gap, "_burst")
    grouped = runs.groupBy(*keys, "_burst").agg(
        F.min(at).alias("_at"), *[F.max(F.when(F.col(channel) == c, F.col(at))).alias(c) for c in channels]
    )
    return grouped.select(*keys, F.col("_at").alias(at), *channels)


def complete_only(instants: DataFrame, channels: list[str]) -> DataFrame:
    """The instants at which no channel dropped its frame."""
    return instants.dropna(subset=channels)


def segments(
    frames: DataFrame, keys: list[str], at: str, valid: str, max_gap: Column | int, span: int, tie: tuple[str, ...] = ()
) -> DataFrame:
    """Unbroken runs of valid frames: an invalid frame or a step longer than `max_gap` starts a new one.

    Returns the valid frames with `segment` (dense, from 1, per key), `place` (1-based in the segment) and `size`
    (frames in the segment), all from one scan.
    """
    limit = max_gap if isinstance(max_gap, Column) else F.lit(max_gap)
    rows = frames.withColumn("_limit", limit)
    runs = islands(
        rows,
        Axis(tuple(keys), at, span, tie),
        [at, valid, "_limit"],
        lambda p, c: (p(valid) != c(valid)) | (c(at) - p(at) > c("_limit")),
        "segment",
        "place",
        "size",
        counted=lambda c: c(valid),
    )
    return runs.where(valid).select(*frames.columns, "segment", "place", "size")


def fixed_scenes(runs: DataFrame, size: Column | int) -> DataFrame:
    """Cut every segment into scenes of exactly `size` frames; adds `scene_no` (0-based), null for the remainder.

    Needs `place` and `size` (the segment's length) as `segments` gives them; no shuffle.
    """
    n = size if isinstance(size, Column) else F.lit(size)
    rows = runs.withColumn("_n", n.cast("long"))
    chunk, whole = F.expr("(place - 1) div _n"), F.expr("size div _n")
    return rows.select(*runs.columns, F.when(chunk < whole, chunk).alias("scene_no"))


def scene_stats(scenes: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Per key: number of scenes, frames in them and frames left over."""
    used = F.col("scene_no").isNotNull()
    return scenes.groupBy(*keys).agg(
        F.expr(f"count_if(scene_no is not null) div {size}").alias("n_scenes"),
        F.count_if(used).alias("frames_in_scenes"),
        F.count_if(~used).alias("frames_unused"),
    )


def runlength(
    rows: DataFrame, keys: list[str], at: str, value: str, span: int, max_gap: int | None = None, tie: tuple[str, ...] = ()
) -> DataFrame:
    """Maximal runs of equal `value`: start, end, count. A step above `max_gap` also ends a run."""

    def starts(p, c):
        change = ~p(value).eqNullSafe(c(value))
        return change if max_gap is None else change | (c(at) - p(at) > max_gap)

    runs = islands(rows.select(*keys, at, value, *tie), Axis(tuple(keys), at, span, tie), [at, value], starts, "run")
    return runs.groupBy(*keys, "run").agg(
        F.any_value(value).alias(value),
        F.min(at).alias("start_at"),
        F.max(at).alias("end_at"),
        F.count(F.lit(1)).alias("n"),
    )


def timeline(
    rows: DataFrame, keys: list[str], at: str, value: str, step: int, max_gap: int, span: int, gap_name: str
) -> DataFrame:
    """Run-length timeline with the gaps as runs of their own: key, start, end, value.

    A run lasts until one `step` after its last row; a step above `max_gap` becomes a run named `gap_name`.
    """
    runs = runlength(rows, keys, at, value, span, max_gap)
    body = runs.select(*keys, F.col("start_at"), (F.col("end_at") + step).alias("end_at"), value)
    stepped = scan(rows.select(*keys, at), Axis(tuple(keys), at, span), {"_prev": prev(at)})
    gaps = stepped.where(F.col(at) - F.col("_prev") > max_gap).select(
        *keys, (F.col("_prev") + step).alias("start_at"), F.col(at).alias("end_at"), F.lit(gap_name).alias(value)
    )
    return body.unionByName(gaps)


def status_runs(rows: DataFrame, keys: list[str], at: str, status: str, good, span: int, tie: tuple[str, ...] = ()):
    """Maximal runs whose status is not `good`: start, end, rows, and the dominant status (smallest on a tie)."""
    flagged = rows.select(*keys, at, *tie, status, (F.col(status) != F.lit(good)).alias("_bad"))
    runs = islands(flagged, Axis(tuple(keys), at, span, tie), ["_bad"], lambda p, c: p("_bad") != c("_bad"), "_run")
    per_value = (
        runs.where("_bad")
        .groupBy(*keys, "_run", status)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_a"), F.max(at).alias("_b"))
    )
    return per_value.groupBy(*keys, "_run").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col(status).alias("s")))["s"].alias("dominant"),
        F.min("_a").alias("start_at"),
        F.max("_b").alias("end_at"),
        F.sum("_n").alias("n"),
    ).drop("_run")


def merge_intervals(spans: DataFrame, keys: list[str], start: str, end: str, slack: int, span: int) -> DataFrame:
    """Join intervals that overlap or lie at most `slack` apart: merged start, end, count."""
    axis = Axis(tuple(keys), start, span, (end,))
    # the furthest end seen before a row, from the running maximum of the ends up to the previous row
    reach = scan(spans.select(*keys, start, end), axis, {"_upto": running_max(end)})
    runs = islands(reach, axis, [start, "_upto"], lambda p, c: c(start) > p("_upto") + slack, "_run")
    return runs.groupBy(*keys, "_run").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n_merged")
    ).drop("_run")
