"""Screening of recordings: every triggered rule with its level, and the worst level as the verdict."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators.coverage import coverage_window
from trackloom.operators.segments import status_runs
from trackloom.operators.stats import steps
from trackloom.session import stage

LEVELS = ("PASS", "MARGINAL", "DROP")


def verdicts(recordings: DataFrame, keys: list[str], findings: DataFrame) -> DataFrame:
    """(keys, verdict, reasons) from findings (keys, level 1 or 2, reason); recordings without findings pass."""
    worst = findings.groupBy(*keys).agg(
        F.max("level").alias("_level"), F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("reasons")
    )
    level = F.coalesce("_level", F.lit(0))
    return recordings.select(*keys).distinct().join(worst, keys, "left").select(
        *keys,
        F.when(level == 2, LEVELS[2]).when(level == 1, LEVELS[1]).otherwise(LEVELS[0]).alias("verdict"),
        F.coalesce("reasons", F.lit("")).alias("reasons"),
    )


def screening_verdicts(
    frames: DataFrame, keys: list[str], channel: str, at: str, required: list[str], span: int,
    drop_gap: dict[str, int], warn_gap: dict[str, int], few: int,
) -> DataFrame:
    """Verdict per recording: a required stream missing or with a gap above `drop_gap` drops it; a gap above
    `warn_gap` or fewer than `few` frames make it marginal."""
    counts = frames.where(F.col(channel).isin(required)).groupBy(*keys, channel).agg(F.count(F.lit(1)).alias("_n"))
    gaps = steps(frames.where(F.col(channel).isin(list({*drop_gap, *warn_gap}))), [*keys, channel], at, span)
    worst = gaps.groupBy(*keys, channel).agg(F.max("dt").alias("_gap"))
    wanted = frames.select(*keys).distinct().withColumn(channel, F.explode(F.array(*[F.lit(c) for c in required])))
    state = wanted.join(counts, [*keys, channel], "left").join(worst, [*keys, channel], "left")

    def limit(table: dict[str, int]):
        out = F.lit(None).cast("long")
        for c, g in table.items():
            out = F.when(F.col(channel) == c, F.lit(g)).otherwise(out)
        return out

    rules = [
        (2, "missing ", F.col("_n").isNull()),
        (2, "gap ", F.col("_gap") > limit(drop_gap)),
        (1, "gap ", F.col("_gap") > limit(warn_gap)),
        (1, "few ", F.col("_n") < few),
    ]
    marks = F.array(*[
        F.when(hit, F.struct(F.lit(lvl).alias("level"), F.concat(F.lit(text), F.col(channel)).alias("reason"))) for lvl, text, hit in rules
    ])
    found = state.withColumn("_m", F.explode(F.array_compact(marks))).select(*keys, "_m.level", "_m.reason")
    return verdicts(frames, keys, found)


@dataclass(frozen=True)
class ScreenRules:
    """What a recording must deliver. Times are in stamp units, `ticks` of them make a second.

    `required` streams define the coverage window; `pose` may be stood in for by `odometry`; cameras deliver
    `nominal_hz` frames a second, below `min_delivery` of it is marginal, below `bad_delivery` a drop.
    """

    required: tuple[str, ...]
    cameras: tuple[str, ...]
    anchor: str
    pose: str
    odometry: str
    ticks: int
    nominal_hz: float
    off_clock: int
    margin: int
    max_anchor_gap: int
    max_pose_gap: int
    max_cut: int
    max_bad_run: int
    good: str
    max_bad_share: float = 0.02
    min_delivery: float = 0.98
    bad_delivery: float = 0.90
    min_scene_share: float = 0.5


def findings(
    frames: DataFrame, recordings: DataFrame, status: DataFrame, scenes: DataFrame, keys: list[str], channel: str, at: str,
    rules: ScreenRules, span: int,
) -> DataFrame:
    """(keys, level, rule, subject) for every rule that a recording breaks; level 1 is marginal, 2 a drop.

    `frames`: keys, channel, at; `recordings`: keys, started (the recorder's clock); `status`: keys, at, status of the pose
    source; `scenes`: keys, scene_time, the time that ends up in scenes. Every rule reads one row per stream or per
    run, so frames are scanned for extents, steps and status runs and never gathered.
    """
    every = recordings.select(*keys).distinct()
    streams = stage(frames.where(F.col(channel).isin([*rules.required, rules.odometry])).groupBy(*keys, channel).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")
    ).join(recordings.select(*keys, "started"), keys), "streams")
    off = F.abs(F.col("first") - F.col("started")) > rules.off_clock
    wanted = every.withColumn(channel, F.explode(F.array(*[F.lit(c) for c in rules.required])))
    state = wanted.join(streams, [*keys, channel], "left")
    stands_in = streams.where(F.col(channel) == rules.odometry).select(*keys, F.lit(True).alias("_odo"))
    pose = state.where(F.col(channel) == rules.pose).join(stands_in, keys, "left").select(*keys, (F.col("n").isNull() & F.col("_odo")).alias("_by_odo"))
    state = state.join(pose, keys, "left").withColumn("_by_odo", F.coalesce("_by_odo", F.lit(False)) & (F.col(channel) == rules.pose))
    usable = streams.where(F.col(channel).isin(list(rules.required)) & ~off).select(*keys, channel)
    gaps = steps(frames.join(usable, [*keys, channel], "left_semi"), [*keys, channel], at, span)
    worst = stage(gaps.groupBy(*keys, channel).agg(F.max("dt").alias("gap")), "gaps")
    window = stage(coverage_window(frames.join(usable, [*keys, channel], "left_semi"), keys, at, channel, list(rules.required), rules.margin), "window")
    open_ = F.col("end_at") > F.col("start_at")

    def found(df: DataFrame, level, rule: str, subject) -> DataFrame:
        return df.select(*keys, F.lit(level).cast("int").alias("level") if isinstance(level, int) else level.cast("int").alias("level"),
                         F.lit(rule).alias("rule"), subject.alias("subject"))

    whole, none = F.lit(""), F.col("n").isNull()
    width = F.col("last") - F.col("first")
    delivery = streams.where(F.col(channel).isin(list(rules.cameras)) & ~off & (F.col("n") >= 10)).groupBy(*keys).agg(
        F.min(F.col("n") * rules.ticks / (width * rules.nominal_hz)).alias("_worst")
    )
    runs = status_runs(status, keys, at, "status", rules.good, span)
    runs = runs.select(*keys, F.col("start_at").alias("_a"), F.col("end_at").alias("_b"))
    inside = runs.join(window.select(*keys, "start_at", "end_at"), keys).where((F.col("_b") >= F.col("start_at")) & (F.col("_a") <= F.col("end_at")))
    longest = inside.groupBy(*keys).agg(F.max(F.col("_b") - F.col("_a")).alias("_run"))
    share = status.groupBy(*keys).agg((F.count_if(F.col("status") != rules.good) / F.count(F.lit(1))).alias("_bad")).join(longest, keys, "left")
    long_run = F.coalesce(F.col("_run") >= rules.max_bad_run, F.lit(False))
    yielded = window.where(open_).join(scenes, keys, "left").where(
        F.coalesce("scene_time", F.lit(0)) < rules.min_scene_share * (F.col("end_at") - F.col("start_at"))
    )
    parts = [
        found(every.join(streams.select(*keys).distinct(), keys, "left_anti"), 2, "no streams", whole),
        found(streams.where(off), 2, "off clock", F.col(channel)),
        found(state.where(none & ~F.col("_by_odo")), 2, "missing", F.col(channel)),
        found(state.where("_by_odo"), 1, "odometry only", F.col(channel)),
        found(worst.where((F.col(channel) == rules.anchor) & (F.col("gap") > rules.max_anchor_gap)), 1, "anchor gap", F.col(channel)),
        found(worst.where((F.col(channel) == rules.pose) & (F.col("gap") > rules.max_pose_gap)), 2, "pose gap", F.col(channel)),
        found(delivery.where(F.col("_worst") < rules.min_delivery), F.when(F.col("_worst") >= rules.bad_delivery, 1).otherwise(2), "camera delivery", whole),
        found(window.where(~open_), 2, "no common window", whole),
        found(window.where(open_ & (F.col("head_cut") + F.col("tail_cut") > rules.max_cut)), 1, "window cut", whole),
        found(share.where(long_run), 2, "bad status run", whole),
        found(share.where(~long_run & (F.col("_bad") > rules.max_bad_share)), 1, "bad status share", whole),
        found(yielded, 1, "few scenes", whole),
    ]
    return reduce(DataFrame.unionByName, parts)
