"""Three filters in a fixed order that propose scenes to drop: repeated stops, few objects, overlapping paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators import graph, pairs
from trackloom.operators.quota import keep_most_active
from trackloom.session import stage


def propose(
    scenes: DataFrame, points: DataFrame, ego: DataFrame, place_m: float = 10.0, heading_deg: float = 30.0, tau: float = 1.0,
    share: float = 0.8, min_objects: float = 0.0, min_overlap: float = 0.8,
) -> DataFrame:
    """(scene, step, by): candidates of each filter; scenes not listed pass.

    `scenes`: scene, log, started, cls, activity, objects (mean near road users, may be null), locked, keep (named by
    a person); `points`: scene, seq, x, y, heading; `ego`: scene, win_v, win_w.

    1. Stopped scenes of one recording at one place in one state keep the most active; the whole group is settled.
    2. Scenes with fewer than `min_objects` objects, among those not settled.
    3. Moving scenes, busiest first: one whose path a scene kept before covers by `min_overlap` is a candidate.
       Locked scenes count as kept before all others. Locked and named scenes are never proposed.
    """
    s = stage(scenes, "scenes")
    stopped = s.where((F.col("cls") == "stopped") & ~F.col("locked")).select("scene", "log", "activity", "keep")
    inside = points.join(stopped.select("scene", "log"), "scene")
    cover = stage(
        pairs.place_cover(inside, "scene", "seq", "x", "y", "heading", place_m, heading_deg, share, within=("log",)), "cover"
    )
    groups = stage(pairs.same_place_groups(cover, ego, stopped, "scene", share, tau), "groups")
    ranked = keep_most_active(groups.join(stopped, "scene"), ["component"], "scene", "activity")
    repeats = ranked.where("candidate and not keep").select("scene", F.lit("stops").alias("step"), F.col("rep").alias("by"))

    few = s.join(groups.select("scene"), "scene", "left_anti").where(
        ~F.col("locked") & ~F.col("keep") & (F.col("objects") < min_objects)
    ).select("scene", F.lit("objects").alias("step"), F.lit(None).cast("string").alias("by"))

    moving = s.where(F.col("cls") != "stopped").join(few.select("scene"), "scene", "left_anti")
    paths = points.join(moving.select("scene"), "scene", "left_semi")
    over = stage(pairs.place_cover(paths, "scene", "seq", "x", "y", "heading", place_m, heading_deg, min_overlap), "overlap")
    order = moving.select(
        "scene",
        F.struct(
            (~F.col("locked")).alias("l"), (-F.coalesce("objects", F.lit(0.0))).alias("o"), "started", F.col("scene").alias("s")
        ).alias("rank"),
    )
    exempt = moving.where("locked or keep").select(F.col("scene").alias("a"))
    able = over.join(exempt, "a", "left_anti").select("a", "b")
    kept = graph.greedy_keep(order, able, "scene", "rank", "a", "b")
    best = over.join(kept.where("kept").select(F.col("scene").alias("b")), "b", "left_semi")
    best = best.join(order.select(F.col("scene").alias("a"), F.col("rank").alias("_ra")), "a").join(
        order.select(F.col("scene").alias("b"), F.col("rank").alias("_rb")), "b"
    ).where("_rb < _ra")
    by = best.groupBy(F.col("a").alias("scene")).agg(F.max_by("b", F.struct("cover", "b")).alias("by"))
    overlap = kept.where("not kept").select("scene").join(by, "scene", "left").select(
        "scene", F.lit("overlap").alias("step"), "by"
    )
    return repeats.unionByName(few).unionByName(overlap)
