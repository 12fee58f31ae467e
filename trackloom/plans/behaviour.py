"""What the car does in a scene: behaviour class and tags from its track, and driving risk from gaps and motion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators import series
from trackloom.operators.ordered import Axis, position, running_max, scan
from trackloom.session import stage

# Fixed values (km/h, degrees, s): thresholds of the behaviour classes.
STOP, SLOW, MOVING = 1.0, 5.0, 10.0
TURN_DEG, AHEAD_S, STILL_S, STOPPED_SHARE = 30.0, 6.0, 2.0, 0.8


def describe(track: DataFrame, axis: Axis, hz: int, ticks: int) -> DataFrame:
    """One row per scene: cls, departure, stopping, left_turn, right_turn and the distribution features.

    `track`: keys, at, speed (km/h), yaw (rad), ax, ay (m/s^2); `hz` rows per second. Motion is smoothed over one second.
    """
    keys, at = list(axis.keys), axis.at
    rows = series.unwrap(track, axis, "yaw", "_yaw")
    rows = series.moving_average(rows, axis, {"v1": "speed", "ax1": "ax", "ay1": "ay"}, max(1, hz))
    rows = stage(
        rows.withColumn("_deg", F.degrees("_yaw")).withColumn("stopped", F.col("v1") < STOP), "track"
    )
    still = series.standstill(rows, axis, "stopped")
    still = scan(still, axis, {"_run_top": running_max("run_before"), "_v_top": running_max("v1")})
    moves = still.groupBy(*keys).agg(
        F.max((F.col("_run_top") >= STILL_S * ticks) & (F.col("v1") > MOVING)).alias("departure"),
        F.max((F.col("_v_top") > MOVING) & (F.col("run_after") >= STILL_S * ticks)).alias("stopping"),
    )
    ahead = series.look_ahead(rows, axis, "_deg", "speed", int(AHEAD_S * ticks), 3.0)
    ahead = scan(ahead, axis, {"_pos": position()}).where((F.col("_pos") - 1) % max(1, hz) == 0)
    turns = ahead.groupBy(*keys).agg(
        F.greatest(F.coalesce(F.max("turn"), F.lit(0.0)), F.lit(0.0)).alias("left_deg"),
        F.least(F.coalesce(F.min("turn"), F.lit(0.0)), F.lit(0.0)).alias("right_deg"),
    )
    mv = F.col("v1") > 3
    flat = rows.groupBy(*keys).agg(
        F.avg("speed").alias("v_mean"), F.max("speed").alias("v_max"), F.avg(F.col("stopped").cast("double")).alias("stop_frac"),
        (F.max_by("_deg", at) - F.min_by("_deg", at)).alias("net_turn"), F.max(F.abs("ax1")).alias("max_acc"),
        F.min("ax1").alias("min_ax"), F.max(F.abs("ay1")).alias("max_ay"), F.max(mv).alias("moving"),
        F.avg(F.when(mv, F.sin("_yaw"))).alias("_s"), F.avg(F.when(mv, F.cos("_yaw"))).alias("_c"),
        F.avg(F.sin("_yaw")).alias("_s_all"), F.avg(F.cos("_yaw")).alias("_c_all"),
    )
    f = flat.join(moves, keys).join(turns, keys)
    left, right = F.col("left_deg") >= TURN_DEG, F.col("right_deg") <= -TURN_DEG
    cls = (
        F.when(F.col("stop_frac") >= STOPPED_SHARE, "stopped").when(F.col("departure"), "departure").when(F.col("stopping"), "stopping")
        .when(left, "left_turn").when(right, "right_turn").when(F.col("v_mean") < SLOW, "slow")
        .when(F.col("v_mean") < 20, "straight_low").when(F.col("v_mean") < 40, "straight_mid").otherwise("straight_high")
    )
    heading = F.atan2(F.coalesce("_s", "_s_all"), F.coalesce("_c", "_c_all"))
    return f.select(
        *keys, cls.alias("cls"), "departure", "stopping", left.alias("left_turn"), right.alias("right_turn"), "v_mean", "v_max",
        "stop_frac", "net_turn", "max_acc", "min_ax", "max_ay", "moving", "left_deg", "right_deg",
        F.pmod(90 - F.degrees(heading), F.lit(360.0)).alias("bearing"),
    )


def risk(gaps: DataFrame, motion: DataFrame, axis: Axis, ticks: float, limits: dict[str, float]) -> DataFrame:
    """Driving risk per scene: worst braking and lateral motion, shortest headway and time to collision, and a score.

    `gaps`: keys, at, gap (m, null when free), speed (m/s), one row per key frame; `motion`: keys, ax, ay smoothed.
    `limits`: brake (negative), lat, thw, ttc. A score counts from 1 at the limit upwards; 0 without an event.
    """
    from trackloom.operators.ordered import prev

    keys = list(axis.keys)
    g = scan(gaps, axis, {"_g": prev("gap"), "_t": prev(axis.at)})
    v = F.col("speed")
    closing = -(F.col("gap") - F.col("_g")) * ticks / (F.col(axis.at) - F.col("_t"))
    usable = (F.abs(F.col("gap") - F.col("_g")) <= 8) & (v > 3) & (closing > 0.5) & (closing <= v + 2.0)
    near = g.groupBy(*keys).agg(
        F.min(F.when(v > 3, F.col("gap") / v)).alias("min_thw"),
        F.min(F.when(usable, F.col("gap") / closing)).alias("min_ttc"),
        F.min(F.when(v > 3, F.col("gap"))).alias("min_gap_moving"),
    )
    worst = motion.groupBy(*keys).agg(F.min("ax").alias("min_ax"), F.max(F.abs("ay")).alias("max_ay"))
    f = worst.join(near, keys, "full")
    events = [
        F.when(F.col("min_ax") <= limits["brake"], 1 + limits["brake"] - F.col("min_ax")),
        F.when(F.col("max_ay") >= limits["lat"], 1 + F.col("max_ay") - limits["lat"]),
        F.when(F.col("min_thw") <= limits["thw"], 1 + (limits["thw"] - F.col("min_thw")) / 0.3),
        F.when(F.col("min_ttc") <= limits["ttc"], 1 + (limits["ttc"] - F.col("min_ttc")) / 0.5),
    ]
    score = F.bround(F.coalesce(F.greatest(*events), F.lit(0.0)), 2)
    return f.withColumn("score", score).withColumn(
        "level", F.when(F.col("score") >= 2, "high").when(F.col("score") >= 1, "caution").otherwise("")
    )
