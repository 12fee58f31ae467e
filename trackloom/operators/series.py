"""Moving features of a track: smoothing, departures, standstills, look-ahead turns, unwrapped angles, distances."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.asof import bracket
from trackloom.operators.ordered import (
    Axis,
    following,
    islands,
    position,
    prev,
    row_frame,
    running_max,
    running_min,
    running_sum,
    scan,
)
from trackloom.session import stage


def moving_average(
    df: DataFrame, axis: Axis, columns: dict[str, str], k: int, rows_per_block: int = 65_536
) -> DataFrame:
    """Centred average of k rows with zeros beyond the ends: the divisor is always k, an even k leans backwards.

    `columns` maps output to input names.
    """
    back, ahead = k // 2, (k - 1) // 2

    def build(w):
        frame = w.rowsBetween(-back, ahead)
        return {out: F.sum(src).over(frame) / F.lit(float(k)) for out, src in columns.items()}

    return row_frame(df, axis, back, ahead, build, rows_per_block)


def departures(df: DataFrame, axis: Axis, speed: str, still: float, moving: float) -> DataFrame:
    """Rows marked `departing` (moving now, still at some point before) and `halting` (still now, moving before)."""
    s = scan(df, axis, {"_low": running_min(speed), "_top": running_max(speed)})
    v = F.col(speed)
    return s.select(
        *df.columns,
        ((F.col("_low") < still) & (v > moving)).alias("departing"),
        ((F.col("_top") > moving) & (v < still)).alias("halting"),
    )


def standstill(df: DataFrame, axis: Axis, stopped: str) -> DataFrame:
    """Time stopped so far and time still to come within the row's standstill: `run_before`, `run_after`.

    A step counts when the row it leads to (before) or leaves from (after) is stopped; both are 0 on moving rows.
    """
    at = axis.at
    stepped = stage(
        scan(df, axis, {"_p": prev(at), "_n": following(at)}).withColumn("_gone", F.col(at) - F.col("_p"))
        .withColumn("_left", F.col("_n") - F.col(at)),
        "standstill",
    )
    runs = islands(stepped, axis, [stopped], lambda p, c: p(stopped) != c(stopped), "_run")
    bounds = runs.where(stopped).groupBy(*axis.keys, "_run").agg(
        F.min_by(F.col(at) - F.coalesce("_gone", F.lit(0)), at).alias("_from"),
        F.max_by(F.col(at) + F.coalesce("_left", F.lit(0)), at).alias("_to"),
    )
    out = runs.join(bounds, [*axis.keys, "_run"], "left")
    on = F.col(stopped)
    return out.select(
        *df.columns,
        F.when(on, F.col(at) - F.col("_from")).otherwise(0).alias("run_before"),
        F.when(on, F.col("_to") - F.col(at)).otherwise(0).alias("run_after"),
    )


def unwrap(df: DataFrame, axis: Axis, angle: str, out: str = "unwrapped", turn: float = 2 * math.pi) -> DataFrame:
    """Angle without jumps: every step is brought into (-half turn, half turn] and summed up."""
    s = scan(df, axis, {"_p": prev(angle)})
    d = F.col(angle) - F.col("_p")
    half = turn / 2
    wrapped = F.pmod(d + half, F.lit(turn)) - half
    wrapped = F.when((wrapped == -half) & (d > 0), F.lit(half)).otherwise(wrapped)
    fix = F.when(F.abs(d) < half, F.lit(0.0)).otherwise(wrapped - d)
    s = s.withColumn("_fix", F.coalesce(fix, F.lit(0.0)))
    t = scan(s, axis, {"_sum": running_sum("_fix")})
    return t.select(*df.columns, (F.col(angle) + F.col("_sum")).alias(out))


def look_ahead(df: DataFrame, axis: Axis, angle: str, speed: str, ahead: int, min_speed: float) -> DataFrame:
    """Change of `angle` from each row to the first row at least `ahead` later, where the mean speed of the rows in
    between (from the row on, the later one left out) is above `min_speed`; null elsewhere. Adds `turn`."""
    at = axis.at
    base = stage(
        scan(df, axis, {"_pos": position(), "_cum": running_sum(speed)}).withColumn("_before", F.col("_cum") - F.col(speed)),
        "lookahead",
    )
    asked = base.select(*axis.keys, F.col(at).alias("_at0"), (F.col(at) + ahead).alias(at)).distinct()
    later = base.select(
        *axis.keys, at, F.col(angle).alias("_angle1"), F.col("_pos").alias("_pos1"), F.col("_before").alias("_before1")
    )
    b = bracket(asked, later, list(axis.keys), at, ["_angle1", "_pos1", "_before1"], axis.span, tie=["_pos1"])
    hits = b.select(*axis.keys, F.col("_at0").alias(at), "hi")
    mean = (F.col("hi")["_before1"] - F.col("_before")) / (F.col("hi")["_pos1"] - F.col("_pos"))
    joined = base.join(hits, [*axis.keys, at])
    return joined.select(
        *df.columns, F.when(mean > min_speed, F.col("hi")["_angle1"] - F.col(angle)).alias("turn")
    )


def window_means(
    df: DataFrame, keys: list[str], at: str, values: list[str], start: Column, width: int, n: int
) -> DataFrame:
    """Means over n half-open windows of `width` from `start`; a window without rows is 0.0. One row per (key, window)."""
    w = F.floor((F.col(at) - start) / width).cast("int")
    spine = df.select(*keys).distinct().withColumn("window", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    means = df.withColumn("window", w).where(F.col("window").between(0, n - 1)).groupBy(*keys, "window").agg(
        *[F.avg(v).alias(v) for v in values]
    )
    return spine.join(means, [*keys, "window"], "left").select(
        *keys, "window", *[F.coalesce(v, F.lit(0.0)).alias(v) for v in values]
    )


def arc_length(df: DataFrame, axis: Axis, x: str, y: str, z: str | None = None) -> DataFrame:
    """Adds `step_m`, the distance from the previous row (0 for the first), and `arc_m`, its running sum."""
    cols = [x, y] + ([z] if z else [])
    s = scan(df, axis, {f"_p{c}": prev(c) for c in cols})
    sq = sum(((F.col(c) - F.col(f"_p{c}")) * (F.col(c) - F.col(f"_p{c}")) for c in cols[1:]),
             (F.col(x) - F.col(f"_p{x}")) * (F.col(x) - F.col(f"_p{x}")))
    s = s.select(*df.columns, F.coalesce(F.sqrt(sq), F.lit(0.0)).alias("step_m"))
    return scan(s, axis, {"arc_m": running_sum("step_m")})


def gradient(df: DataFrame, axis: Axis, value: str, out: str = "gradient") -> DataFrame:
    """Second-order central differences on an uneven grid, one-sided at the ends."""
    at = axis.at
    s = scan(df, axis, {"_pt": prev(at), "_pv": prev(value), "_nt": following(at), "_nv": following(value)})
    t, v = F.col(at), F.col(value)
    hd, hs = (t - F.col("_pt")).cast("double"), (F.col("_nt") - t).cast("double")
    mid = (hd * hd * F.col("_nv") + (hs * hs - hd * hd) * v - hs * hs * F.col("_pv")) / (hs * hd * (hd + hs))
    edge = F.when(F.col("_pt").isNull(), (F.col("_nv") - v) / hs).otherwise((v - F.col("_pv")) / hd)
    return s.select(*df.columns, F.when(F.col("_pt").isNull() | F.col("_nt").isNull(), edge).otherwise(mid).alias(out))


def pose_jumps(
    df: DataFrame, axis: Axis, ticks: float, max_speed: float = 30.0, max_turn_deg: float = 90.0
) -> DataFrame:
    """Sample borders at which the pose moved or turned faster than allowed: adds `speed`, `turn_rate`, `jump`."""
    names = ["x", "y", "z", "qw", "qx", "qy", "qz"]
    s = scan(df, axis, {"_pt": prev(axis.at), **{f"_p{n}": prev(n) for n in names}})
    dt = (F.col(axis.at) - F.col("_pt")) / ticks
    move = F.sqrt(sum(((F.col(n) - F.col(f"_p{n}")) ** 2 for n in names[1:3]), (F.col("x") - F.col("_px")) ** 2))
    dot = F.abs(sum((F.col(n) * F.col(f"_p{n}") for n in names[4:]), F.col("qw") * F.col("_pqw")))
    turn = F.degrees(2 * F.acos(F.least(dot, F.lit(1.0))))
    ok = dt > 0
    return s.select(
        *df.columns,
        F.when(ok, move / dt).alias("speed"),
        F.when(ok, turn / dt).alias("turn_rate"),
        F.coalesce(ok & ((move / dt > max_speed) | (turn / dt > max_turn_deg)), F.lit(False)).alias("jump"),
    )


def unique_by_time(df: DataFrame, keys: list[str], at: str, seq: list[str]) -> DataFrame:
    """One row per instant: the last one recorded (`seq` must tell the rows of an instant apart)."""
    rest = [c for c in df.columns if c not in (*keys, at)]
    best = df.groupBy(*keys, at).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("_r"))
    return best.select(*keys, at, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def every_kth(df: DataFrame, axis: Axis, k: int) -> DataFrame:
    """The first row of every k of a series."""
    return scan(df, axis, {"_pos": position()}).where((F.col("_pos") - 1) % k == 0).select(*df.columns)


def link_chain(df: DataFrame, axis: Axis, token: str) -> DataFrame:
    """Adds `prev` and `next` tokens; the ends get the empty string."""
    s = scan(df, axis, {"_p": prev(token), "_n": following(token)})
    return s.select(*df.columns, F.coalesce("_p", F.lit("")).alias("prev"), F.coalesce("_n", F.lit("")).alias("next"))


def persistent(df: DataFrame, axis: Axis, gap: str, speed: str, step_s: float = 0.5, slack: float = 3.0) -> DataFrame:
    """Keep a measured gap only if a neighbour row saw one within speed * step + slack; adds `kept`."""
    s = scan(df, axis, {"_p": prev(gap), "_n": following(gap)})
    reach = F.col(speed) * step_s + slack
    near = F.lit(False)
    for other in ("_p", "_n"):
        near = near | F.coalesce(F.abs(F.col(other) - F.col(gap)) <= reach, F.lit(False))
    return s.select(*df.columns, F.when(near, F.col(gap)).alias("kept"))


def off_grid(df: DataFrame, axis: Axis, tol: float = 0.2, rows_per_block: int = 65_536) -> DataFrame:
    """Frames stamped off their own grid: adds `off`.

    A frame is off when it misses the grid of both neighbours by more than `tol` periods while these two agree.
    At the ends the one neighbour must disagree and the next pair agree. Streams under 3 frames are never off.
    """
    from trackloom.operators.stats import quantiles, steps

    keys, at = list(axis.keys), axis.at
    period = quantiles(steps(df, keys, at, axis.span), keys, "dt", {"_period": 0.5})
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    def near(w):
        return {"_p2": F.lag(at, 2).over(w), "_p1": F.lag(at, 1).over(w), "_n1": F.lead(at, 1).over(w), "_n2": F.lead(at, 2).over(w)}

    s = row_frame(df, axis, 2, 2, near, rows_per_block).join(n, keys)
    s = s.join(period, keys, "left") if keys else s.withColumn("_one", F.lit(1)).join(
        F.broadcast(period.withColumn("_one", F.lit(1))), "_one"
    )

    def dev(a: str, b: str) -> Column:
        x = (F.col(b) - F.col(a)) / F.col("_period")
        return F.abs(x - F.rint(x))

    first, last = F.col("_p1").isNull(), F.col("_n1").isNull()
    d_prev, d_next = dev("_p1", at), dev(at, "_n1")
    mid = (d_prev > tol) & (d_next > tol) & (dev("_p1", "_n1") <= tol)
    head = (d_next > tol) & (dev("_n1", "_n2") <= tol)
    tail = (d_prev > tol) & (dev("_p2", "_p1") <= tol)
    off = F.when(first, head).when(last, tail).otherwise(mid)
    usable = (F.col("_n") >= 3) & (F.col("_period") > 0)
    return s.select(*df.columns, F.coalesce(usable & off, F.lit(False)).alias("off"))
