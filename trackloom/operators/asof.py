"""Joins between streams of different rates: nearest, following, complete-set and interpolating as-of joins.

All of them rest on `bracket`, a union of both sides scanned once per direction (linear, no range join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, latest, pick_by, scan, soonest


def bracket(
    queries: DataFrame,
    targets: DataFrame,
    keys: list[str],
    at: str,
    payload: list[str],
    span: int,
    tie: list[str] | None = None,
    collapse: bool = True,
) -> DataFrame:
    """`queries` plus `lo`, the last target before the query, and `hi`, the first target at or after it.

    Both are structs (at, *payload), null where there is none. With `collapse`, targets that share an instant keep
    the row that is last by `tie` (which must tell them apart; default: all of the payload), and every distinct
    query instant is looked up once and joined back, so repeated instants of a hot key cost one row. Pass False
    when the instants of both sides are unique already.
    """
    hit = F.struct(F.col(at), *payload)
    found = targets.select(*keys, at, hit.alias("_hit"), *[F.col(c).alias(f"_tie_{c}") for c in tie or []])
    if collapse and not payload:
        found = found.select(*keys, at).distinct().withColumn("_hit", F.struct(at))
    elif collapse and tie:
        rank = F.col(f"_tie_{tie[0]}") if len(tie) == 1 else F.struct(*[f"_tie_{c}" for c in tie])
        found = found.groupBy(*keys, at).agg(pick_by(F.col("_hit"), _type(found, "_hit"), rank, False).alias("_hit"))
    elif collapse:
        found = found.groupBy(*keys, at).agg(F.max("_hit").alias("_hit"))
    others = [c for c in queries.columns if c not in (*keys, at)]
    asked = queries.select(*keys, at).distinct() if collapse else queries
    carried = [] if collapse else others
    rows = asked.select(
        *keys, at, F.lit(0).alias("_side"), F.lit(None).cast(_type(found, "_hit")).alias("_hit"), *carried
    ).unionByName(found.select(*keys, at, F.lit(1).alias("_side"), "_hit"), allowMissingColumns=True)
    axis = Axis(tuple(keys), at, span, ("_side",), ranked_by_at=True)
    both = scan(rows, axis, {"lo": latest("_hit"), "hi": soonest("_hit")}).where("_side = 0")
    answers = both.select(*keys, at, *carried, "lo", "hi")
    if not collapse:
        return answers.select(*queries.columns, "lo", "hi")
    return queries.join(answers, [*keys, at]).select(*queries.columns, "lo", "hi")


def _type(df: DataFrame, column: str):
    return df.schema[column].dataType


def at_or_before(at: str) -> Column:
    """From a bracketed row: the last target at or before the query."""
    return F.when(F.col("hi")[at] == F.col(at), F.col("hi")).otherwise(F.col("lo"))


def nearest(
    queries: DataFrame,
    targets: DataFrame,
    keys: list[str],
    at: str,
    payload: list[str],
    span: int,
    later_wins: bool = False,
    **options,
) -> DataFrame:
    """`queries` plus `match` (struct at, *payload; null when the key has no target) and `distance`.

    A tie goes to the earlier target, or to the later one with `later_wins`.
    """
    b = bracket(queries, targets, keys, at, payload, span, **options)
    d_lo, d_hi = F.col(at) - F.col("lo")[at], F.col("hi")[at] - F.col(at)
    take_lo = F.col("hi").isNull() | (d_lo < d_hi if later_wins else d_lo <= d_hi)
    use_lo = F.col("lo").isNotNull() & take_lo
    return b.select(
        *queries.columns,
        F.when(use_lo, F.col("lo")).otherwise(F.col("hi")).alias("match"),
        F.when(use_lo, d_lo).otherwise(d_hi).alias("distance"),
    )


def nearest_within(
    queries: DataFrame,
    targets: DataFrame,
    keys: list[str],
    at: str,
    payload: list[str],
    span: int,
    tolerance: Column | int,
    query_cols: list[str],
    per: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """One row per matched target: the nearest match within `tolerance`; of queries that share a target the latest
    wins, separately for each value of the query columns `per`."""
    near = nearest(queries, targets, keys, at, payload, span, **options)
    near = near.where(F.col("distance") <= tolerance)
    near = near.withColumn("_target_at", F.col("match")[at])
    best = near.groupBy(*keys, *per, "_target_at").agg(
        F.max_by(F.struct(at, "match", "distance", *query_cols), F.struct(at, *query_cols)).alias("_b")
    )
    return best.select(
        *keys,
        *per,
        F.col("_b")[at].alias(at),
        *[F.col("_b")[c].alias(c) for c in query_cols],
        F.col("_b")["match"].alias("match"),
        F.col("_b")["distance"].alias("distance"),
    )


def forward(
    queries: DataFrame, targets: DataFrame, keys: list[str], at: str, payload: list[str], span: int, **options
) -> DataFrame:
    """`queries` plus `match`: the first target at or after the query; past the end, the last target."""
    b = bracket(queries, targets, keys, at, payload, span, **options)
    return b.select(*queries.columns, F.coalesce("hi", "lo").alias("match"))


def complete_set(
    anchors: DataFrame,
    instants: DataFrame,
    keys: list[str],
    at: str,
    members: list[str],
    sync: int,
    span: int,
    **options,
) -> DataFrame:
    """`anchors` plus the chosen capture instant: `instant`, one column per member, and `dev`.

    `instants` holds complete sets only: `at` plus the member stamps. Of the instants on either side the one whose
    farthest member is nearest is taken, if within `sync`; the earlier one wins a tie. Null where none qualifies.
    """
    b = bracket(anchors, instants, keys, at, members, span, **options)

    def deviation(side: str) -> Column:
        gaps = [F.abs(F.col(side)[m] - F.col(at)) for m in members]
        worst = F.greatest(*gaps) if len(gaps) > 1 else gaps[0]
        return F.when(F.col(side).isNotNull() & (worst <= sync), worst)

    b = b.withColumn("_dlo", deviation("lo")).withColumn("_dhi", deviation("hi"))
    use_lo = F.col("_dlo").isNotNull() & (F.col("_dhi").isNull() | (F.col("_dlo") <= F.col("_dhi")))
    pick = F.when(use_lo, F.col("lo")).when(F.col("_dhi").isNotNull(), F.col("hi"))
    b = b.withColumn("_pick", pick)
    return b.select(
        *anchors.columns,
        F.col("_pick")[at].alias("instant"),
        *[F.col("_pick")[m].alias(m) for m in members],
        F.when(F.col("_pick").isNotNull(), F.when(use_lo, F.col("_dlo")).otherwise(F.col("_dhi"))).alias("dev"),
    )


def lerp(b_at: str, value: str) -> Column:
    """Linear interpolation of `value` inside a bracketed row; held at the ends of the target series."""
    lo, hi, t = F.col("lo"), F.col("hi"), F.col(b_at)
    share = (t - lo[b_at]) / (hi[b_at] - lo[b_at])
    return (
        F.when(lo.isNull(), hi[value])
        .when(hi.isNull(), lo[value])
        .when(hi[b_at] == t, hi[value])
        .otherwise(lo[value] + share * (hi[value] - lo[value]))
    )


def interpolate(
    queries: DataFrame, targets: DataFrame, keys: list[str], at: str, values: list[str], span: int, **options
) -> DataFrame:
    """`queries` plus the target `values` interpolated at the query time, clamped outside coverage."""
    b = bracket(queries, targets, keys, at, values, span, **options)
    return b.select(*queries.columns, *[lerp(at, v).alias(v) for v in values])


def slerp(
    bracketed: DataFrame, at: str, names: tuple[str, str, str, str] = ("qw", "qx", "qy", "qz")
) -> DataFrame:
    """Adds the quaternion `names` (w, x, y, z) between the two ends of bracketed rows; held at the ends.

    The short way round is taken; nearly equal ends fall back to a normalized straight line. Each step is a column
    of its own, so shared terms are computed once.
    """
    a, b = [F.col("lo")[n] for n in names], [F.col("hi")[n] for n in names]
    df = bracketed.withColumn("_dot", sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0]))
    df = df.withColumn("_cos", F.least(F.abs("_dot"), F.lit(1.0)))
    df = df.withColumn("_theta", F.acos("_cos"))
    df = df.withColumn("_s", (F.col(at) - F.col("lo")[at]) / (F.col("hi")[at] - F.col("lo")[at]))
    near, s, th = F.col("_cos") > 1.0 - 1e-12, F.col("_s"), F.col("_theta")
    df = df.withColumn("_wa", F.when(near, 1.0 - s).otherwise(F.sin((1.0 - s) * th) / F.sin(th)))
    sign = F.when(F.col("_dot") < 0, -1.0).otherwise(1.0)
    df = df.withColumn("_wb", F.when(near, s).otherwise(F.sin(s * th) / F.sin(th)) * sign)
    df = df.select("*", *[(F.col("_wa") * x + F.col("_wb") * y).alias(f"_m_{n}") for x, y, n in zip(a, b, names)])
    m = [F.col(f"_m_{n}") for n in names]
    df = df.withColumn("_norm", F.sqrt(sum((c * c for c in m[1:]), m[0] * m[0])))
    at_hi = F.col("lo").isNull() | (F.col("hi")[at] == F.col(at))
    out = [
        F.when(at_hi, y).when(F.col("hi").isNull(), x).otherwise(c / F.col("_norm")).alias(n)
        for x, y, c, n in zip(a, b, m, names)
    ]
    return df.select(*bracketed.columns, *out)


def interpolate_pose(
    queries: DataFrame,
    poses: DataFrame,
    keys: list[str],
    at: str,
    span: int,
    vector: tuple[str, ...] = ("x", "y", "z"),
    quaternion: tuple[str, str, str, str] = ("qw", "qx", "qy", "qz"),
    outside: str = "error",
    **options,
) -> DataFrame:
    """`queries` plus position and orientation at the query time.

    Outside pose coverage: "error" fails the job (a held pose would hide a gap), "null" leaves the pose empty,
    "hold" keeps the first or last pose.
    """
    b = bracket(queries, poses, keys, at, [*vector, *quaternion], span, **options)
    inside = F.col("hi").isNotNull() & (F.col("lo").isNotNull() | (F.col("hi")[at] == F.col(at)))
    if outside == "error":
        message = F.concat(F.lit("frame outside pose coverage at "), F.col(at).cast("string"))
        b = b.withColumn(at, F.when(inside, F.col(at)).otherwise(F.raise_error(message).cast("long")))
    b = slerp(b, at, quaternion)
    out = b.select(*queries.columns, *[lerp(at, v).alias(v) for v in vector], *quaternion, inside.alias("_inside"))
    if outside == "null":
        out = out.select(
            *queries.columns, *[F.when(F.col("_inside"), F.col(n)).alias(n) for n in (*vector, *quaternion)]
        )
    return out.drop("_inside")
