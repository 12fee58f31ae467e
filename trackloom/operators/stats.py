"""Exact quantiles, modes, fits and delivery statistics that never hold a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, position, prev, scan
from trackloom.session import stage

_SMALL = 20_000  # groups up to this size skip the sketch: all their rows are candidates
_REACH = 0.0005  # half width of the candidate band around a probability
_ACCURACY = 10_000  # sketch error 1/accuracy, well inside the band


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation between ranks: one row per key, one column per named probability.

    A mergeable sketch brackets each quantile; a second pass counts what lies below the bracket and keeps only the
    values inside it (0.1 % of a large group), with equal values merged before the shuffle. Nulls are ignored.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v is not null")
    names = list(probs)
    ends = [max(0.0, probs[n] - _REACH) for n in names] + [min(1.0, probs[n] + _REACH) for n in names]
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, _ACCURACY).alias("_ends")
    )
    k = len(names)
    bands = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                F.when(F.col("_n") > _SMALL, F.col("_ends")[i]).alias("lo"),
                F.when(F.col("_n") > _SMALL, F.col("_ends")[i + k]).alias("hi"),
                (F.lit(float(probs[n])) * (F.col("_n") - 1)).alias("h"),
            )
            for i, n in enumerate(names)
        ]
    )
    sketch = sketch.select(*keys, bands.alias("_bands"))
    if keys:
        both = rows.join(sketch, keys)
    else:  # exactly one sketch row
        both = rows.withColumn("_one", F.lit(1)).join(F.broadcast(sketch.withColumn("_one", F.lit(1))), "_one")
    tagged = both.select(*keys, "_v", F.explode("_bands").alias("_q"))
    tagged = tagged.where("_q.hi is null or _v <= _q.hi")
    below = F.col("_q")["lo"].isNotNull() & (F.col("_v") < F.col("_q")["lo"])
    counted = tagged.groupBy(*keys, "_q", F.when(~below, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys, "_q").orderBy(F.col("_v").asc_nulls_first())
    upto = F.sum("_c").over(w)
    ranked = counted.select(*keys, "_q", "_v", upto.alias("_upto"), (upto - F.col("_c")).alias("_from"))
    h = F.col("_q")["h"]

    def at_rank(rank: Column) -> Column:
        hit = (F.col("_from") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(hit, F.col("_v")))

    picked = ranked.groupBy(*keys, "_q").agg(at_rank(F.floor(h)).alias("_a"), at_rank(F.ceil(h)).alias("_b"))
    part = F.col("_q")["h"] - F.floor(F.col("_q")["h"])
    found = F.when(
        F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.col("_a") + (F.col("_b") - F.col("_a")) * part
    ).otherwise(F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    flat = picked.select(*keys, F.col("_q")["q"].alias("_i"), found.alias("_x"))
    return flat.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_x"))).alias(n) for i, n in enumerate(names)])


def mode_smallest(df: DataFrame, keys: list[str], value: str, out: str = "mode") -> DataFrame:
    """The most frequent value per key, the smallest one on a tie, with its count `n`."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b")["v"].alias(out), (-F.col("_b")["neg"]).alias("n")
    )


def steps(df: DataFrame, keys: list[str], at: str, span: int, tie: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive intervals of a stream: (keys, prev_at, at, dt)."""
    s = scan(df.select(*keys, at, *tie), Axis(tuple(keys), at, span, tie), {"prev_at": prev(at)})
    return s.where("prev_at is not null").select(*keys, "prev_at", at, (F.col(at) - F.col("prev_at")).alias("dt"))


def extents(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """First and last stamp and row count of every stream."""
    return df.groupBy(*keys).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("n"))


def average_rate(df: DataFrame, keys: list[str], at: str, ticks: float) -> DataFrame:
    """Mean rate (n - 1) / span per key in 1/s, with `ticks` time units per second; 0 below two rows or without span."""
    e = extents(df, keys, at)
    width = F.col("last_at") - F.col("first_at")
    return e.withColumn("rate", F.when((F.col("n") >= 2) & (width > 0), (F.col("n") - 1) * ticks / width).otherwise(0.0))


def delivery_stats(
    df: DataFrame, keys: list[str], at: str, span: int, ticks: float, nominal_hz: float | None = None
) -> DataFrame:
    """How completely a stream arrived.

    Per key with at least 10 rows: n, nominal_hz (given, or 1 / median step), delivery = n / (span * nominal),
    max_gap_s, n_gaps (steps above 1.5 medians), unreliable (inferred rate above 1.3 times the average rate).
    """
    d = steps(df, keys, at, span)
    med = quantiles(d, keys, "dt", {"_med": 0.5})
    ext = extents(df, keys, at)
    gaps = d.join(med, keys).groupBy(*keys).agg(
        F.max("dt").alias("_max"), F.count_if(F.col("dt") > 1.5 * F.col("_med")).alias("n_gaps"), F.any_value("_med").alias("_med")
    )
    x = ext.join(gaps, keys).where("n >= 10")
    width = (F.col("last_at") - F.col("first_at")) / ticks
    inferred = ticks / F.col("_med")
    nominal = F.lit(nominal_hz) if nominal_hz else inferred
    return x.select(
        *keys,
        "n",
        nominal.alias("nominal_hz"),
        (F.col("n") / (width * nominal)).alias("delivery"),
        (F.col("_max") / ticks).alias("max_gap_s"),
        "n_gaps",
        (inferred > 1.3 * F.col("n") / width).alias("unreliable"),
    )


def long_gaps(df: DataFrame, keys: list[str], at: str, span: int, min_gap: int) -> DataFrame:
    """Every step longer than `min_gap`: start and length."""
    d = steps(df, keys, at, span).where(F.col("dt") > min_gap)
    return d.select(*keys, F.col("prev_at").alias("start_at"), F.col("dt").alias("gap"))


def frame_drops(df: DataFrame, keys: list[str], at: str, span: int) -> DataFrame:
    """Per stream: frames, median step, steps above 3 medians, longest step."""
    d = steps(df, keys, at, span)
    med = quantiles(d, keys, "dt", {"median_dt": 0.5})
    return d.join(med, keys).groupBy(*keys).agg(
        (F.count(F.lit(1)) + 1).alias("frames"),
        F.any_value("median_dt").alias("median_dt"),
        F.count_if(F.col("dt") > 3 * F.col("median_dt")).alias("over_3_medians"),
        F.max("dt").alias("longest"),
    )


def regular_streams(df: DataFrame, keys: list[str], at: str, span: int, ticks: float) -> DataFrame:
    """Per stream: rate, median and longest step, whether it is regular (n >= 20 and p90 < 1.6 medians), and the
    number of gaps (steps above 2.5 medians, counted for regular streams only)."""
    d = steps(df, keys, at, span)
    q = quantiles(d, keys, "dt", {"period": 0.5, "_p90": 0.9})
    rate = average_rate(df, keys, at, ticks).select(*keys, "n", "rate")
    marks = q.join(rate, keys).withColumn(
        "regular", (F.col("n") >= 20) & (F.col("period") > 0) & (F.col("_p90") < 1.6 * F.col("period"))
    )
    per = d.join(marks, keys).groupBy(*keys).agg(
        F.any_value("n").alias("n"),
        F.any_value("rate").alias("hz"),
        F.any_value("period").alias("period"),
        F.max("dt").alias("max_gap"),
        F.any_value("regular").alias("regular"),
        F.count_if(F.col("regular") & (F.col("dt") > 2.5 * F.col("period"))).alias("n_gaps"),
    )
    return per


def clock_fit(df: DataFrame, keys: list[str], at: str, delta: str) -> DataFrame:
    """Straight-line fit of a clock difference against reference time (both in s) and its residual.

    offset_ms, skew_ppm, span_s, resid_std_us (population), resid_p99_us, n. Time counts from the key's first row.
    """
    first = df.groupBy(*keys).agg(F.min(at).alias("_t0"))
    t = F.col(at) - F.col("_t0")
    # sums are taken about the key's first row, so they keep their digits
    fit = df.join(first, keys).withColumn("_t", t).groupBy(*keys).agg(
        F.any_value("_t0").alias("_t0"),
        F.regr_slope(F.col(delta), F.col("_t")).alias("_slope"),
        F.regr_intercept(F.col(delta), F.col("_t")).alias("_icpt"),
        F.max("_t").alias("span_s"),
        F.count(F.lit(1)).alias("n"),
    )
    fit = stage(fit, "clock")
    resid = F.col(delta) - (F.col("_slope") * t + F.col("_icpt"))
    resid = stage(df.join(fit, keys).select(*keys, resid.alias("_r")), "clock")
    spread = resid.groupBy(*keys).agg(F.stddev_pop("_r").alias("_std"))
    tail = quantiles(resid.withColumn("_abs", F.abs("_r")), keys, "_abs", {"_p99": 0.99})
    return fit.join(spread, keys).join(tail, keys).select(
        *keys,
        (F.col("_icpt") * 1e3).alias("offset_ms"),
        (F.col("_slope") * 1e6).alias("skew_ppm"),
        "span_s",
        (F.col("_std") * 1e6).alias("resid_std_us"),
        (F.col("_p99") * 1e6).alias("resid_p99_us"),
        "n",
    )


def clock_steps(df: DataFrame, keys: list[str], at: str, resid: str, span: int) -> DataFrame:
    """Step test on a residual: medians of equal-count bins, the largest and the typical jump between neighbours.

    Bins: min(400, max(10, n div 50)) per key; the first n mod bins of them hold one row more. `at` is a LONG.
    """
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = scan(df.select(*keys, at, resid), Axis(tuple(keys), at, span), {"_pos": position()}).join(n, keys)
    rows = rows.withColumn("_bins", F.least(F.lit(400), F.greatest(F.lit(10), F.expr("_n div 50"))))
    small, extra = F.expr("_n div _bins"), F.expr("_n % _bins")
    head = extra * (small + 1)
    i = F.col("_pos") - 1
    rows = rows.withColumn(
        "_bin", F.when(i < head, F.floor(i / (small + 1))).otherwise(extra + F.floor((i - head) / small)).cast("long")
    )
    med = quantiles(rows, [*keys, "_bin"], resid, {"_m": 0.5})
    w = Window.partitionBy(*keys).orderBy("_bin")  # at most 400 bins per key
    jumps = med.withColumn("_j", F.abs(F.col("_m") - F.lag("_m").over(w))).where("_j is not null")
    out = jumps.groupBy(*keys).agg(F.max("_j").alias("max_step"), F.median("_j").alias("typical_step"))
    return out.withColumn(
        "has_step", (F.col("max_step") > 1e-3) & (F.col("max_step") > 4 * F.col("typical_step"))
    )


def fixed_histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts per half-open bin [edge, next edge) of a fixed edge list; the last bin is open. Empty bins count 0."""
    bins = [(i, float(e)) for i, e in enumerate(edges)]
    spine = df.sparkSession.createDataFrame(bins, "bin int, lower double")
    which = F.lit(None).cast("int")
    for i, e in bins:
        which = F.when(F.col(value) >= e, F.lit(i)).otherwise(which)
    counts = df.where(F.col(value) >= edges[0]).groupBy(which.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "bin", "left").select("bin", "lower", F.coalesce("n", F.lit(0)).alias("n"))


def circular_mean(df: DataFrame, keys: list[str], angle: str, weight: str) -> DataFrame:
    """Weighted mean direction per key, in radians."""
    s, c = F.sum(F.col(weight) * F.sin(angle)), F.sum(F.col(weight) * F.cos(angle))
    return df.groupBy(*keys).agg(F.atan2(s, c).alias("mean_angle"))


def median_fusion(df: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """Per key and axis: exact median and population deviation of repeated estimates."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.stddev_pop(a).alias(f"{a}_std") for a in axes]
    )
    for a in axes:
        out = out.join(quantiles(df, keys, a, {f"{a}_median": 0.5}), keys)
    return out


def binned_errors(df: DataFrame, bin_col: str, err: str, clip: float, min_count: int = 1) -> DataFrame:
    """Residual statistics per bin: count, exact median, RMS with errors clipped at `clip`; sparse bins are left out."""
    base = df.groupBy(bin_col).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(F.least(F.col(err), F.lit(clip)), 2))).alias("rms_clipped")
    ).where(F.col("n") >= min_count)
    return base.join(quantiles(df, [bin_col], err, {"median_err": 0.5}), bin_col)


def cauchy_cost(residual: Column, scale: float) -> Column:
    """Robust cost s^2 log(1 + (r / s)^2)."""
    z = residual / scale
    return F.lit(scale * scale) * F.log1p(z * z)


def cauchy_weight(residual: Column, scale: float) -> Column:
    """Weight 1 / (1 + (r / s)^2)."""
    z = residual / scale
    return 1.0 / (1.0 + z * z)


def huber_weight(residual: Column, scale: float) -> Column:
    """Weight 1 inside the scale, s / |r| outside."""
    return F.when(F.abs(residual) <= scale, 1.0).otherwise(scale / F.abs(residual))
