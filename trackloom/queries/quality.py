"""Screening of recordings: delivery, gaps, clocks, quantiles, verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.operators import stats
from trackloom.operators.ordered import fit_span
from trackloom.plans.screening import ScreenRules, findings, screening_verdicts, verdicts
from trackloom.queries.registry import DAY, events, query, r6, table, width

_T = 1_000_000.0
_D = """
with e as (select event_type, epoch_us(ts) as at from events),
d as (select event_type, at, at - lag(at) over (partition by event_type order by at) as dt from e),
m as (select event_type, quantile_cont(dt, 0.5) as med, quantile_cont(dt, 0.9) as p90, max(dt) as mx from d where dt is not null group by event_type),
x as (select event_type, count(*) as n, min(at) as f, max(at) as l from e group by event_type)
"""


@query(
    _D
    + """ select event_type, x.n, round(1000000 / med, 9) as nominal_hz, round(x.n / ((l - f) / 1e6 * (1000000 / med)), 6) as delivery,
round(mx / 1e6, 6) as max_gap_s, (select count(*) from d where d.event_type = x.event_type and dt > 1.5 * med) as n_gaps,
1000000 / med > 1.3 * x.n / ((l - f) / 1e6) as unreliable from x join m using (event_type) where x.n >= 10"""
)
def delivery_stats(spark, sf):
    d = stats.delivery_stats(events(spark, sf), ["event_type"], "at", width(spark, sf, "event_type"), _T)
    return d.select("event_type", "n", F.round("nominal_hz", 9).alias("nominal_hz"), r6("delivery").alias("delivery"),
                    r6("max_gap_s").alias("max_gap_s"), "n_gaps", "unreliable")


@query(
    """
with d as (select user_id, lag(epoch_us(ts)) over w as start_at, epoch_us(ts) - lag(epoch_us(ts)) over w as gap from events window w as (partition by user_id order by ts))
select user_id, start_at, gap from d where gap > 86400000000"""
)
def gap_report(spark, sf):
    return stats.long_gaps(events(spark, sf), ["user_id"], "at", width(spark, sf, "user_id"), DAY)


@query(
    _D
    + """ select event_type, x.n as frames, med as median_dt, (select count(*) from d where d.event_type = x.event_type and dt > 3 * med) as over_3_medians,
mx as longest from x join m using (event_type)"""
)
def frame_drops(spark, sf):
    return stats.frame_drops(events(spark, sf), ["event_type"], "at", width(spark, sf, "event_type"))


@query(
    _D
    + """, r as (select event_type, x.n, round((x.n - 1) * 1e6 / (l - f), 9) as hz, med as period, mx as max_gap, x.n >= 20 and med > 0 and p90 < 1.6 * med as regular
from x join m using (event_type))
select r.*, (select count(*) from d where d.event_type = r.event_type and r.regular and dt > 2.5 * period) as n_gaps from r
union all
select 'all', x.n, round((x.n - 1) * 1e6 / (l - f), 9), med, mx, x.n >= 20 and med > 0 and p90 < 1.6 * med, 0 from
(select count(*) as n, min(at) as f, max(at) as l from e) x, (select quantile_cont(dt, 0.5) as med, quantile_cont(dt, 0.9) as p90, max(dt) as mx
 from (select at - lag(at) over (order by at) as dt from e) where dt is not null) m"""
)
def regular_streams(spark, sf):
    e = events(spark, sf).select("event_type", "at")
    both = e.unionByName(e.withColumn("event_type", F.lit("all")))
    span = fit_span(both, ["event_type"], "at", width(spark, sf, "event_type"))  # all events are denser than any type
    r = stats.regular_streams(both, ["event_type"], "at", span, _T)
    return r.select("event_type", "n", F.round("hz", 9).alias("hz"), "period", "max_gap", "regular", "n_gaps")


@query(
    """
with e as (select user_id, epoch_us(ts) / 1e6 as t, value from events),
r as (select user_id, t - min(t) over (partition by user_id) as t, value from e),
f as (select user_id, regr_slope(value, t) as s, regr_intercept(value, t) as i, count(*) as n, max(t) as span from r group by user_id),
q as (select user_id, value - (s * t + i) as res from r join f using (user_id)),
z as (select user_id, stddev_pop(res) as sd, quantile_cont(abs(res), 0.99) as p99 from q group by user_id)
select user_id, round(i * 1e3, 3) as offset_ms, round(s * 1e6, 3) as skew_ppm, round(span, 6) as span_s, round(sd * 1e6, 0) as resid_std_us,
round(p99 * 1e6, 0) as resid_p99_us, n from f join z using (user_id)"""
)
def clock_fit(spark, sf):
    e = events(spark, sf).select("user_id", (F.col("at") / 1e6).alias("t"), "value")
    f = stats.clock_fit(e, ["user_id"], "t", "value")
    return f.select("user_id", F.round("offset_ms", 3).alias("offset_ms"), F.round("skew_ppm", 3).alias("skew_ppm"), r6("span_s").alias("span_s"),
                    F.round("resid_std_us", 0).alias("resid_std_us"), F.round("resid_p99_us", 0).alias("resid_p99_us"), "n")


@query(
    """
with e as (select event_type, epoch_us(ts) as at, value, row_number() over (partition by event_type order by ts) - 1 as i, count(*) over (partition by event_type) as n from events),
b as (select *, least(400, greatest(10, n // 50)) as bins from e),
k as (select *, case when i < (n % bins) * (n // bins + 1) then i // (n // bins + 1) else (n % bins) + (i - (n % bins) * (n // bins + 1)) // (n // bins) end as bin from b),
m as (select event_type, bin, quantile_cont(value, 0.5) as med from k group by all),
j as (select event_type, abs(med - lag(med) over (partition by event_type order by bin)) as j from m)
select event_type, round(max(j), 6) as max_step, round(quantile_cont(j, 0.5), 6) as typical_step,
max(j) > 1e-3 and max(j) > 4 * quantile_cont(j, 0.5) as has_step from j where j is not null group by event_type"""
)
def clock_steps(spark, sf):
    c = stats.clock_steps(events(spark, sf), ["event_type"], "at", "value", width(spark, sf, "event_type"))
    return c.select("event_type", r6("max_step").alias("max_step"), r6("typical_step").alias("typical_step"), "has_step")


@query(
    """select l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) as p10, round(quantile_cont(l_extendedprice, 0.5), 6) as p50,
round(quantile_cont(l_extendedprice, 0.9), 6) as p90, round(quantile_cont(l_extendedprice, 0.99), 6) as p99, max(l_extendedprice) as top
from lineitem group by l_returnflag"""
)
def percentile_table(spark, sf):
    li = table(spark, sf, "lineitem")
    q = stats.quantiles(li, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99, "top": 1.0})
    return q.select("l_returnflag", *[r6(c).alias(c) for c in ("p10", "p50", "p90", "p99")], "top")


@query(
    """select round(quantile_cont(l_quantity, 0.25), 6) as p25, round(quantile_cont(l_quantity, 0.5), 6) as p50, round(quantile_cont(l_quantity, 0.999), 6) as p999 from lineitem"""
)
def percentiles_overall(spark, sf):
    q = stats.quantiles(table(spark, sf, "lineitem"), [], "l_quantity", {"p25": 0.25, "p50": 0.5, "p999": 0.999})
    return q.select(*[r6(c).alias(c) for c in q.columns])


_EDGES = [0, 1, 2, 3, 5, 8, 12, 20, 30, 50]


@query(
    """
with edges as (select * from (values (0, 0.0::double), (1, 1.0), (2, 2.0), (3, 3.0), (4, 5.0), (5, 8.0), (6, 12.0), (7, 20.0), (8, 30.0), (9, 50.0)) t(bin, lower)),
b as (select bin, lower, coalesce(lead(lower) over (order by bin), 1e18) as upper from edges)
select bin, lower, (select count(*) from lineitem where l_quantity >= lower and l_quantity < upper) as n from b"""
)
def fixed_edge_histogram(spark, sf):
    return stats.fixed_histogram(table(spark, sf, "lineitem"), "l_quantity", _EDGES)


@query(
    """
with c as (select l_suppkey, l_linenumber, count(*) as n from lineitem group by all)
select l_suppkey, arg_min(l_linenumber, (-n, l_linenumber)) as mode, max(n) as n from c group by l_suppkey"""
)
def dominant_value(spark, sf):
    return stats.mode_smallest(table(spark, sf, "lineitem"), ["l_suppkey"], "l_linenumber")


@query(
    """
with e as (select user_id, value, radians((props ->> '$.k')::double * 3.6) as ang from events)
select user_id, round(atan2(sum(value * sin(ang)), sum(value * cos(ang))), 6) as mean_angle from e group by user_id"""
)
def circular_mean(spark, sf):
    e = events(spark, sf).select("user_id", "value", F.radians(F.get_json_object("props", "$.k").cast("double") * 3.6).alias("ang"))
    return stats.circular_mean(e, ["user_id"], "ang", "value").select("user_id", r6("mean_angle").alias("mean_angle"))


@query(
    """
with e as (select label, embedding[1]::double as x, embedding[2]::double as y from embeddings)
select label, count(*) as n, round(stddev_pop(x), 6) as x_std, round(stddev_pop(y), 6) as y_std, round(quantile_cont(x, 0.5), 6) as x_median,
round(quantile_cont(y, 0.5), 6) as y_median from e group by label"""
)
def median_fusion(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    m = stats.median_fusion(e, ["label"], ["x", "y"])
    return m.select("label", "n", *[r6(c).alias(c) for c in ("x_std", "y_std", "x_median", "y_median")])


@query(
    """
select l_linenumber as bin, count(*) as n, round(sqrt(avg(least(l_quantity, 30) ** 2)), 6) as rms_clipped, round(quantile_cont(l_quantity, 0.5), 6) as median_err
from lineitem group by l_linenumber having count(*) >= 50"""
)
def binned_errors(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_linenumber", "bin")
    b = stats.binned_errors(li, "bin", "l_quantity", 30.0, 50)
    return b.select("bin", "n", r6("rms_clipped").alias("rms_clipped"), r6("median_err").alias("median_err"))


@query(
    """
select l_returnflag, round(sum(9.0 * ln(1 + (l_quantity / 3) ** 2)), 3) as cost, round(sum(1 / (1 + (l_quantity / 3) ** 2)), 6) as w_cauchy,
round(sum(case when l_quantity <= 3 then 1 else 3 / l_quantity end), 6) as w_huber from lineitem group by l_returnflag"""
)
def robust_sums(spark, sf):
    q = F.col("l_quantity")
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(stats.cauchy_cost(q, 3.0)).alias("cost"), F.sum(stats.cauchy_weight(q, 3.0)).alias("w_cauchy"), F.sum(stats.huber_weight(q, 3.0)).alias("w_huber")
    )
    return g.select("l_returnflag", F.round("cost", 3).alias("cost"), r6("w_cauchy").alias("w_cauchy"), r6("w_huber").alias("w_huber"))


@query(
    """
with x as (select user_id, event_type, min(epoch_us(ts)) as f, max(epoch_us(ts)) as l, count(*) as n from events group by all)
select user_id, event_type, n, round(case when n >= 2 and l > f then (n - 1) * 1e6 / (l - f) else 0 end, 9) as rate from x"""
)
def average_rate(spark, sf):
    a = stats.average_rate(events(spark, sf), ["user_id", "event_type"], "at", _T)
    return a.select("user_id", "event_type", "n", F.round("rate", 9).alias("rate"))


@query("select event_type, min(epoch_us(ts)) as first_at, max(epoch_us(ts)) as last_at, count(*) as n from events group by event_type")
def recording_spans(spark, sf):
    return stats.extents(events(spark, sf), ["event_type"], "at")


@query(
    """
with x as (select user_id, event_type, count(*) as n, min(epoch_us(ts)) as f, max(epoch_us(ts)) as l from events group by all),
d as (select user_id, event_type, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id, event_type order by ts) as dt from events),
g as (select user_id, event_type, max(dt) as gap from d group by all),
t as (select distinct user_id from events),
r as (select unnest(['click', 'view', 'purchase', 'signup', 'error']) as event_type),
k as (select user_id, event_type, coalesce(n, 0) as n, coalesce(gap, 0) as gap from t cross join r left join x using (user_id, event_type) left join g using (user_id, event_type)),
f as (select user_id, 2 as lvl, 'missing ' || event_type as reason from k where n = 0
 union all select user_id, 2, 'gap ' || event_type from k where event_type = 'error' and gap > 864000000000
 union all select user_id, 1, 'gap ' || event_type from k where event_type = 'click' and gap > 432000000000
 union all select user_id, 1, 'few ' || event_type from k where n between 1 and 9),
v as (select user_id, max(lvl) as lvl, string_agg(reason, '; ' order by reason) as reasons from f group by user_id)
select user_id, case coalesce(lvl, 0) when 2 then 'DROP' when 1 then 'MARGINAL' else 'PASS' end as verdict, coalesce(reasons, '') as reasons
from t left join v using (user_id)"""
)
def verdict_rules(spark, sf):
    e = events(spark, sf).select("user_id", "event_type", "at")
    required = ["click", "view", "purchase", "signup", "error"]
    return screening_verdicts(
        e, ["user_id"], "event_type", "at", required, width(spark, sf, "user_id"),
        drop_gap={"error": 10 * DAY}, warn_gap={"click": 5 * DAY}, few=10,
    )


@query(
    """
with q as (select user_id, epoch_us(ts) as at from events where event_type = 'click'),
t as (select user_id, event_type, epoch_us(ts) as tat from events where event_type <> 'click'),
c as (select unnest(['view', 'purchase', 'signup', 'error']) as event_type),
qq as (select q.*, event_type from q, c),
lo as (select qq.*, t.tat as a from qq asof left join t on qq.user_id = t.user_id and qq.event_type = t.event_type and qq.at >= t.tat),
hi as (select qq.*, t.tat as b from qq asof left join t on qq.user_id = t.user_id and qq.event_type = t.event_type and qq.at <= t.tat),
d as (select event_type, least(coalesce(at - a, 9e18::bigint), coalesce(b - at, 9e18::bigint)) as d from lo join hi using (user_id, at, event_type) where a is not null or b is not null)
select event_type, round(quantile_cont(d, 0.5) / 1e3, 3) as p50_ms, round(quantile_cont(d, 0.99) / 1e3, 3) as p99_ms, count(*) filter (d > 21600000000) as over, count(*) as n
from d group by event_type"""
)
def sync_deviation(spark, sf):
    from trackloom.operators.asof import nearest
    from trackloom.session import stage

    e = events(spark, sf).select("user_id", "event_type", "at")
    channels = F.array(*[F.lit(c) for c in ("view", "purchase", "signup", "error")])
    q = e.where("event_type = 'click'").select("user_id", "at", F.explode(channels).alias("event_type"))
    t = e.where("event_type <> 'click'")
    d = stage(nearest(q, t, ["user_id", "event_type"], "at", [], width(spark, sf, "user_id", "event_type")).where("match is not null"), "sync")
    base = d.groupBy("event_type").agg(F.count_if(F.col("distance") > 6 * 3_600_000_000).alias("over"), F.count(F.lit(1)).alias("n"))
    p = stats.quantiles(d, ["event_type"], "distance", {"p50": 0.5, "p99": 0.99})
    return base.join(p, "event_type").select("event_type", F.round(F.col("p50") / 1e3, 3).alias("p50_ms"), F.round(F.col("p99") / 1e3, 3).alias("p99_ms"), "over", "n")


# Roles: user = recording, click = anchor, view and purchase = cameras, signup = pose, error = odometry. Streams of some
# users are taken away or shifted so that every rule is broken by somebody.
_SCREEN = ScreenRules(
    required=("click", "view", "purchase", "signup"), cameras=("view", "purchase"), anchor="click", pose="signup", odometry="error",
    ticks=1_000_000, nominal_hz=5e-6, off_clock=20 * DAY, margin=DAY, max_anchor_gap=8 * DAY, max_pose_gap=9 * DAY, max_cut=8 * DAY,
    max_bad_run=6 * DAY, good="view", max_bad_share=0.75, min_scene_share=0.3,
)
_SCREEN_FRAMES = f"""
with raw as (select user_id, event_type, epoch_us(ts) as at from events),
fr as (select user_id, event_type, case when user_id % 17 = 3 and event_type = 'purchase' then at + {100 * DAY} else at end as at from raw
 where not (user_id % 13 = 5 and event_type = 'signup') and not (user_id % 13 = 5 and user_id % 2 = 0 and event_type = 'error')
 and user_id % 41 <> 7 and not (user_id % 19 = 4 and event_type = 'view' and at > (select min(at) from raw) + {3 * DAY})
 and not (user_id % 19 = 4 and event_type = 'click' and at < (select min(at) from raw) + {6 * DAY})),
rec as (select user_id, min(at) as started from raw group by user_id),
st as (select user_id, event_type, min(at) as f, max(at) as l, count(*) as n, any_value(started) as started from fr join rec using (user_id) group by all),
req as (select unnest(['click', 'view', 'purchase', 'signup']) as event_type),
state as (select rec.user_id, req.event_type, st.n, st.f, st.l, st.started from rec cross join req left join st on st.user_id = rec.user_id and st.event_type = req.event_type),
ok as (select user_id, event_type from st where event_type <> 'error' and abs(f - started) <= {20 * DAY}),
us as (select fr.* from fr join ok using (user_id, event_type)),
gap as (select user_id, event_type, max(dt) as gap from (select *, at - lag(at) over (partition by user_id, event_type order by at) as dt from us) where dt is not null group by all),
e2 as (select user_id, event_type, min(at) as f, max(at) as l from us group by all),
win as (select user_id, max(f) + {DAY} as a, min(l) - {DAY} as b, min(f) as e, max(l) as t from e2 group by user_id),
del as (select user_id, min(n * 1000000 / ((l - f) * 5e-6)) as worst from st where event_type in ('view', 'purchase') and abs(f - started) <= {20 * DAY} and n >= 10 group by user_id),
g as (select user_id, at, event_type <> 'view' as bad from raw),
h as (select *, case when lag(bad) over w is null or lag(bad) over w <> bad then 1 else 0 end as s from g window w as (partition by user_id order by at)),
k as (select *, sum(s) over (partition by user_id order by at) as run from h),
c as (select user_id, run, min(at) as ra, max(at) as rb from k where bad group by all),
lng as (select c.user_id, max(rb - ra) as run from c join win using (user_id) where rb >= a and ra <= b group by c.user_id),
shr as (select g.user_id, avg(case when bad then 1.0 else 0.0 end) as bad, any_value(run) as run from g left join lng using (user_id) group by g.user_id),
sc as (select user_id, n * {2 * DAY} as scene_time from (select user_id, count(*) // 20 as n from raw group by user_id)),
found as (
select user_id, 2 as level, 'no streams' as rule, '' as subject from rec where user_id not in (select user_id from st)
union all select user_id, 2, 'off clock', event_type from st where abs(f - started) > {20 * DAY}
union all select user_id, 2, 'missing', event_type from state where n is null and not (event_type = 'signup' and user_id in (select user_id from st where event_type = 'error'))
union all select user_id, 1, 'odometry only', event_type from state where n is null and event_type = 'signup' and user_id in (select user_id from st where event_type = 'error')
union all select user_id, 1, 'anchor gap', event_type from gap where event_type = 'click' and gap > {8 * DAY}
union all select user_id, 2, 'pose gap', event_type from gap where event_type = 'signup' and gap > {9 * DAY}
union all select user_id, case when worst >= 0.9 then 1 else 2 end, 'camera delivery', '' from del where worst < 0.98
union all select user_id, 2, 'no common window', '' from win where b <= a
union all select user_id, 1, 'window cut', '' from win where b > a and (a - e) + (t - b) > {8 * DAY}
union all select user_id, 2, 'bad status run', '' from shr where coalesce(run, -1) >= {6 * DAY}
union all select user_id, 1, 'bad status share', '' from shr where coalesce(run, -1) < {6 * DAY} and bad > 0.75
union all select win.user_id, 1, 'few scenes', '' from win left join sc using (user_id) where b > a and coalesce(scene_time, 0) < 0.3 * (b - a))
"""


def _screened(spark, sf):
    e = events(spark, sf).select("user_id", "event_type", "at")
    start = e.agg(F.min("at")).first()[0] or 0
    is_type = lambda t: F.col("event_type") == t
    u = F.col("user_id")
    taken = (
        (u % 13 == 5) & is_type("signup") | (u % 13 == 5) & (u % 2 == 0) & is_type("error") | (u % 41 == 7)
        | (u % 19 == 4) & is_type("view") & (F.col("at") > start + 3 * DAY) | (u % 19 == 4) & is_type("click") & (F.col("at") < start + 6 * DAY)
    )
    shifted = F.when((u % 17 == 3) & is_type("purchase"), F.col("at") + 100 * DAY).otherwise(F.col("at"))
    frames = e.where(~taken).withColumn("at", shifted)
    recordings = e.groupBy("user_id").agg(F.min("at").alias("started"))
    scenes = e.groupBy("user_id").agg((F.expr("count(1) div 20") * (2 * DAY)).alias("scene_time"))
    status = e.select("user_id", "at", F.col("event_type").alias("status"))
    return recordings, findings(frames, recordings, status, scenes, ["user_id"], "event_type", "at", _SCREEN, width(spark, sf, "user_id", "event_type"))


@query(_SCREEN_FRAMES + "select user_id, level, rule, subject from found")
def screening_findings(spark, sf):
    return _screened(spark, sf)[1]


@query(
    _SCREEN_FRAMES
    + """, v as (select user_id, max(level) as lvl, string_agg(distinct reason, '; ' order by reason) as reasons from (select user_id, level, trim(rule || ' ' || subject) as reason from found) group by user_id)
select user_id, case coalesce(lvl, 0) when 2 then 'DROP' when 1 then 'MARGINAL' else 'PASS' end as verdict, coalesce(reasons, '') as reasons from rec left join v using (user_id)"""
)
def screening_verdict(spark, sf):
    recordings, found = _screened(spark, sf)
    reasons = found.select("user_id", "level", F.trim(F.concat_ws(" ", "rule", "subject")).alias("reason"))
    return verdicts(recordings, ["user_id"], reasons)
