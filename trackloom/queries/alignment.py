"""Alignment of event streams: as-of joins, bursts, segments, scenes, yield."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from trackloom.operators import asof, segments
from trackloom.operators.coverage import coverage_window as window_of
from trackloom.operators.intervals import interval_join
from trackloom.plans import scene_yield as sy
from trackloom.session import stage
from trackloom.queries.registry import DAY, HOUR, events, query, r6, table, width

_QT = """
with q as (select user_id, epoch_us(ts) as at from events where event_type = 'click'),
t as (select user_id, epoch_us(ts) as tat, value from events where event_type = 'view'),
lo as (select q.user_id, q.at, t.tat as lo_at, t.value as lo_v from q asof left join t on q.user_id = t.user_id and q.at >= t.tat),
hi as (select q.user_id, q.at, t.tat as hi_at, t.value as hi_v from q asof left join t on q.user_id = t.user_id and q.at <= t.tat),
b as (select lo.*, hi_at, hi_v from lo join hi using (user_id, at)),
near as (select user_id, at,
  case when lo_at is not null and (hi_at is null or at - lo_at <= hi_at - at) then lo_at else hi_at end as match_at,
  case when lo_at is not null and (hi_at is null or at - lo_at <= hi_at - at) then lo_v else hi_v end as match_value from b)
"""


def _clicks_and_views(spark, sf):
    e = events(spark, sf)
    return e.where("event_type = 'click'").select("user_id", "at"), e.where("event_type = 'view'").select("user_id", "at", "value")


@query(_QT + "select user_id, at, match_at, match_value, abs(at - match_at) as distance from near")
def nearest_asof(spark, sf):
    q, t = _clicks_and_views(spark, sf)
    n = asof.nearest(q, t, ["user_id"], "at", ["value"], width(spark, sf, "user_id"))
    return n.select("user_id", "at", F.col("match.at").alias("match_at"), F.col("match.value").alias("match_value"), "distance")


@query(
    _QT.replace("at - lo_at <= hi_at - at", "at - lo_at < hi_at - at")
    + "select user_id, at, match_at, abs(at - match_at) as distance from near"
)
def nearest_later_on_tie(spark, sf):
    q, t = _clicks_and_views(spark, sf)
    n = asof.nearest(q, t, ["user_id"], "at", ["value"], width(spark, sf, "user_id"), later_wins=True)
    return n.select("user_id", "at", F.col("match.at").alias("match_at"), "distance")


@query(
    _QT
    + f""", within as (select * from near where abs(at - match_at) <= {6 * HOUR})
select user_id, max(at) as at, match_at, min(match_value) as match_value from within group by user_id, match_at"""
)
def nearest_asof_tolerance(spark, sf):
    q, t = _clicks_and_views(spark, sf)
    n = asof.nearest_within(q, t, ["user_id"], "at", ["value"], width(spark, sf, "user_id"), 6 * HOUR, [])
    return n.select("user_id", "at", F.col("match.at").alias("match_at"), F.col("match.value").alias("match_value"))


@query(
    """
with q as (select event_id, user_id, epoch_us(ts) as at from events where event_type <> 'purchase'),
t as (select user_id, epoch_us(ts) as tat from events where event_type = 'purchase'),
f as (select q.*, t.tat from q asof left join t on q.user_id = t.user_id and q.at <= t.tat),
l as (select user_id, max(tat) as last_at from t group by user_id)
select event_id, f.user_id, at, coalesce(tat, last_at) as sample_at from f left join l on f.user_id = l.user_id"""
)
def forward_asof(spark, sf):
    e = events(spark, sf)
    q = e.where("event_type <> 'purchase'").select("event_id", "user_id", "at")
    t = e.where("event_type = 'purchase'").select("user_id", "at")
    f = asof.forward(q, t, ["user_id"], "at", [], width(spark, sf, "user_id"))
    return f.select("event_id", "user_id", "at", F.col("match.at").alias("sample_at"))


_BURSTS = f"""
with f as (select event_type, epoch_us(ts) as at from events where event_type in ('view', 'purchase', 'signup')),
g as (select *, case when at - lag(at) over (order by at, event_type) > {HOUR // 4} then 1 else 0 end as s from f),
h as (select *, sum(s) over (order by at, event_type rows unbounded preceding) as burst from g),
inst as (select min(at) as at, max(case when event_type = 'view' then at end) as view,
  max(case when event_type = 'purchase' then at end) as purchase,
  max(case when event_type = 'signup' then at end) as signup from h group by burst)
"""
_GATING = ["view", "purchase", "signup"]


@query(_BURSTS + "select at, view, purchase, signup from inst")
def burst_instants(spark, sf):
    e = events(spark, sf).select("at", "event_type")
    return segments.burst_instants(e, [], "at", "event_type", _GATING, HOUR // 4, width(spark, sf))


def _dev(side):
    return f"greatest(abs({side}.view - q.at), abs({side}.purchase - q.at), abs({side}.signup - q.at))"


_CHOSEN = (
    _BURSTS
    + f""", c as (select * from inst where view is not null and purchase is not null and signup is not null),
q as (select epoch_us(ts) as at from events where event_type = 'click'),
lo as (select q.at, c.at as i, {_dev('c')} as dev, c.view, c.purchase, c.signup from q asof left join c on q.at > c.at),
hi as (select q.at, c.at as i, {_dev('c')} as dev, c.view, c.purchase, c.signup from q asof left join c on q.at <= c.at),
cand as (select *, 0 as side from lo where dev <= {{sync}} union all select *, 1 as side from hi where dev <= {{sync}}),
best as (select * from (select *, row_number() over (partition by at order by dev, side) as rn from cand) where rn = 1),
chosen as (select q.at, best.i as instant, best.dev, best.view, best.purchase, best.signup from q left join best on q.at = best.at)
"""
)
_SYNC = HOUR


@query(_CHOSEN.format(sync=_SYNC) + "select at, instant, dev, view, purchase, signup from chosen")
def complete_set_asof(spark, sf):
    e = events(spark, sf).select("at", "event_type")
    inst = segments.burst_instants(e, [], "at", "event_type", _GATING, HOUR // 4, width(spark, sf))
    whole = stage(segments.complete_only(inst, _GATING), "instants")
    q = e.where("event_type = 'click'").select("at")
    c = asof.complete_set(q, whole, [], "at", _GATING, _SYNC, width(spark, sf))
    return c.select("at", "instant", "dev", *_GATING)


@query(
    f"""
with e as (select user_id, event_type, min(epoch_us(ts)) as f, max(epoch_us(ts)) as l,
  case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end as r
  from events group by user_id, event_type)
select user_id, max(f) + {HOUR} as start_at, min(l) - {HOUR} as end_at, min(f) as earliest, max(l) as latest,
  arg_min(event_type, (-f, r)) as last_start, arg_min(event_type, (l, r)) as first_end,
  max(f) + {HOUR} - min(f) as head_cut, max(l) - (min(l) - {HOUR}) as tail_cut
from e group by user_id"""
)
def coverage_window(spark, sf):
    e = events(spark, sf)
    return window_of(e, ["user_id"], "at", "event_type", ["click", "view", "purchase", "signup", "error"], HOUR)


_SEGMENTS = f"""
with e as (select user_id, epoch_us(ts) as at, event_type <> 'error' as ok from events),
g as (select *, case when lag(at) over w is null or lag(ok) over w <> ok or at - lag(at) over w > {DAY} then 1 else 0 end as s
  from e window w as (partition by user_id order by at)),
h as (select *, sum(s) over (partition by user_id order by at) as run from g),
v as (select *, row_number() over (partition by user_id, run order by at) as place,
  dense_rank() over (partition by user_id order by run) as segment, count(*) over (partition by user_id, run) as len
  from h where ok)
"""


@query(_SEGMENTS + "select user_id, at, segment, place from v")
def gap_segments(spark, sf):
    e = events(spark, sf).select("user_id", "at", (F.col("event_type") != "error").alias("ok"))
    return segments.segments(e, ["user_id"], "at", "ok", DAY, width(spark, sf, "user_id")).select("user_id", "at", "segment", "place")


@query(
    _SEGMENTS
    + """select user_id, at, segment, case when (place - 1) // 5 < len // 5 then (place - 1) // 5 end as scene_no from v"""
)
def fixed_scenes(spark, sf):
    e = events(spark, sf).select("user_id", "at", (F.col("event_type") != "error").alias("ok"))
    runs = segments.segments(e, ["user_id"], "at", "ok", DAY, width(spark, sf, "user_id"))
    return segments.fixed_scenes(runs, 5).select("user_id", "at", "segment", "scene_no")


_PARAMS = sy.YieldParams(
    anchor="click", gating=("view", "purchase", "signup"), pose="error", sync=_SYNC, group_gap=HOUR // 4,
    scene_length=2 * HOUR, ticks=1_000_000, span=DAY, channel="event_type",
)


def params(spark, sf) -> sy.YieldParams:
    """The rules of the recording below, with the block width its density asks for."""
    return replace(_PARAMS, span=width(spark, sf))


def recording(spark, sf):
    """All events as one recording: the most skewed case, one key holds every frame."""
    return events(spark, sf).select(F.lit("all").alias("log"), "event_type", "at")


_YIELD = (
    _CHOSEN
    + f""",
d as (select at - lag(at) over (order by at) as dt from q),
p as (select quantile_cont(dt, 0.5) as period from d where dt is not null),
x as (select event_type, min(epoch_us(ts)) as f, max(epoch_us(ts)) as l from events group by event_type),
w as (select max(f) + {_SYNC} as s, min(l) - {_SYNC} as e from x),
pl as (select c.*, c.at between w.s and w.e as in_window, c.at between w.s and w.e and c.instant is not null as valid, p.period,
  cast(round_even({2 * HOUR} / p.period, 0) as bigint) as n, cast(floor(1.5 * p.period) as bigint) as max_gap from chosen c, w, p),
yg as (select *, case when lag(at) over w is null or lag(valid) over w <> valid or at - lag(at) over w > max_gap then 1 else 0 end as st
  from pl window w as (order by at)),
hh as (select *, sum(st) over (order by at) as run from yg),
v as (select *, row_number() over (partition by run order by at) as place, count(*) over (partition by run) as len,
  dense_rank() over (order by run) as segment from hh where valid),
cut as (select at, segment, place, case when (place - 1) // n < len // n then (place - 1) // n end as scene_no, n from v),
cat as (select pl.*, case when not in_window then 'window' when not valid then 'camera' when cut.scene_no is not null then 'scene'
  else 'short' end as category from pl left join cut using (at))
"""
)


@query(
    _YIELD.format(sync=_SYNC)
    + """select 'all' as log, category, count(*) as frames, round(count(*) * any_value(period) / 1000000, 6) as seconds from cat group by category
union all select 'all', 'anchor_gap', count(*), round(sum(dt - period) / 1000000, 6) from d, p where dt > 1.5 * period"""
)
def scene_yield(spark, sf):
    f = recording(spark, sf)
    y = sy.yield_report(f, params(spark, sf))
    return y.select("log", "category", "frames", r6("seconds").alias("seconds"))


@query(
    _YIELD.format(sync=_SYNC)
    + """, lost as (select at from pl where in_window and instant is null),
a as (select lost.at, inst.at as i, inst.view, inst.purchase, inst.signup from lost asof left join inst on lost.at >= inst.at),
b as (select lost.at, inst.at as i, inst.view, inst.purchase, inst.signup from lost asof left join inst on lost.at <= inst.at),
nn as (select a.at, a.i is not null and (b.i is null or a.at - a.i <= b.i - a.at) as left_one, a.view as av, a.purchase as ap,
  a.signup as asu, b.view as bv, b.purchase as bp, b.signup as bs from a join b using (at)),
m as (select case when left_one then av else bv end as view, case when left_one then ap else bp end as purchase,
  case when left_one then asu else bs end as signup from nn)
select 'all' as log, channel, frames_lost from (
  select 'view' as channel, count(*) filter (view is null) as frames_lost from m union all
  select 'purchase', count(*) filter (purchase is null) from m union all
  select 'signup', count(*) filter (signup is null) from m) where frames_lost > 0"""
)
def camera_blame(spark, sf):
    f = recording(spark, sf)
    p = params(spark, sf)
    return sy.camera_blame(f, sy.plan_frames(f, p), p)


def _at_tolerance(tol):
    return (
        "select * from ("
        + _YIELD.format(sync=tol)
        + f""" select 'all' as log, {tol} as tolerance, (select count(*) from pl where in_window) as in_window,
(select count(*) from pl where valid) as valid, (select coalesce(max(segment) - 1, 0) from cut) as breaks,
(select coalesce(count(scene_no) // max(n), 0) from cut) as scenes)"""
    )


_TOLERANCES = [HOUR // 2, HOUR, 2 * HOUR]


@query(
    "select log, cast(tolerance as bigint) as tolerance, in_window, valid, breaks, cast(scenes as bigint) as scenes from ("
    + " union all ".join(_at_tolerance(t) for t in _TOLERANCES)
    + ")"
)
def yield_by_tolerance(spark, sf):
    y = sy.yield_at_tolerances(recording(spark, sf), params(spark, sf), _TOLERANCES)
    return y.select("log", F.col("tolerance").cast("long").alias("tolerance"), "in_window", "valid", F.col("breaks").cast("long").alias("breaks"), "scenes")


@query(
    """
with q as (select user_id, epoch_us(ts) as at from events where event_type = 'click'),
t as (select user_id, epoch_us(ts) as tat, value from events where event_type = 'view'),
lo as (select q.user_id, q.at, t.tat as a, t.value as va from q asof left join t on q.user_id = t.user_id and q.at >= t.tat),
hi as (select q.user_id, q.at, t.tat as b, t.value as vb from q asof left join t on q.user_id = t.user_id and q.at <= t.tat)
select user_id, at, round(case when a is null then vb when b is null then va when b = at then vb
  else va + (at - a) / (b - a) * (vb - va) end, 6) as value from lo join hi using (user_id, at)"""
)
def interp_value(spark, sf):
    q, t = _clicks_and_views(spark, sf)
    i = asof.interpolate(q, t, ["user_id"], "at", ["value"], width(spark, sf, "user_id"))
    return i.select("user_id", "at", r6("value").alias("value"))


_QUATS = """
with e as (select label, vec_id * 10 as at, embedding[1]::double as a, embedding[2]::double as b, embedding[3]::double as c, embedding[4]::double as d from embeddings),
p as (select label, at, a / sqrt(a*a+b*b+c*c+d*d) as qw, b / sqrt(a*a+b*b+c*c+d*d) as qx, c / sqrt(a*a+b*b+c*c+d*d) as qy,
  d / sqrt(a*a+b*b+c*c+d*d) as qz from e)
"""


def poses_of(spark, sf):
    e = table(spark, sf, "embeddings")
    c = [F.col("embedding")[i].cast("double") for i in range(4)]
    n = F.sqrt(c[0] * c[0] + c[1] * c[1] + c[2] * c[2] + c[3] * c[3])
    return e.select("label", (F.col("vec_id") * 10).alias("at"), *[(x / n).alias(q) for x, q in zip(c, ("qw", "qx", "qy", "qz"))],
                    *[F.col("embedding")[4 + i].cast("double").alias(a) for i, a in enumerate("xyz")])


@query(
    _QUATS
    + """, j as (select label, at + 3 as at, qw, qx, qy, qz, lead(at) over w as b, lead(qw) over w as bw, lead(qx) over w as bx,
  lead(qy) over w as by_, lead(qz) over w as bz, at as a from p window w as (partition by label order by at)),
k as (select *, qw*bw + qx*bx + qy*by_ + qz*bz as dot, (at - a) / (b - a) as s from j),
l as (select *, acos(least(abs(dot), 1.0)) as th, case when dot < 0 then -1.0 else 1.0 end as sg from k),
m as (select *, case when abs(dot) > 1 - 1e-12 then 1 - s else sin((1 - s) * th) / sin(th) end as wa,
  case when abs(dot) > 1 - 1e-12 then s else sin(s * th) / sin(th) end * sg as wb from l),
z as (select label, at, b, qw as ow, qx as ox, qy as oy, qz as oz, wa*qw + wb*bw as w, wa*qx + wb*bx as x, wa*qy + wb*by_ as y, wa*qz + wb*bz as z from m)
select label, at, round(case when b is null then ow else w / sqrt(w*w+x*x+y*y+z*z) end, 6) as qw,
  round(case when b is null then ox else x / sqrt(w*w+x*x+y*y+z*z) end, 6) as qx,
  round(case when b is null then oy else y / sqrt(w*w+x*x+y*y+z*z) end, 6) as qy,
  round(case when b is null then oz else z / sqrt(w*w+x*x+y*y+z*z) end, 6) as qz from z"""
)
def slerp_pose(spark, sf):
    poses = poses_of(spark, sf)
    q = poses.select("label", (F.col("at") + 3).alias("at"))
    out = asof.interpolate_pose(q, poses, ["label"], "at", 1000, outside="hold")
    return out.select("label", "at", *[r6(c).alias(c) for c in ("qw", "qx", "qy", "qz")])


@query(
    f"""
select o_orderkey, l_orderkey, l_linenumber, epoch_us(l_shipdate) as ship_at, count(*) as copies
from (select distinct o_orderkey, o_custkey, epoch_us(o_orderdate) as s, epoch_us(o_orderdate) + {30 * DAY} as e from orders) o
join (select l_orderkey, l_linenumber, l_shipdate, o_custkey from lineitem join orders on l_orderkey = o_orderkey) l
on o.o_custkey = l.o_custkey and epoch_us(l_shipdate) between s - {5 * DAY} and e + {5 * DAY}
group by all"""
)
def interval_fanout(spark, sf):
    from trackloom.functions.clock import as_micros

    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", as_micros("o_orderdate").alias("s"))
    spans = o.withColumn("e", F.col("s") + 30 * DAY)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", as_micros("l_shipdate").alias("ship_at"))
    msgs = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    j = interval_join(msgs, spans, ["o_custkey"], "ship_at", "s", "e", ["l_orderkey", "l_linenumber"], 40 * DAY, 5 * DAY)
    return j.groupBy("o_orderkey", "l_orderkey", "l_linenumber", "ship_at").agg(F.count(F.lit(1)).alias("copies"))
