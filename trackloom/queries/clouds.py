"""Neighbours in space and organized clouds: embeddings as points of a place each, events as returns of one sweep per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions.clock import as_micros
from trackloom.operators import neighbours, organized
from trackloom.queries.registry import query, r6, table

_K, _RADIUS = 8, 0.4
_NEAR = f"""
with p as (select vec_id, label, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y, cast(embedding[3] as double) as z from embeddings),
n as (
  select a.label, a.vec_id as query, b.vec_id as point, b.x - a.x as dx, b.y - a.y as dy, b.z - a.z as dz,
    (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z) as d2
  from p a join p b on a.label = b.label
), k as (select *, row_number() over (partition by query order by d2, point) as rank from n where d2 < {_RADIUS} * {_RADIUS})
"""


def _near(spark, sf):
    p = table(spark, sf, "embeddings").select("vec_id", "label", *(F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")))
    return neighbours.nearest(p, p.withColumnRenamed("vec_id", "query"), ["label"], "vec_id", "query", _K, _RADIUS)


@query(_NEAR + f"select label, query, cast(rank as integer) as rank, point, round(sqrt(d2), 6) as d from k where rank <= {_K}")
def nearest_points(spark, sf):
    return _near(spark, sf).select("label", "query", "rank", F.col("vec_id").alias("point"), r6("d").alias("d"))


@query(
    _NEAR
    + f""", s as (
  select label, query, avg(dx) as cx, avg(dy) as cy, avg(dz) as cz, sum(dx * dx) / {_K} as xx, sum(dx * dy) / {_K} as xy, sum(dx * dz) / {_K} as xz,
    sum(dy * dy) / {_K} as yy, sum(dy * dz) / {_K} as yz, sum(dz * dz) / {_K} as zz
  from k where rank <= {_K} group by label, query having count(*) = {_K}
), c as (select label, query, xx - cx * cx as xx, xy - cx * cy as xy, xz - cx * cz as xz, yy - cy * cy as yy, yz - cy * cz as yz, zz - cz * cz as zz from s),
m as (select *, (xx + yy + zz) / 3 as q from c),
p2 as (select *, sqrt(((xx - q) ** 2 + (yy - q) ** 2 + (zz - q) ** 2 + 2 * (xy * xy + xz * xz + yz * yz)) / 6) as s from m),
r as (
  select *, acos(greatest(-1.0, least(1.0, case when s > 0 then ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz))
    / (2 * s * s * s) else 0 end))) / 3 as a from p2
), w as (select label, query, q + 2 * s * cos(a) as w2, q + 2 * s * cos(a + 2 * pi() / 3) as w0, 3 * q as t from r)
select label, query, round(w0, 6) as w0, round(t - w0 - w2, 6) as w1, round(w2, 6) as w2, round((t - 2 * w0 - w2) / greatest(w2, 1e-12), 4) as planarity from w"""
)
def fitted_planes(spark, sf):
    fitted = neighbours.planes(_near(spark, sf), ["label"], "query", _K)
    return fitted.select("label", "query", *(r6(c).alias(c) for c in ("w0", "w1", "w2")), F.round("planarity", 4).alias("planarity"))


#: a sweep of 30 days in 400 columns, five lasers ten minutes apart
_WIDTH, _SWEEP = 400, 2_592_000.0
_TYPES = ["click", "view", "purchase", "signup", "error"]
_GRID = [(4 - i, i, 600.0 * (4 - i)) for i in range(5)]


@query(
    f"""
with e as (
  select user_id, event_id, epoch_us(ts) / 1e6 as t, 4 - list_position({_TYPES}, event_type) + 1 as row, min(epoch_us(ts)) over () / 1e6 as stamp from events
), b as (select *, t - 600.0 * row as base from e),
n as (select *, case when base - lag(base) over (partition by user_id order by base) > {_SWEEP / _WIDTH / 2} then 1 else 0 end as fresh from b),
c as (select *, sum(fresh) over (partition by user_id order by base rows unbounded preceding) as place from n),
m as (select user_id, place, median(base) as med, min(stamp) as stamp, count(*) over (partition by user_id) as k from c group by user_id, place),
x as (
  select *, case when k < {_WIDTH} then greatest(coalesce(cast(round_even((lead(med) over w - med) / {_SWEEP / _WIDTH}, 0) as bigint) - 1, 0), 0) else 0 end as extra,
    case when k < {_WIDTH} then greatest(cast(round_even((first(med) over w - stamp) / {_SWEEP / _WIDTH}, 0) as bigint), 0) else 0 end as lead
  from m where k <= {_WIDTH} window w as (partition by user_id order by place)
), o as (select *, greatest(lead + k + sum(extra) over (partition by user_id) - {_WIDTH}, 0) as over, sum(extra) over (partition by user_id) as total from x),
units as (  -- every spare column as a row: its n-th of the gap; the highest n go first, at the same n the earlier gap
  select user_id, place, n, row_number() over (partition by user_id order by n desc, place) <= over as gone from (select user_id, place, over, unnest(range(1, extra + 1)) as n from o)
), l as (select user_id, place, count(*) filter (gone) as lost from units group by user_id, place),
f as (
  select o.user_id, o.place, med, lead - greatest(over - total, 0) + o.place
    + coalesce(sum(extra - coalesce(lost, 0)) over (partition by o.user_id order by o.place rows between unbounded preceding and 1 preceding), 0) as col
  from o left join l on o.user_id = l.user_id and o.place = l.place
), g as (select c.user_id, row, col, t, event_id from c join f on c.user_id = f.user_id and c.place = f.place),
bad as (select distinct user_id from (select user_id from g group by user_id, row, col having count(*) > 1))
select user_id, cast(row as integer) as row, count(*) as returns, cast(min(col) as integer) as first_col, cast(max(col) as integer) as last_col,
  cast(sum(col) as bigint) as cols, cast(sum(event_id) as bigint) as events, {_WIDTH}::bigint as cells
from g where user_id not in (select user_id from bad) group by user_id, row"""
)
def organized_sweeps(spark, sf):
    """Per user and laser the columns its returns came to, of the sweeps that fit the grid."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", (as_micros("ts") / 1e6).alias("t"))
    start = e.agg(F.min("t")).first()[0] or 0.0
    ring = F.array_position(F.array(*(F.lit(t) for t in _TYPES)), F.col("event_type")).cast("int") - 1
    e = e.select("user_id", "event_id", ring.alias("ring"), F.lit(start).alias("stamp"), (F.col("t") - start).alias("t"))
    cells, _ = organized.organize(e, _GRID, ["user_id"], "stamp", "ring", "t", ["event_id"], _WIDTH, _SWEEP)
    hit = F.col("event_id").isNotNull()
    per = cells.groupBy("user_id", "row").agg(
        F.count_if(hit).alias("returns"), F.min(F.when(hit, F.col("col"))).alias("first_col"), F.max(F.when(hit, F.col("col"))).alias("last_col"),
        F.sum(F.when(hit, F.col("col"))).alias("cols"), F.sum("event_id").alias("events"), F.count("*").alias("cells"),
    )
    return per.where("returns > 0")
