"""Geometry, cells, boxes and scalar functions on columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions import boxes as bx
from trackloom.functions import camera, clock, geodesy, rotation, text
from trackloom.operators import detections, grid
from trackloom.operators.skew import salted_join
from trackloom.queries.registry import DAY, events, query, r6, table

_ORIGIN = (37.20, 126.83, 0.0)


def _latlon(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", (37.2 + F.col("s_nationkey") / 100).alias("lat"), (126.8 + F.col("s_acctbal") / 20000).alias("lon"), (F.col("s_acctbal") / 100).alias("h"))


@query(
    f"""
with p as (select s_suppkey, radians(37.2 + s_nationkey / 100) as la, radians(126.8 + s_acctbal / 20000) as lo, s_acctbal / 100 as h from supplier),
k as (select 6378137.0::double as a, (1 / 298.257223563::double) * (2 - 1 / 298.257223563::double) as e2, radians({_ORIGIN[0]}::double) as la0, radians({_ORIGIN[1]}::double) as lo0),
n as (select *, a / sqrt(1 - e2 * sin(la) ** 2) as n, a / sqrt(1 - e2 * sin(la0) ** 2) as n0 from p, k),
d as (select *, (n + h) * cos(la) * cos(lo) - n0 * cos(la0) * cos(lo0) as dx, (n + h) * cos(la) * sin(lo) - n0 * cos(la0) * sin(lo0) as dy,
  (n * (1 - e2) + h) * sin(la) - n0 * (1 - e2) * sin(la0) as dz from n)
select s_suppkey, round(-sin(lo0) * dx + cos(lo0) * dy, 4) as east, round(-sin(la0) * cos(lo0) * dx - sin(la0) * sin(lo0) * dy + cos(la0) * dz, 4) as north,
round(cos(la0) * cos(lo0) * dx + cos(la0) * sin(lo0) * dy + sin(la0) * dz, 4) as up from d"""
)
def geodetic_enu(spark, sf):
    e, n, u = geodesy.to_enu(F.col("lat"), F.col("lon"), F.col("h"), _ORIGIN)
    return _latlon(spark, sf).select("s_suppkey", F.round(e, 4).alias("east"), F.round(n, 4).alias("north"), F.round(u, 4).alias("up"))


@query("select s_suppkey, round(37.2 + s_nationkey / 100, 7) as lat, round(126.8 + s_acctbal / 20000, 7) as lon from supplier")
def utm_roundtrip(spark, sf):
    x, y = geodesy.to_utm(F.col("lat"), F.col("lon"), 52)
    there = _latlon(spark, sf).select("s_suppkey", x.alias("x"), y.alias("y"))
    la, lo = geodesy.from_utm(F.col("x"), F.col("y"), 52)
    return there.select("s_suppkey", F.round(la, 7).alias("lat"), F.round(lo, 7).alias("lon"))


@query(
    """
with p as (select s_suppkey, radians(37.2 + s_nationkey / 100) as la, radians(126.8 + s_acctbal / 20000) - radians(129.0) as d from supplier),
k as (select *, (1 / 298.257223563::double) * (2 - 1 / 298.257223563::double) as e2, sin(la) as s, cos(la) as c from p),
m as (select *, e2 / (1 - e2) as ep2, 6378137.0::double / sqrt(1 - e2 * s * s) as n, tan(la) ** 2 as t, c * d as a from k),
q as (select *, ep2 * c * c as cc from m)
select s_suppkey, round(0.9996 * n * (a + (1 - t + cc) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * ep2) * a ** 5 / 120) + 500000, 0) as easting,
round(atan(tan(d) * s), 8) as convergence from q"""
)
def utm_easting(spark, sf):
    """Against the classical meridian-arc series, to the metre."""
    x, _ = geodesy.to_utm(F.col("lat"), F.col("lon"), 52)
    g = geodesy.grid_convergence(F.col("lat"), F.col("lon"), 52)
    return _latlon(spark, sf).select("s_suppkey", F.round(x, 0).alias("easting"), F.round(g, 8).alias("convergence"))


@query(
    """select c_custkey, round((c_acctbal / 100 + 180) / 360, 9) as x, round(0.5 - ln((1 + sin(radians(greatest(least(c_acctbal / 60, 85.0), -85.0)))) / (1 - sin(radians(greatest(least(c_acctbal / 60, 85.0), -85.0))))) / (4 * pi()), 9) as y
from customer"""
)
def mercator(spark, sf):
    x, y = geodesy.mercator(F.col("c_acctbal") / 60, F.col("c_acctbal") / 100)
    return table(spark, sf, "customer").select("c_custkey", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"))


_Q = """
with e as (select vec_id, embedding[1]::double as a, embedding[2]::double as b, embedding[3]::double as c, embedding[4]::double as d,
  embedding[5]::double as x, embedding[6]::double as y, embedding[7]::double as z from embeddings),
q as (select vec_id, a / sqrt(a*a+b*b+c*c+d*d) as w, b / sqrt(a*a+b*b+c*c+d*d) as i, c / sqrt(a*a+b*b+c*c+d*d) as j, d / sqrt(a*a+b*b+c*c+d*d) as k, x, y, z from e)
"""


def _unit(spark, sf):
    e = table(spark, sf, "embeddings")
    c = [F.col("embedding")[i].cast("double") for i in range(7)]
    n = F.sqrt(c[0] * c[0] + c[1] * c[1] + c[2] * c[2] + c[3] * c[3])
    return e.select("vec_id", *[(v / n).alias(q) for v, q in zip(c, ("qw", "qx", "qy", "qz"))], *[v.alias(a) for v, a in zip(c[4:], "xyz")])


@query(
    _Q
    + """select vec_id, round((1 - 2*(j*j+k*k))*x + 2*(i*j-w*k)*y + 2*(i*k+w*j)*z, 6) as rx, round(2*(i*j+w*k)*x + (1-2*(i*i+k*k))*y + 2*(j*k-w*i)*z, 6) as ry,
round(2*(i*k-w*j)*x + 2*(j*k+w*i)*y + (1-2*(i*i+j*j))*z, 6) as rz, round(degrees(atan2(2*(w*k+i*j), 1-2*(j*j+k*k))), 5) as yaw,
round(case when w < 0 then -w else w end, 6) as bw, round(case when w < 0 then -i else i end, 6) as bx, round(w*w - i*i - j*j - k*k, 6) as sqw from q"""
)
def quaternion_ops(spark, sf):
    u = _unit(spark, sf)
    q = rotation.quat()
    m = rotation.to_matrix(q)
    r = rotation.rotate(m, (F.col("x"), F.col("y"), F.col("z")))
    flat = u.select("vec_id", *[c.alias(n) for c, n in zip(r, ("rx", "ry", "rz"))], F.degrees(rotation.yaw(q)).alias("yaw"),
                    rotation.multiply(q, q)[0].alias("sqw"), *[m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)])
    back = rotation.from_matrix(tuple(tuple(F.col(f"m{i}{j}") for j in range(3)) for i in range(3)))
    return flat.select("vec_id", *[r6(c).alias(c) for c in ("rx", "ry", "rz")], F.round("yaw", 5).alias("yaw"), r6(back[0]).alias("bw"), r6(back[1]).alias("bx"), r6("sqw").alias("sqw"))


@query(
    """
with a as (select s_suppkey, radians(s_acctbal / 500) as r, radians(s_acctbal / 900) as p, radians(s_nationkey * 14.0) as z from supplier)
select s_suppkey, round(-sin(-z) * cos(p), 6) as fx, round(cos(-z) * cos(p), 6) as fy, round(sin(p), 6) as fz from a"""
)
def receiver_attitude(spark, sf):
    """The car's forward axis in east-north-up."""
    s = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_acctbal") / 500).alias("r"), (F.col("s_acctbal") / 900).alias("p"), (F.col("s_nationkey") * 14.0).alias("z"))
    q = rotation.receiver_attitude(F.col("r"), F.col("p"), F.col("z"))
    flat = s.select("s_suppkey", *[c.alias(n) for c, n in zip(q, ("qw", "qx", "qy", "qz"))])
    f = rotation.rotate(rotation.to_matrix(rotation.quat()), (F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    return flat.select("s_suppkey", *[r6(c).alias(n) for c, n in zip(f, ("fx", "fy", "fz"))])


_K, _FISH, _RAD = (1000.0, 1010.0, 960.0, 540.0), (0.01, -0.002, 0.0005, -0.0001), (-0.3, 0.08, 0.0005, -0.0003, 0.001)
_CAM = """
with p as (select p_partkey, (p_size - 25) / 50.0::double as x, (p_retailprice % 7) / 14.0 as y, 2.0::double as z from part)
"""


def _rays(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", ((F.col("p_size") - 25) / 50.0).alias("x"), ((F.col("p_retailprice") % 7) / 14.0).alias("y"), F.lit(2.0).alias("z"))


@query(
    _CAM
    + """, a as (select *, sqrt(x*x+y*y) as r, atan2(greatest(sqrt(x*x+y*y), 1e-12), z) as th, x/z as u, y/z as v, (x*x+y*y)/(z*z) as r2 from p),
b as (select *, th * (1 + 0.01*th**2 - 0.002*th**4 + 0.0005*th**6 - 0.0001*th**8) / greatest(r, 1e-12) as s, 1 - 0.3*r2 + 0.08*r2*r2 + 0.001*r2*r2*r2 as rad from a)
select p_partkey, round(1000*s*x + 960, 4) as fish_u, round(1010*s*y + 540, 4) as fish_v,
round(1000*(u*rad + 2*0.0005*u*v - 0.0003*(r2+2*u*u)) + 960, 4) as rad_u, round(1010*(v*rad + 0.0005*(r2+2*v*v) - 2*0.0003*u*v) + 540, 4) as rad_v,
round(1000*u + 960, 4) as pin_u from b"""
)
def camera_projection(spark, sf):
    p = (F.col("x"), F.col("y"), F.col("z"))
    fu, fv = camera.project_fisheye(p, _K, _FISH)
    ru, rv = camera.project_radial(p, _K, _RAD)
    pu, _ = camera.project_pinhole(p, _K)
    return _rays(spark, sf).select("p_partkey", *[F.round(c, 4).alias(n) for c, n in ((fu, "fish_u"), (fv, "fish_v"), (ru, "rad_u"), (rv, "rad_v"), (pu, "pin_u"))])


@query(_CAM + "select p_partkey, round(x / sqrt(x*x+y*y+z*z), 6) as fx, round(y / sqrt(x*x+y*y+z*z), 6) as fy, round(x / sqrt(x*x+y*y+z*z), 6) as rx, round(z / sqrt(x*x+y*y+z*z), 6) as rz from p")
def camera_unprojection(spark, sf):
    """Project and come back: the ray of the point itself."""
    p = (F.col("x"), F.col("y"), F.col("z"))
    fu, fv = camera.project_fisheye(p, _K, _FISH)
    ru, rv = camera.project_radial(p, _K, _RAD)
    px = _rays(spark, sf).select("p_partkey", fu.alias("fu"), fv.alias("fv"), ru.alias("ru"), rv.alias("rv"))
    back = px.select("p_partkey", camera.unproject_fisheye(F.col("fu"), F.col("fv"), _K, _FISH).alias("f"), camera.unproject_radial(F.col("ru"), F.col("rv"), _K, _RAD).alias("r"))
    return back.select("p_partkey", r6("f.x").alias("fx"), r6("f.y").alias("fy"), r6("r.x").alias("rx"), r6("r.z").alias("rz"))


@query(
    """select p_partkey, (p_size * 604800000::bigint + cast(floor(p_retailprice * 1000) as bigint) + (315964800 - 18) * 1000::bigint) * 1000000 as gps_ns,
epoch_ns(make_timestamp(0)) + (p_size * 1000000000::bigint + p_partkey) as stamp_ns, -1 - (p_size // 1000) as micros from part"""
)
def stamp_functions(spark, sf):
    p = table(spark, sf, "part").withColumn("ms", F.floor(F.col("p_retailprice") * 1000)).withColumn("neg", F.lit(-1).cast("long"))
    return p.select("p_partkey", clock.gps_ns("p_size", "ms").alias("gps_ns"), clock.stamp_ns("p_size", "p_partkey").alias("stamp_ns"),
                    clock.micros("neg").cast("int").alias("micros"))


@query(
    """
with n as (select p_partkey, chr(65 + p_size % 4) || '-' || (p_partkey % 30) || '_2026-09-2' || (p_size % 10) || '-14-40-58' as name from part)
select p_partkey, regexp_extract(name, '^([A-Z])-', 1) as course, p_partkey % 30 as number, row_number() over (order by regexp_extract(name, '^([A-Z])-', 1), (p_partkey % 30), name, p_partkey) as rank from n"""
)
def route_order(spark, sf):
    from trackloom.operators.mutate import numbered

    name = F.concat(F.chr(65 + F.col("p_size") % 4), F.lit("-"), (F.col("p_partkey") % 30).cast("string"), F.lit("_2026-09-2"), (F.col("p_size") % 10).cast("string"), F.lit("-14-40-58"))
    p = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    keyed = p.select("p_partkey", "name", text.recording_parts(F.col("name")).alias("part"), text.route_key(F.col("name")).alias("key"))
    n = numbered(keyed, ["key", "p_partkey"], "rank")
    return n.select("p_partkey", F.col("part.course").alias("course"), F.col("part.number").cast("long").alias("number"), "rank")


@query(
    """
with t as (select page_id, lower(url) as t, case when page_id % 4 = 0 then 'sensor_msgs/pointcloud2' when page_id % 4 = 1 then 'sensor_msgs/compressedimage' when page_id % 4 = 2 then 'can_msgs/frame' else 'std_msgs/string' end as k, url from pages)
select page_id, case when t like '%camera_info%' or k like '%camerainfo' or (t like '%lidar%' and t like '%status%') then 5
when k like '%compressedimage' or k like '%/image' or (t like '%camera%' and k like '%image%') then 0
when (k like '%pointcloud2' and t not like '%radar%') or t like '%lidar%' or t like '%velodyne%' or t like '%ouster%' then 1 when t like '%radar%' then 2
when t like '%novatel%' or t like '%gnss%' or t like '%gps%' or t like '%/ins%' or t like '%imu%' then 3 when replace(t, 'scan', '') like '%can%' then 4 else 6 end as family,
replace(trim(url, '/'), '/', '__') as slug from t"""
)
def sensor_groups(spark, sf):
    r = F.col("page_id") % 4
    kind = F.when(r == 0, "sensor_msgs/PointCloud2").when(r == 1, "sensor_msgs/CompressedImage").when(r == 2, "can_msgs/Frame").otherwise("std_msgs/String")
    p = table(spark, sf, "pages").select("page_id", "url", kind.alias("kind"))
    return p.select("page_id", text.sensor_group(F.col("url"), F.col("kind")).alias("family"), text.topic_slug(F.col("url")).alias("slug"))


@query(
    """
with s as (select doc_id, n_chars::double ** 3 as v, lang, source from documents)
select doc_id, case when v < 1024 then printf('%.0f B', v) when v < 1048576 then printf('%.0f KB', v / 1024) when v < 1073741824 then printf('%.1f MB', v / 1048576)
when v < 1099511627776 then printf('%.1f GB', v / 1073741824) else printf('%.1f TB', v / 1099511627776) end as size,
least(lang, source) || '|' || greatest(lang, source) as pair, round(1 - 0.85 ** (doc_id % 9), 9) as alpha from s"""
)
def labels_and_sizes(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.human_size(F.pow(F.col("n_chars").cast("double"), F.lit(3))).alias("size"), text.pair_key(F.col("lang"), F.col("source")).alias("pair"),
                    F.round(text.overlap_alpha(F.col("doc_id") % 9, 0.15), 9).alias("alpha"))


@query("select event_id, user_id, (props ->> '$.k')::bigint as k, epoch_us(ts) as utime from events")
def json_sidecar(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", "user_id", F.from_json("props", "k bigint")["k"].alias("k"), F.col("at").alias("utime"))


_G = "with e as (select user_id, event_type, event_id, value as x, (props ->> '$.k')::double as y, epoch_us(ts) as at, value % 7 as z from events)"


def _pts(spark, sf):
    k = F.get_json_object("props", "$.k").cast("double")
    return events(spark, sf).select("user_id", "event_type", "event_id", "at", F.col("value").alias("x"), k.alias("y"), (F.col("value") % 7).alias("z"))


@query(_G + " select event_type, cast(floor(x / 25) as bigint) as cx, cast(floor(y / 25) as bigint) as cy, count(*) as n from e group by all")
def grid_counts(spark, sf):
    return grid.cell_counts(_pts(spark, sf), ["event_type"], "x", "y", 25.0)


@query(
    _G
    + """, p as (select event_type, x - 50 as x, y - 50 as y, z from e where abs(x - 50) < 40 and abs(y - 50) < 40),
g as (select event_type, least(greatest(floor((x + 40) / 8), 0), 9) as gx, least(greatest(floor((y + 40) / 8), 0), 9) as gy, min(z) as z from p group by all),
m as (select a.event_type, a.gx, a.gy, min(b.z) as ground from g a join g b on a.event_type = b.event_type and abs(a.gx - b.gx) <= 1 and abs(a.gy - b.gy) <= 1 group by all),
s as (select p.event_type, p.x, p.y from p join m on p.event_type = m.event_type and least(greatest(floor((x + 40) / 8), 0), 9) = gx and least(greatest(floor((y + 40) / 8), 0), 9) = gy
  where z - ground > 0.4 and z - ground < 2.5 and x * x + y * y > 2.5 * 2.5)
select event_type, cast(least(greatest(floor((x + 40) / 4), 0), 19) as integer) as cx, cast(least(greatest(floor((y + 40) / 4), 0), 19) as integer) as cy, count(*) as n from s group by all having count(*) >= 2"""
)
def grid_occupancy(spark, sf):
    p = _pts(spark, sf).select("event_type", (F.col("x") - 50).alias("x"), (F.col("y") - 50).alias("y"), "z")
    return grid.occupancy(p, ["event_type"], cell=4.0, ground_cell=8.0)


_CELLS = _G + ", c as (select distinct user_id, event_type, cast(floor(x / 20) as bigint) as cx, cast(floor(y / 10) as bigint) as cy from e)"


def _cells(spark, sf, kind):
    p = _pts(spark, sf).where(F.col("event_type") == kind)
    return p.select("user_id", F.floor(F.col("x") / 20).alias("cx"), F.floor(F.col("y") / 10).alias("cy")).distinct()


@query(
    _CELLS
    + """, a as (select * from c where event_type = 'click'), b as (select * from c where event_type = 'view')
select user_id, cx, cy, 'gone' as change from a where not exists (select 1 from b where a.user_id = b.user_id and abs(a.cx - b.cx) <= 1 and abs(a.cy - b.cy) <= 1)
union all select user_id, cx, cy, 'new' from b where not exists (select 1 from a where a.user_id = b.user_id and abs(a.cx - b.cx) <= 1 and abs(a.cy - b.cy) <= 1)"""
)
def change_cells(spark, sf):
    return grid.change_cells(_cells(spark, sf, "click"), _cells(spark, sf, "view"), ["user_id"])


@query(
    _CELLS.replace("with e", "with recursive e")
    + """, a as (select user_id, cx, cy, user_id || '/' || cx || '/' || cy as id from c where event_type = 'click'),
ed as (select a.id as u, b.id as v from a join a b on a.user_id = b.user_id and abs(a.cx - b.cx) <= 1 and abs(a.cy - b.cy) <= 1),
r as (select u as n, v as m from ed union select r.n, ed.v from r join ed on r.m = ed.u),
k as (select n, min(m) as blob, count(*) as size from r group by n)
select user_id, cx, cy, blob from a join k on a.id = k.n where size >= 4"""
)
def change_blobs(spark, sf):
    return grid.blobs(_cells(spark, sf, "click"), ["user_id"])


@query(
    _G
    + """, h as (select user_id, cast(floor(x / 20) as bigint) as cx, cast(floor(y / 10) as bigint) as cy, count(*) as n from e group by all),
o as (select unnest([-1, 0, 1]) as o),
b as (select user_id, cx + i.o as cx, cy + j.o as cy, sum(n) as n from h, o i, o j group by user_id, cx + i.o, cy + j.o),
z as (select user_id, sqrt(sum(n * n)) as z from b group by user_id),
p as (select distinct user_id as a, user_id + 1 as b from e where user_id + 1 in (select user_id from e)),
d as (select p.a, p.b, sum(x.n * y.n) as dot from p join b x on x.user_id = p.a join b y on y.user_id = p.b and x.cx = y.cx and x.cy = y.cy group by p.a, p.b)
select p.a, p.b, round(coalesce(dot / (za.z * zb.z), 0), 6) as cosine from p left join d using (a, b) join z za on za.user_id = p.a join z zb on zb.user_id = p.b"""
)
def heat_cosine(spark, sf):
    h = _pts(spark, sf).groupBy("user_id", F.floor(F.col("x") / 20).alias("cx"), F.floor(F.col("y") / 10).alias("cy")).agg(F.count(F.lit(1)).alias("n"))
    u = h.select("user_id").distinct()
    p = u.select(F.col("user_id").alias("a"), (F.col("user_id") + 1).alias("b"))
    p = p.join(u.select(F.col("user_id").alias("b")), "b", "left_semi")
    return grid.heat_cosine(h, "user_id", p).select("a", "b", r6("cosine").alias("cosine"))


@query(_G + " select arg_min(event_id, event_id) as event_id, arg_min(x, event_id) as x from e group by event_type, floor(x / 10), floor(y / 10), floor(z / 2)")
def voxel_first(spark, sf):
    p = _pts(spark, sf).select(
        "event_type", "event_id", "x", (F.col("x") / 10).alias("vx"), (F.col("y") / 10).alias("vy"), (F.col("z") / 2).alias("vz")
    )
    return grid.voxel_first(p, ["event_type"], ["vx", "vy", "vz"], 1.0, "event_id").select("event_id", "x")


@query(
    _G
    + """, i as (select *, floor(x / 6) as cx, floor(y / 6) as cy, 1 + z as depth from e where x >= 0 and x < 400 and y >= 0 and y < 90),
m as (select event_type, cx, cy, min(depth) as d from i group by all)
select event_id from i join m using (event_type, cx, cy) where depth <= d * 1.08 + 0.2"""
)
def depth_visible(spark, sf):
    p = _pts(spark, sf).withColumn("depth", 1 + F.col("z"))
    return grid.visible(p, ["event_type"], "x", "y", "depth", 400, 90).select("event_id")


@query(
    _G
    + """, n as (select *, lag(x) over w as p, lead(x) over w as q from e window w as (partition by user_id, event_type order by at))
select event_id, coalesce(p - x > 0 and p - x > greatest(0.3, 0.05 * least(p, x)), false) or coalesce(q - x > 0 and q - x > greatest(0.3, 0.05 * least(q, x)), false) as edge from n"""
)
def range_edges(spark, sf):
    return grid.range_edges(_pts(spark, sf), ["user_id"], "event_type", "at", "x", DAY).select("event_id", "edge")


@query(
    """
with d as (select distinct c_nationkey, c_mktsegment, c_acctbal from customer),
r as (select *, cast(rank() over (partition by c_nationkey order by c_acctbal) - 1 as integer) as ring from (select c_nationkey, c_mktsegment, min(c_acctbal) as c_acctbal from d group by 1, 2))
select c_nationkey, c_mktsegment, ring from r"""
)
def ring_ranks(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_acctbal").alias("angle"))
    return grid.ring_of(c, "c_nationkey", "c_mktsegment", "angle").select("c_nationkey", "c_mktsegment", "ring")


@query(
    _G
    + """, f as (select user_id, event_type, arg_min({'x': x, 'y': y, 'z': z}, at) as a, arg_max({'x': x, 'y': y, 'z': z}, at) as b from e group by all),
bad as (select user_id, event_type from f where sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) < 30 and abs(b.z - a.z) > 1),
n as (select user_id, event_type, count(*) as n from e group by all)
select e.event_id from e join n using (user_id, event_type) where n >= 8 and (user_id, event_type) not in (select (user_id, event_type) from bad)"""
)
def track_filters(spark, sf):
    p = _pts(spark, sf)
    long_ = grid.long_tracks(p, ["user_id", "event_type"], 8)
    return grid.drop_static_tracks(long_, ["user_id", "event_type"], "at", "x", "y", ["z"], 30.0, 1.0).select("event_id")


_BOX = """
with b0 as (select *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::varchar || '-' || l_extendedprice::varchar as id from lineitem),
b as (select id, l_orderkey, l_suppkey as scene, l_linenumber - 1 as frame, l_returnflag as kind, l_discount * 10 as conf,
  case l_linenumber when 1 then 'person' when 2 then 'bicycle' when 3 then 'car' when 4 then 'motorcycle' when 5 then 'bus' when 6 then 'truck' else 'person' end as name,
  l_discount * 8000 as x1, l_tax * 6000 as y1, l_discount * 8000 + l_quantity * 24 as x2, l_tax * 6000 + 20 + l_extendedprice / 150 as y2 from b0)
"""


def _boxes(spark, sf):
    li = table(spark, sf, "lineitem")
    names = {1: "person", 2: "bicycle", 3: "car", 4: "motorcycle", 5: "bus", 6: "truck"}
    name = F.lit("person")
    for k, v in names.items():
        name = F.when(F.col("l_linenumber") == k, v).otherwise(name)
    ident = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")])
    x1, y1 = F.col("l_discount") * 8000, F.col("l_tax") * 6000
    return li.select(
        ident.alias("id"), "l_orderkey", F.col("l_suppkey").alias("scene"), (F.col("l_linenumber") - 1).alias("frame"), F.col("l_returnflag").alias("kind"),
        (F.col("l_discount") * 10).alias("conf"), name.alias("name"), F.lit(0).alias("cam"),
        x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_quantity") * 24).alias("x2"), (y1 + 20 + F.col("l_extendedprice") / 150).alias("y2"),
    )


_FLAGGED = (
    _BOX
    + """, f as (select *, case when conf < 0.25 then 'LOW' when name in ('car', 'bus', 'truck') and y2 > 0.97 * 1080 and x2 - x1 > 0.4 * 1920 then 'EGO' else 'COUNTED' end as flag0 from b),
rid as (select distinct p.id from f p join f t on p.l_orderkey = t.l_orderkey and p.name = 'person' and t.name in ('bicycle', 'motorcycle') and p.flag0 = 'COUNTED' and t.flag0 = 'COUNTED'
  where greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0) * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0) / greatest((p.x2 - p.x1) * (p.y2 - p.y1), 1e-6) >= 0.3),
g as (select f.*, case when rid.id is not null then 'RIDER' else flag0 end as flag from f left join rid using (id))
"""
)


@query(_FLAGGED + "select id, flag, count(*) as n from g group by all")
def box_flags(spark, sf):
    f = detections.box_flags(_boxes(spark, sf), ["l_orderkey"], "cam", "name", "id", 0.25, 1080, 1920)
    return f.groupBy("id", "flag").agg(F.count(F.lit(1)).alias("n"))


@query(
    _FLAGGED
    + """, c as (select l_orderkey, count(*) filter (flag = 'COUNTED') as all_all, count(*) filter (flag = 'COUNTED' and y2 - y1 >= 200) as all_near,
count(*) filter (flag = 'COUNTED' and name in ('car', 'bus', 'truck')) as veh_all, count(*) filter (flag = 'COUNTED' and name = 'person' and y2 - y1 >= 200) as ped_near from g group by l_orderkey)
select o_custkey, round(avg(coalesce(all_all, 0)), 6) as all_mean, max(coalesce(all_near, 0)) as near_max, min(coalesce(veh_all, 0)) as veh_min,
round(avg(case when coalesce(ped_near, 0) > 0 then 1.0 else 0.0 end), 6) as ped_any from orders left join c on o_orderkey = l_orderkey group by o_custkey"""
)
def sample_counts(spark, sf):
    f = detections.box_flags(_boxes(spark, sf), ["l_orderkey"], "cam", "name", "id", 0.25, 1080, 1920)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = detections.sample_counts(f, o, ["l_orderkey"], "name", 200.0)
    s = detections.count_summary(c.join(o, "l_orderkey"), ["o_custkey"], ["all_all", "all_near", "veh_all", "ped_near"])
    return s.select("o_custkey", r6("all_all_mean").alias("all_mean"), F.col("all_near_max").alias("near_max"), F.col("veh_all_min").alias("veh_min"), r6("ped_near_any").alias("ped_any"))


@query(
    _BOX
    + """, st as (select distinct a.id, a.frame from b a join b o on a.scene = o.scene and a.kind = o.kind and abs(a.frame - o.frame) = 1
  where greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) /
  ((a.x2 - a.x1) * (a.y2 - a.y1) + (o.x2 - o.x1) * (o.y2 - o.y1) - greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) + 1e-9) >= 0.5)
select b.scene, b.kind, count(*) as n, count(*) filter (st.id is null) as n_moving from b left join st using (id, frame) group by all"""
)
def moving_boxes(spark, sf):
    b = _boxes(spark, sf).select("scene", "frame", "cam", "kind", "id", *detections.BOX)
    m = detections.moving_boxes(b, ["scene"], "frame", "cam", "kind", "id", 0.5)
    return m.groupBy("scene", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("moving").alias("n_moving"))


@query(
    _BOX
    + """select a.l_orderkey, count(*) as n_pairs, round(max(greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) /
  ((a.x2 - a.x1) * (a.y2 - a.y1) + (o.x2 - o.x1) * (o.y2 - o.y1) - greatest(least(a.x2, o.x2) - greatest(a.x1, o.x1), 0) * greatest(least(a.y2, o.y2) - greatest(a.y1, o.y1), 0) + 1e-6)), 6) as best
from b a join b o on a.l_orderkey = o.l_orderkey and o.frame = a.frame + 1 group by a.l_orderkey"""
)
def iou_pairs(spark, sf):
    b = _boxes(spark, sf).select("l_orderkey", "frame", "id", "x1", "y1", "x2", "y2")
    o = b.select("l_orderkey", (F.col("frame") - 1).alias("frame"), *[F.col(c).alias(f"o_{c}") for c in detections.BOX])
    j = salted_join(b, o, ["l_orderkey", "frame"], ["id"])
    v = bx.iou(detections.BOX, tuple(f"o_{c}" for c in detections.BOX), 1e-6)
    return j.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_pairs"), r6(F.max(v)).alias("best"))


@query(
    """
with w as (select user_id, (props ->> '$.k')::double / 99 as f from events)
select user_id, round(sum((1 - f) ** 3 / 6), 6) as w0, round(sum((3 * f ** 3 - 6 * f * f + 4) / 6), 6) as w1, round(sum(f ** 3 / 6), 6) as w3 from w group by user_id"""
)
def spline_weights(spark, sf):
    f = F.get_json_object("props", "$.k").cast("double") / 99
    w = camera.spline_weights(f)
    return events(spark, sf).groupBy("user_id").agg(r6(F.sum(w[0])).alias("w0"), r6(F.sum(w[1])).alias("w1"), r6(F.sum(w[3])).alias("w3"))


@query(
    _Q
    + """, m as (select *, lead(w) over o as w2, lead(i) over o as i2, lead(j) over o as j2, lead(k) over o as k2 from q window o as (order by vec_id))
select vec_id, round(degrees(2 * acos(least(abs(w*w2 + i*i2 + j*j2 + k*k2), 1.0))), 5) as angle from m where w2 is not null"""
)
def rotation_angles(spark, sf):
    u = _unit(spark, sf)
    nxt = u.select((F.col("vec_id") - 1).alias("vec_id"), *[F.col(c).alias(f"{c}2") for c in ("qw", "qx", "qy", "qz")])
    a = rotation.angle_between(rotation.quat(), rotation.quat(("qw2", "qx2", "qy2", "qz2")))
    return u.join(nxt, "vec_id").select("vec_id", F.round(F.degrees(a), 5).alias("angle"))

