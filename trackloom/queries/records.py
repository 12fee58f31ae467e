"""Set comparisons, pruning, reading views and small rules on the star schema read as a recording dataset.

Roles: customer = scene, nation = log, orders = sample, lineitem = frame, supplier % 25 = calibrated sensor, region = sensor,
part = ego pose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions import clock
from trackloom.functions.clock import as_micros
from trackloom.operators import audit, grid, mutate
from trackloom.plans import dataset_index
from trackloom.queries.alignment import _QT
from trackloom.queries.registry import DAY, events, query, table, width
from trackloom.sources import listing
from trackloom.sources.tables import fingerprint


def _text(column: str, name: str):
    return F.col(column).cast("string").alias(name)


def dataset(spark, sf) -> dict[str, DataFrame]:
    li, part, nation = table(spark, sf, "lineitem"), table(spark, sf, "part"), table(spark, sf, "nation")
    place = F.array(F.col("p_size").cast("double"), F.lit(0.0), F.lit(0.0))
    turn = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    file = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    return {
        "sensor": table(spark, sf, "region").select(_text("r_regionkey", "token"), F.col("r_name").alias("channel"), F.lit("camera").alias("modality")),
        "calibrated_sensor": nation.select(
            _text("n_nationkey", "token"), _text("n_regionkey", "sensor_token"), turn.alias("translation"), turn.alias("rotation"), F.array().cast("array<array<double>>").alias("camera_intrinsic")
        ),
        "log": nation.select(_text("n_nationkey", "token"), F.col("n_name").alias("logfile")),
        "map": nation.groupBy(_text("n_regionkey", "token")).agg(F.collect_set(F.col("n_nationkey").cast("string")).alias("log_tokens")),
        "scene": table(spark, sf, "customer").select(_text("c_custkey", "token"), F.col("c_name").alias("name"), _text("c_nationkey", "log_token")),
        "sample": table(spark, sf, "orders").select(_text("o_orderkey", "token"), _text("o_custkey", "scene_token"), as_micros("o_orderdate").alias("timestamp")),
        "sample_data": li.select(
            file.alias("token"), _text("l_orderkey", "sample_token"), (F.col("l_suppkey") % 25).cast("string").alias("calibrated_sensor_token"),
            _text("l_partkey", "ego_pose_token"), as_micros("l_shipdate").alias("timestamp"), file.alias("filename"), (F.col("l_linenumber") <= 2).alias("is_key_frame"),
        ),
        "ego_pose": part.select(_text("p_partkey", "token"), place.alias("translation"), turn.alias("rotation")),
    }


_FRAMES = """
with f as (
  select l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber || '-' || l_partkey as filename, r_name as channel, c_name as scene, ln.n_name as logfile,
    epoch_us(l_shipdate) as at, epoch_us(o_orderdate) as sample_at, l_partkey, l_linenumber <= 2 as is_key
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation ln on c_nationkey = ln.n_nationkey
  join nation s on l_suppkey % 25 = s.n_nationkey join region on s.n_regionkey = r_regionkey
)
"""


@query(_FRAMES + "select filename, channel, scene, logfile, at from f")
def frame_chain(spark, sf):
    f = dataset_index.frames(dataset(spark, sf))
    return f.select("filename", "channel", "scene", "logfile", F.col("timestamp").alias("at"))


@query(
    _FRAMES
    + """, k as (select f.*, p_size from f join part on l_partkey = p_partkey where is_key),
a as (select l_orderkey, at as ref from k where channel = 'ASIA')
select k.filename, channel, round((at - coalesce(ref, sample_at)) / 1000.0, 3) as dt_ms, cast(p_size as double) as ego_x
from k left join a on k.l_orderkey = a.l_orderkey"""
)
def sample_payload(spark, sf):
    p = dataset_index.sample_payload(dataset(spark, sf), "ASIA")
    return p.select("filename", "channel", F.round("dt_ms", 3).alias("dt_ms"), F.col("ego_translation")[0].alias("ego_x"))


@query(_QT.replace("at - lo_at <= hi_at - at", "at - lo_at < hi_at - at") + "select user_id, at, match_at - at as dt, match_value as value from near")
def ego_status(spark, sf):
    e = events(spark, sf)
    samples = e.where("event_type = 'click'").select("user_id", "at")
    track = e.where("event_type = 'view'").select("user_id", "at", "value")
    return dataset_index.ego_status(samples, track, "user_id", "at", ["value"], width(spark, sf, "user_id"))


@query(
    """
with f as (select l_orderkey, epoch_us(l_shipdate) as at, l_returnflag <> 'R' as ok from lineitem),
s as (select l_orderkey, min(at) as a, max(at) as b, min(at) filter (not ok) as hole, count(*) filter (ok) as have, count(*) as n from f group by l_orderkey)
select cast(l_orderkey as varchar) as scene, b - a as duration, least(b - a, greatest(coalesce(hole - a, b - a), 0)) as buffered, round(have / n, 6) as share from s"""
)
def buffered_span(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("at", as_micros("l_shipdate"))
    file = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in table(spark, sf, "lineitem").columns]), 256)
    play = li.select(_text("l_orderkey", "scene"), F.lit("c").alias("channel"), F.col("at").alias("timestamp"), file.alias("filename"))
    scenes = play.groupBy("scene").agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"))
    b = dataset_index.buffered(play, scenes, li.where("l_returnflag <> 'R'").select(file.alias("filename")))
    return b.select("scene", "duration", "buffered", F.round("share", 6).alias("share"))


@query(
    """
with gone as (select c_custkey from customer where c_mktsegment = 'BUILDING' or c_nationkey < 3),
os as (select * from orders where o_custkey in (select * from gone)),
ls as (select * from lineitem where l_orderkey in (select o_orderkey from os)),
lg as (select distinct c_nationkey as n from customer where c_custkey not in (select * from gone))
select 'scene' as name, (select count(*) from customer) - (select count(*) from gone) as n
union all select 'sample', (select count(*) from orders) - (select count(*) from os)
union all select 'sample_data', (select count(*) from lineitem) - (select count(*) from ls)
union all select 'ego_pose', (select count(*) from part where p_partkey not in (select l_partkey from ls))
union all select 'log', (select count(*) from lg)
union all select 'map logs', (select count(*) from nation where n_nationkey in (select n from lg))"""
)
def pruned_tables(spark, sf):
    gone = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING' or c_nationkey < 3").select(_text("c_custkey", "token"))
    t = mutate.prune(dataset(spark, sf), gone)
    counts = [t[k].agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k in ("scene", "sample", "sample_data", "ego_pose", "log")]
    logs = t["map"].agg(F.sum(F.size("log_tokens")).cast("long").alias("n")).select(F.lit("map logs").alias("name"), "n")
    for c in counts:
        logs = logs.unionByName(c)
    return logs


_TWINS = """
with t as (select o_custkey, list_sort(list(epoch_us(o_orderdate))) as times from orders group by o_custkey),
a as (select c_nationkey as log, times, c_name as name from customer join t on c_custkey = o_custkey),
b as (select c_nationkey as log, times, case when c_custkey % 5 = 0 then c_name || '-new' else c_name end as name
 from customer join (select * from t where o_custkey % 7 <> 0) t on c_custkey = o_custkey where c_nationkey < 20),
j as (select a.name as a_name, b.name as b_name, a.log as a_log, b.log as b_log from a full join b on a.log = b.log and a.times = b.times)
select * from (select case when a_name is null then 'drop' when b_name is null and a_log in (select log from b) then 'no_twin'
 when a_name <> b_name then 'renamed' when a_name = b_name then 'same' end as kind, a_name, b_name from j) where kind is not null"""


@query(_TWINS)
def twin_sets(spark, sf):
    t = dataset(spark, sf)
    with_samples = lambda s, p: s.join(p.select(F.col("scene_token").alias("token")).distinct(), "token", "left_semi")
    a = mutate.twin_keys(with_samples(t["scene"], t["sample"]), t["sample"], t["log"])
    samples = t["sample"].where("cast(scene_token as long) % 7 <> 0")
    scenes = with_samples(t["scene"], samples).where("cast(log_token as int) < 20")
    renamed = scenes.withColumn("name", F.when(F.col("token").cast("long") % 5 == 0, F.concat("name", F.lit("-new"))).otherwise(F.col("name")))
    b = mutate.twin_keys(renamed, samples, t["log"])
    logs_b = b.select("logfile").distinct()
    return mutate.compare_twins(a, b, t["log"], logs_b)


@query(
    """select distinct o_orderpriority as round, 'b' || o_custkey as token from orders where o_custkey % 3 = 0"""
)
def mirrored_locks(spark, sf):
    o = table(spark, sf, "orders")
    # one row per lock file; a token list is as long as a round's scenes
    rounds = o.groupBy(F.col("o_orderpriority").alias("round"), F.pmod("o_custkey", F.lit(64)).alias("file")).agg(
        F.collect_set(F.col("o_custkey").cast("string")).alias("tokens")
    )
    twins = o.where("o_custkey % 3 = 0").select(_text("o_custkey", "token")).distinct().withColumn("twin_token", F.concat(F.lit("b"), "token"))
    return mutate.mirror_tokens(rounds, twins)


@query(
    """select c_custkey from customer where c_acctbal >= 0 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')"""
)
def recordings_to_import(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return mutate.not_imported(c, "c_custkey", done, c.where("c_acctbal < 0")).select("c_custkey")


@query(
    """
with e as (select * from orders where o_orderstatus = 'F')
select o_orderkey from e union all select o_orderkey from orders o where o_orderstatus = 'O'
and not exists (select 1 from e where e.o_custkey = o.o_custkey and e.o_orderpriority = o.o_orderpriority)"""
)
def append_merge(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    both = mutate.merge_new(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_custkey", "o_orderpriority"])
    return both.select("o_orderkey")


@query(
    """
with r as (select o_orderkey as path, o_orderpriority as course, o_custkey as number, epoch_us(o_orderdate) as at from orders),
o as (select 'c' || o_orderkey as companion, o_orderpriority as course, o_custkey as number, epoch_us(o_orderdate) + (o_orderkey % 12) * 1000000 as at from orders)
select path, companion from r join o using (course, number) where abs(o.at - r.at) <= 5000000"""
)
def recording_companions(spark, sf):
    o = table(spark, sf, "orders").withColumn("started", F.col("o_orderdate").cast("timestamp"))
    key = [F.col("o_orderpriority").alias("course"), F.col("o_custkey").alias("number")]
    recs = o.select(F.col("o_orderkey").alias("path"), *key, "started")
    later = F.timestamp_micros(F.unix_micros("started") + F.col("o_orderkey") % 12 * 1_000_000)
    others = o.select(F.concat(F.lit("c"), F.col("o_orderkey")).alias("path"), *key, later.alias("started"))
    return listing.companions(recs, others).select("path", "companion")


@query(
    """
with f as (select l_orderkey || '-' || l_linenumber || '-' || l_partkey as filename, l_orderkey, l_linenumber, l_returnflag from lineitem)
select filename from f where l_linenumber <= 2 and filename not in (select filename from f where l_returnflag <> 'R')
and l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')"""
)
def missing_files(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("filename", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    data = li.select("filename", F.col("l_orderkey").alias("scene_token"), (F.col("l_linenumber") <= 2).alias("is_key_frame"))
    dropped = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("scene_token"))
    return audit.missing_files(data, li.where("l_returnflag <> 'R'").select("filename"), dropped).select("filename")


@query("select event_id, value from events where event_id % 7 <> 0 and event_id % 11 <> 0")
def finite_rows(spark, sf):
    bad = F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 11 == 0, float("-inf"))
    e = events(spark, sf).select("event_id", "value", F.coalesce(bad, F.col("value")).alias("measured"))
    return grid.finite(e, ["value", "measured"]).select("event_id", "value")


@query(
    """
with p as (select l_orderkey, l_linenumber, l_quantity as x, l_discount * 100 as y, l_tax * 100 as z from lineitem)
select l_orderkey, l_linenumber, x from p where sqrt(x * x + y * y + z * z) > 10.25 and sqrt(x * x + y * y + z * z) < 30.25"""
)
def range_gate(spark, sf):
    p = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_tax") * 100).alias("z")
    )
    return grid.in_range(p, "x", "y", "z", 10.25, 30.25).select("l_orderkey", "l_linenumber", "x")


@query(
    f"""
with f as (select user_id, event_type, min(epoch_us(ts)) as first from events group by all)
select user_id, event_type, abs(first - min(first) over (partition by user_id)) > {DAY} as off from f"""
)
def off_clock_streams(spark, sf):
    e = events(spark, sf)
    first = e.groupBy("user_id", "event_type").agg(F.min("at").alias("first"))
    begin = e.groupBy("user_id").agg(F.min("at").alias("received"))
    return first.join(begin, "user_id").select("user_id", "event_type", clock.off_clock("first", "received", DAY).alias("off"))


@query(
    """select event_id, epoch_us(ts) as utc_us, epoch_us(date_trunc('millisecond', ts)) + event_id % 1000 as ymd_us from events"""
)
def packet_times(spark, sf):
    e = events(spark, sf).select("event_id", "at")
    hexed = lambda c, digits: F.lpad(F.hex(c), digits, "0")
    utc = F.unhex(F.concat(hexed(F.expr("at div 1000000L"), 12), hexed(F.col("at") % 1_000_000, 8)))
    t = F.timestamp_micros("at")
    parts = [F.year(t) - 2000, F.month(t), F.day(t), F.hour(t), F.minute(t), F.second(t)]
    ymd = F.unhex(F.concat(*[hexed(p.cast("long"), 2) for p in parts], hexed(F.expr("at % 1000000L div 1000L"), 4), hexed(F.col("event_id") % 1000, 4)))
    e = e.withColumns({"utc": utc, "ymd": ymd})
    return e.select("event_id", clock.packet_utc_us("utc", 0).alias("utc_us"), clock.packet_ymd_us("ymd", 0).alias("ymd_us"))


@query("select 'customer' as name, count(*) as n, true as same, true as told_apart from customer")
def table_fingerprint(spark, sf):
    """Equal for the same rows in another order, unequal once a cell differs."""
    c = table(spark, sf, "customer")
    shuffled = c.repartition(5, "c_acctbal")
    changed = c.withColumn("c_acctbal", F.when(F.col("c_custkey") == 7, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    a, b, d = (fingerprint({"customer": x}).select(F.col("table").alias("name"), F.col("rows").alias("n"), F.col("checksum").alias(k)) for x, k in ((c, "a"), (shuffled, "b"), (changed, "d")))
    j = a.join(b, ["name", "n"]).join(d, ["name", "n"])
    return j.select("name", "n", (F.col("a") == F.col("b")).alias("same"), (F.col("a") != F.col("d")).alias("told_apart"))


@query(
    """select p_partkey, p_brand, p_retailprice, place from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as place from part) where place <= 5"""
)
def dearest_parts(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    return mutate.top_k(p, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 5)


@query(
    """select user_id, event_id, value, place from (select user_id, event_id, value, row_number() over (partition by user_id order by value desc, ts, event_id) as place
from events where event_type = 'error') where place <= 8"""
)
def severest_events(spark, sf):
    e = events(spark, sf).where("event_type = 'error'").select("user_id", "event_id", "value", "at")
    return mutate.top_k(e, ["user_id"], [F.col("value").desc(), F.col("at"), F.col("event_id")], 8).drop("at")


@query(
    """
with pool as (select distinct c_name from customer where c_nationkey < 5)
select c_name from pool order by c_name limit 20"""
)
def first_free_names(spark, sf):
    return mutate.first_names(table(spark, sf, "customer").where("c_nationkey < 5"), "c_name", 20)


@query(
    """
with l as (select p_type as name, 0 as l, min(p_partkey) as at from part where p_size > 40 group by p_type
 union all select p_type, 1, min(p_partkey) from part group by p_type),
f as (select name, min((l, at)) as k from l group by name)
select name, row_number() over (order by k, name) as place from f"""
)
def ordered_types(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("name"), "p_partkey", "p_size")
    return mutate.ordered_union([(p.where("p_size > 40"), "p_partkey"), (p, "p_partkey")], "name")
