"""The normalized dataset: builder, links, audits, prune, renumber, twins, plans."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from trackloom.operators import audit, mutate
from trackloom.plans import dataset_build as db
from trackloom.plans import scene_yield as sy
from trackloom.queries.alignment import _PARAMS, _SYNC, _YIELD, params, recording
from trackloom.queries.registry import HOUR, events, query, r6, table
from trackloom.session import stage

_BUILD = db.BuildParams(_PARAMS, stride=2, tolerance={"error": HOUR}, modality={"click": "lidar", "error": "radar"}, sizes={"view": (1080, 1920)})


def _build(spark, sf) -> db.BuildParams:
    return replace(_BUILD, yields=params(spark, sf))

_KEYS = (
    _YIELD.format(sync=_SYNC)
    + """, kf as (select cut.at, c.view, c.purchase, c.signup, sha256('all/' || segment || '/' || scene_no) as scene_token,
  sha256(sha256('all/' || segment || '/' || scene_no) || '/' || cut.at) as token
  from cut join chosen c on cut.at = c.at where scene_no is not null and ((place - 1) % n) % 2 = 0)
"""
)


def _keys(spark, sf):
    f = recording(spark, sf)
    planned = stage(sy.plan_frames(f, params(spark, sf)), "planned")
    return stage(db.key_frames(sy.cut_scenes(planned, params(spark, sf)), _build(spark, sf)), "keys")


def _rows(spark, sf, keys):
    return stage(db.sample_data_rows(recording(spark, sf), keys, _build(spark, sf), _poses(spark, sf)), "rows")


@query(
    _KEYS
    + """select token, at as timestamp, scene_token, coalesce(lag(token) over w, '') as prev, coalesce(lead(token) over w, '') as next
from kf window w as (partition by scene_token order by at)"""
)
def build_samples(spark, sf):
    return db.sample_table(_keys(spark, sf), _build(spark, sf))


@query(
    _KEYS
    + """select scene_token as token, 'scene-all-' || min(at) as name, '' as description, sha256('log/all') as log_token,
cast(count(*) as integer) as nbr_samples, arg_min(token, at) as first_sample_token, arg_max(token, at) as last_sample_token from kf group by scene_token"""
)
def build_scenes(spark, sf):
    return db.scene_table(_keys(spark, sf), _build(spark, sf))


_DATA = (
    _KEYS
    + f""", sp as (select scene_token, min(at) as s, max(at) as e from kf group by scene_token),
ins as (select scene_token, event_type as channel, epoch_us(ts) as at, null as key_token from events join sp on epoch_us(ts) between s and e),
own as (select scene_token, 'click' as channel, at, token, at as sat from kf union all select scene_token, 'view', view, token, at from kf
  union all select scene_token, 'purchase', purchase, token, at from kf union all select scene_token, 'signup', signup, token, at from kf),
er as (select epoch_us(ts) as t from events where event_type = 'error'),
el as (select kf.*, er.t as lo from kf asof left join er on kf.at >= er.t),
eh as (select el.*, er.t as hi from el asof left join er on el.at <= er.t),
en as (select *, case when lo is not null and (hi is null or at - lo <= hi - at) then lo else hi end as m from eh),
ek as (select scene_token, 'error' as channel, m as at, arg_max(token, at) as key_token from en where abs(m - at) <= {HOUR} group by scene_token, m),
ks as (select scene_token, channel, at, arg_max(token, sat) as key_token from own group by all union all select * from ek),
al as (select scene_token, channel, at, max(key_token) as key_token from (select * from ins union all select * from ks) group by all),
fo as (select al.*, kf.token as ftok from al asof left join kf on al.scene_token = kf.scene_token and al.at <= kf.at),
la as (select scene_token, arg_max(token, at) as ltok from kf group by scene_token),
rw as (select fo.scene_token, channel, at, coalesce(key_token, ftok, ltok) as sample_token, key_token is not null as is_key_frame,
  sha256('data/' || fo.scene_token || '/' || channel || '/' || at) as token from fo join la on fo.scene_token = la.scene_token)
"""
)


@query(
    _DATA
    + """select token, sample_token, sha256('pose/' || scene_token || '/' || channel || '/' || at) as ego_pose_token, sha256('calibrated/' || channel) as calibrated_sensor_token,
case when is_key_frame then 'samples' else 'sweeps' end || '/' || channel || '/' || token || case channel when 'click' then '.pcd.bin' when 'error' then '.pcd' else '.jpg' end as filename,
case when channel in ('click', 'error') then 'pcd' else 'jpg' end as fileformat, is_key_frame, case when channel = 'view' then 1080 else 0 end as height,
case when channel = 'view' then 1920 else 0 end as width, at as timestamp, coalesce(lag(token) over w, '') as prev, coalesce(lead(token) over w, '') as next
from rw window w as (partition by scene_token, channel order by at)"""
)
def build_sample_data(spark, sf):
    return db.sample_data_table(_rows(spark, sf, _keys(spark, sf)), _build(spark, sf))


def _poses(spark, sf):
    e = events(spark, sf)
    half = F.radians(F.get_json_object("props", "$.k").cast("double") * 3.6) / 2
    return e.select(
        F.lit("all").alias("log"), "at", F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"),
        F.lit(0.0).alias("z"), F.cos(half).alias("qw"), F.lit(0.0).alias("qx"), F.lit(0.0).alias("qy"), F.sin(half).alias("qz"),
    )


@query(
    _DATA
    + """, po as (select epoch_us(ts) as t, value as x, (props ->> '$.k')::double as y, cos(radians((props ->> '$.k')::double * 3.6) / 2) as qw, sin(radians((props ->> '$.k')::double * 3.6) / 2) as qz from events)
select sha256('pose/' || scene_token || '/' || channel || '/' || at) as token, round(x, 6) as x, round(y, 6) as y, round(qw, 6) as qw, round(qz, 6) as qz, at as timestamp
from rw join po on rw.at = po.t"""
)
def build_ego_poses(spark, sf):
    keys = _keys(spark, sf)
    p = db.ego_pose_rows(_rows(spark, sf, keys), keys.select("log", "scene_token").distinct(), _poses(spark, sf), _build(spark, sf))
    return p.select("token", r6("x").alias("x"), r6("y").alias("y"), r6("qw").alias("qw"), r6("qz").alias("qz"), "timestamp")


@query(
    _DATA
    + """select 0::bigint as n_problems, (select count(distinct scene_token) from kf) as n_scenes, (select count(*) from kf) as n_samples, (select count(*) from rw) as n_data"""
)
def dataset_audit(spark, sf):
    f = recording(spark, sf)
    planned = stage(sy.plan_frames(f, params(spark, sf)), "planned")
    scenes = stage(sy.cut_scenes(planned, params(spark, sf)), "scenes")
    calib = spark.createDataFrame(
        [(c, [0.0] * 3, [1.0, 0.0, 0.0, 0.0], []) for c in _build(spark, sf).channels()],
        "channel string, translation array<double>, rotation array<double>, camera_intrinsic array<array<double>>",
    )
    t = {k: stage(v, k) for k, v in db.build_tables(f, _poses(spark, sf), scenes, calib, _build(spark, sf)).items()}
    bad = audit.dataset_problems(t).agg(F.count(F.lit(1)).alias("n_problems"))
    one = bad.withColumn("k", F.lit(1))
    for name, df in (("n_scenes", t["scene"]), ("n_samples", t["sample"]), ("n_data", t["sample_data"])):
        one = one.join(df.agg(F.count(F.lit(1)).alias(name)).withColumn("k", F.lit(1)), "k")  # one row each
    return one.drop("k")


# child table, column, parent table, key
_FKS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("events", "user_id", "supplier", "s_suppkey"),
]


@query(
    " union all ".join(
        f"select '{c}.{k}' as fk, count(*) as n_orphans from {c} where {k} not in (select {pk} from {p})" for c, k, p, pk in _FKS
    )
)
def fk_audit(spark, sf):
    out = None
    for c, k, p, pk in _FKS:
        n = audit.orphans(table(spark, sf, c).select(k), k, table(spark, sf, p).select(pk), pk)
        row = n.agg(F.count(F.lit(1)).alias("n_orphans")).select(F.lit(f"{c}.{k}").alias("fk"), "n_orphans")
        out = row if out is None else out.unionByName(row)
    return out


_CHAIN = """
with c as (select conv_id || '/' || turn as token, case when turn = 0 then '' else conv_id || '/' || (turn - 1) end as prev,
  case when role = 'user' then conv_id || '/' || (turn + 1) else '' end as next from conversations)
"""


@query(
    _CHAIN
    + """select c.token, 'prev' as side from c left join c o on c.prev = o.token where c.prev <> '' and (o.token is null or o.next <> c.token)
union all select c.token, 'next' from c left join c o on c.next = o.token where c.next <> '' and (o.token is null or o.prev <> c.token)"""
)
def chain_integrity(spark, sf):
    c = table(spark, sf, "conversations")
    tok = lambda d: F.concat(F.col("conv_id").cast("string"), F.lit("/"), (F.col("turn") + d).cast("string"))
    chain = c.select(
        tok(0).alias("token"), F.when(F.col("turn") == 0, "").otherwise(tok(-1)).alias("prev"),
        F.when(F.col("role") == "user", tok(1)).otherwise("").alias("next"),
    )
    return audit.broken_links(chain, "token", "prev", "next")


@query(
    """
with d as (select c_custkey from customer where c_nationkey = 7),
o as (select * from orders where o_custkey not in (select c_custkey from d)),
l as (select * from lineitem where l_orderkey in (select o_orderkey from o)),
p as (select * from part where p_partkey in (select l_partkey from l))
select 'customer' as tbl, (select count(*) from customer where c_nationkey <> 7) as n, round((select sum(c_acctbal) from customer where c_nationkey <> 7), 2) as total
union all select 'orders', count(*), round(sum(o_totalprice), 2) from o
union all select 'lineitem', count(*), round(sum(l_quantity), 2) from l
union all select 'part', count(*), round(sum(p_retailprice), 2) from p"""
)
def prune_cascade(spark, sf):
    cust = table(spark, sf, "customer")
    gone = cust.where("c_nationkey = 7").select("c_custkey")
    orders = mutate.anti(table(spark, sf, "orders"), "o_custkey", gone, "c_custkey")
    lost = mutate.semi(table(spark, sf, "orders"), "o_custkey", gone, "c_custkey")
    lines = mutate.anti(table(spark, sf, "lineitem"), "l_orderkey", lost, "o_orderkey")
    parts = mutate.semi(table(spark, sf, "part"), "p_partkey", lines, "l_partkey")
    out = None
    for name, df, v in (("customer", mutate.anti(cust, "c_custkey", gone, "c_custkey"), "c_acctbal"), ("orders", orders, "o_totalprice"),
                        ("lineitem", lines, "l_quantity"), ("part", parts, "p_retailprice")):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(v), 2).alias("total")).select(F.lit(name).alias("tbl"), "n", "total")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    """
with n as (select c_name, row_number() over (order by c_name) as r from customer),
s as (select c_name, row_number() over (order by c_name) as r from customer where c_mktsegment <> 'HOUSEHOLD')
select s.c_name as name, n.c_name as new_name from s join n using (r)"""
)
def renumber_names(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_mktsegment")
    return mutate.renumber(c.select("name"), c.where("c_mktsegment <> 'HOUSEHOLD'").select("name"), "name")


@query(
    """
with k as (select l_orderkey, list_sort(list(l_linenumber)) as key from lineitem group by l_orderkey),
g as (select key, count(*) as n, min(l_orderkey) as first_scene, max(l_orderkey) as last_scene from k group by key)
select array_to_string(key, ',') as key, n, first_scene, last_scene from g where n > 1"""
)
def twin_match(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    keys = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("lines"))
    g = keys.groupBy(F.array_join(F.transform("lines", lambda x: x.cast("string")), ",").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_scene"), F.max("l_orderkey").alias("last_scene")
    )
    return g.where("n > 1")


_STATE = """
with s as (select doc_id, source from documents), l as (select doc_id from labels where toxic = 1),
h as (select doc_id, case when quality = 1 then 'keep' else 'drop' end as decision from labels),
c as (select doc_id, case when n_chars < 200 then 'few' else 'long' end as kind from documents where n_chars < 200 or n_chars > 5000),
t as (select s.*, coalesce(case when l.doc_id is not null then 'locked' end, h.decision, c.kind, 'pass') as state from s left join l using (doc_id) left join h using (doc_id) left join c using (doc_id))
"""


def _states(spark, sf):
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    human = lab.select("doc_id", F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("decision"))
    cand = d.where("n_chars < 200 or n_chars > 5000").select("doc_id", F.when(F.col("n_chars") < 200, "few").otherwise("long").alias("kind"))
    return mutate.scene_state(d.select("doc_id", "source"), lab.where("toxic = 1").select("doc_id"), human, cand, "doc_id")


@query(_STATE + "select doc_id, source, state from t")
def scene_state(spark, sf):
    return _states(spark, sf)


@query(
    _STATE
    + """select source, count(*) as n, count(*) filter (state = 'locked') as locked, count(*) filter (state = 'keep') as keep, count(*) filter (state = 'drop') as drop,
count(*) filter (state = 'few') as few, count(*) filter (state = 'long') as long, count(*) filter (state = 'pass') as pass from t group by source"""
)
def state_counts(spark, sf):
    s = _states(spark, sf)
    return s.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("state") == k).alias(k) for k in ("locked", "keep", "drop", "few", "long", "pass")]
    )


@query(
    """
select c_name as name, c_custkey::varchar as token, case when c_acctbal < 0 and c_mktsegment = 'BUILDING' then case when c_nationkey in (1, 2, 3) then 'held' else 'delete' end else 'stay' end as action
from customer"""
)
def deletion_plan(spark, sf):
    c = table(spark, sf, "customer")
    scenes = c.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("token"), F.col("c_mktsegment").alias("log_token"))
    decisions = c.select(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") < 0, "drop").otherwise("keep").alias("decision"))
    locked = c.where("c_nationkey in (1, 2, 3)").select(F.col("c_custkey").cast("string").alias("token"))
    logs = spark.createDataFrame([("BUILDING",)], "log_token string")
    return mutate.deletion_plan(scenes, decisions, locked, logs)


@query(
    """
with s as (select o_orderkey::varchar as token, o_orderpriority as name, o_orderstatus, o_totalprice, o_custkey from orders)
select token, name, case when o_orderstatus = 'P' then 'dropped already' when o_totalprice < 100000 then 'not published'
when o_custkey not in (select c_custkey from customer where c_acctbal > 0) then 'not locked'
when token not in (select l_orderkey::varchar from lineitem where l_returnflag = 'R') then 'no twin in the full set' else 'go' end as reason from s"""
)
def drop_plan(spark, sf):
    o = table(spark, sf, "orders").withColumn("token", F.col("o_orderkey").cast("string"))
    rich = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    twins = o.join(returned, o["o_orderkey"] == returned["l_orderkey"], "left_semi").select("token", F.col("o_orderpriority").alias("name"))
    return mutate.drop_plan(
        o.select("token", F.col("o_orderpriority").alias("name")), o.where("o_orderstatus = 'P'"), o.where("o_totalprice >= 100000"),
        o.join(rich, "o_custkey", "left_semi"), twins,
    )


@query(
    """
with h as (select doc_id, sha256(text) as digest, octet_length(encode(text)) as b from documents)
select digest, min(doc_id) as keep, count(*) as copies, max(b)::bigint as bytes from h group by digest"""
)
def content_dedup(spark, sf):
    return mutate.content_groups(table(spark, sf, "documents"), "doc_id", "text")


@query(
    """
with a as (select conv_id, turn, octet_length(encode(text)) as size, sha256(text) as digest from conversations),
b as (select conv_id, turn, octet_length(encode(trim(text))) as size, sha256(trim(text)) as digest from conversations where role = 'user')
select a.conv_id, a.turn, case when b.size is null then 'no twin' when b.size <> a.size then 'size differs' when b.digest <> a.digest then 'bytes differ' else 'identical' end as twin
from a left join b using (conv_id, turn)"""
)
def blob_twins(spark, sf):
    c = table(spark, sf, "conversations")

    def hashed(df, text):
        return df.select("conv_id", "turn", F.octet_length(text).alias("size"), F.sha2(text.cast("binary"), 256).alias("digest"))

    a = hashed(c, F.col("text"))
    b = hashed(c.where("role = 'user'"), F.btrim("text", F.lit(" ")))
    return mutate.identical_blobs(a, b, ["conv_id", "turn"], "size", "digest").select("conv_id", "turn", "twin")


@query(
    """
with m as (select url as path, sha256(html) as sha256 from pages), s as (select url as path, sha256(trim(html)) as sha256 from pages where length(html) > 1000)
select path, sha256 from m where (path, sha256) not in (select (path, sha256) from s)"""
)
def outdated_shards(spark, sf):
    p = table(spark, sf, "pages")
    m = p.select(F.col("url").alias("path"), F.sha2(F.col("html").cast("binary"), 256).alias("sha256"))
    s = p.where("length(html) > 1000").select(F.col("url").alias("path"), F.sha2(F.btrim("html", F.lit(" ")).cast("binary"), 256).alias("sha256"))
    return mutate.outdated_shards(m, s)


@query(
    """
select l_orderkey, l_linenumber, arg_min(l_partkey, (l_returnflag = 'N', l_shipdate, l_partkey)) as l_partkey from lineitem group by l_orderkey, l_linenumber"""
)
def trusted_first(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") != "N").alias("trusted"), F.struct("l_shipdate", "l_partkey").alias("seq"))
    return mutate.trusted_first(li, ["l_orderkey", "l_linenumber"], "trusted", "seq").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """
select c_custkey, c_name from customer where c_name not in (select 'Customer#' || lpad(o_custkey::varchar, 9, '0') from orders where o_orderstatus = 'P')
and c_custkey not in (161, 162, 163)"""
)
def free_names(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    used = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("c_name"))
    return mutate.free_names(c, used, "c_name", [161, 162, 163], F.col("c_custkey")).select("c_custkey", "c_name")


@query(
    """
select r_name, n_name, c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as balance from customer join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey group by rollup(r_name, n_name, c_mktsegment)"""
)
def rollup_counts(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey"))
    j = c.join(n, "c_nationkey").join(table(spark, sf, "region"), "r_regionkey")
    return j.rollup("r_name", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
