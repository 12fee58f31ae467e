"""Selection: quotas, shares, covers, components, greedy passes, packing, agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackloom.functions.clock import as_micros
from trackloom.operators import cover, graph, pairs, quota, series
from trackloom.operators.ordered import Axis, prev, scan
from trackloom.queries.registry import DAY, events, fitted, query, r6, table
from trackloom.session import stage


@query(
    """
with r as (select n_nationkey, count(c_custkey) as n, n_nationkey in (3, 10) as fixed from nation left join customer on c_nationkey = n_nationkey group by n_nationkey),
c as (select *, sum(case when fixed then 0 else n end) over (order by n_nationkey) as cum, case when fixed then 0 else n end as m from r)
select n_nationkey, n, fixed, cast(cum // 3 - (cum - m) // 3 as bigint) as quota from c"""
)
def quota_with_carry(spark, sf):
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    routes = table(spark, sf, "nation").select("n_nationkey").join(c, "n_nationkey", "left").fillna(0, ["n"])
    routes = routes.withColumn("fixed", F.col("n_nationkey").isin(3, 10)).withColumn("order", F.col("n_nationkey").cast("long"))
    return quota.quota_with_carry(routes, "order", "n", "fixed").drop("order")


_SHARES = """
with a as (select c_mktsegment, count(*) as n from customer group by c_mktsegment),
t as (select *, 100 * sqrt(n) / sum(sqrt(n)) over () as target from a)
"""


@query(_SHARES + "select c_mktsegment, n, round(target, 6) as target from t")
def target_share_gamma(spark, sf):
    a = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return quota.target_shares(a, "c_mktsegment", "n", 0.5, 100.0).select("c_mktsegment", "n", r6("target").alias("target"))


@query(
    """
with recursive p as (select l_returnflag || l_linestatus as g, count(*) as n from lineitem group by 1),
a as (select g, n, row_number() over (order by g) as id, 0.4 * n as target, 2 as hold from p),
lim as (select cast(floor(sum(n) / 200) as bigint) as q from a),
j as (select g, n, target, unnest(range(1, n - 1)) as j from a),
r as (select g, row_number() over (order by -(n - j + 1 - target), -(n - j + 1), g) as rk from j),
d as (select g, count(*) as k from r, lim where rk <= q group by g)
select a.g, n, coalesce(k, 0) as n_deleted from a left join d using (g)"""
)
def deletions_per_group(spark, sf):
    li = table(spark, sf, "lineitem")
    n = li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("target", 0.4 * F.col("n")).withColumn("hold", F.lit(2))
    q = int(li.count() // 200)
    return quota.deletions_per_group(n, "g", "n", "target", "hold", q).select("g", "n", "n_deleted")


@query(
    """select p_type, p_brand, count(*) as n_input, count(*) filter (p_size > 45) as n_kept, count(*) filter (p_size > 45) = 0 as lost from part group by p_type, p_brand"""
)
def coverage_before_after(spark, sf):
    p = table(spark, sf, "part").withColumn("kept", F.col("p_size") > 45)
    return quota.type_coverage(p, ["p_type", "p_brand"], "kept")


@query(
    """
with b as (select s_nationkey, arg_max(s_name, (s_acctbal, s_name)) as rep from supplier group by s_nationkey)
select s_suppkey, rep, s_name <> rep as candidate from supplier join b using (s_nationkey)"""
)
def stop_duplicates(spark, sf):
    s = table(spark, sf, "supplier")
    return quota.keep_most_active(s, ["s_nationkey"], "s_name", "s_acctbal").select("s_suppkey", "rep", "candidate")


@query(
    """
select p_partkey, case when p_size + p_retailprice / 100 < 20 then 'low' when p_size + p_retailprice / 100 < 45 then 'mid' else 'high' end
|| case when p_retailprice / 100 >= 15 then '+ped' else '' end as kind from part"""
)
def traffic_types(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_retailprice") / 100).alias("people"))
    return p.select("p_partkey", quota.traffic_type("p_size", "people", (20, 45), 15).alias("kind"))


def _neighbours(spark, sf, within):
    """Each order and the customer's previous one, if not more than `within` days apart."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", as_micros("o_orderdate").alias("at"))
    s = scan(o, Axis(("o_custkey",), "at", fitted(o, "o_custkey"), ("o_orderkey",)), {"p": prev("o_orderkey"), "pt": prev("at")})
    return o, s.where(F.col("at") - F.col("pt") <= within * DAY).select("o_orderkey", "p")


@query(
    """
with recursive o as (select o_orderkey, o_custkey, o_totalprice, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rk,
  lag(o_orderkey) over w as p, lag(o_orderdate) over w as pt, lead(o_orderkey) over w as n, lead(o_orderdate) over w as nt, o_orderdate
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)),
e as (select o_orderkey, o_custkey, rk, case when o_orderdate - pt <= interval 100 day then p end as p, case when nt - o_orderdate <= interval 100 day then n end as n from o),
k as (select o_custkey, 1 as rk, [o_orderkey] as kept from e where rk = 1
 union all select e.o_custkey, e.rk, case when coalesce(list_contains(k.kept, e.p), false) or coalesce(list_contains(k.kept, e.n), false) then k.kept else list_append(k.kept, e.o_orderkey) end
 from k join e on e.o_custkey = k.o_custkey and e.rk = k.rk + 1),
f as (select unnest(arg_max(kept, rk)) as o_orderkey from k group by o_custkey)
select e.o_orderkey, f.o_orderkey is not null as kept from e left join f using (o_orderkey)"""
)
def greedy_overlap(spark, sf):
    o, e = _neighbours(spark, sf, 100)
    both = e.select(F.col("o_orderkey").alias("a"), F.col("p").alias("b")).unionByName(e.select(F.col("p").alias("a"), F.col("o_orderkey").alias("b")))
    nodes = o.select("o_orderkey", F.struct((-F.col("o_totalprice")).alias("v"), "o_orderkey").alias("rank"))
    return graph.greedy_keep(nodes, both, "o_orderkey", "rank", "a", "b")


@query(
    """
with o as (select o_orderkey, o_custkey, o_orderdate, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as pt from orders),
g as (select *, sum(case when pt is null or o_orderdate - pt > interval 200 day then 1 else 0 end) over (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding) as run from o)
select o_orderkey, min(o_orderkey) over (partition by o_custkey, run) as component from g"""
)
def components(spark, sf):
    o, e = _neighbours(spark, sf, 200)
    return graph.components(o, e, "o_orderkey", "o_orderkey", "p")


_PTS = """
with pt as (select user_id as s, event_id as i, c_nationkey * 10000 + epoch_us(ts) / 3600000000 % 10000 as x, value / 50 as y,
  case event_type when 'click' then 0 when 'view' then 30 when 'purchase' then 60 when 'signup' then 90 else 350 end::double as h
  from events join customer on user_id = c_custkey)
"""


def _points(spark, sf):
    """Event paths: every nation a region of its own, hours along it, the event type as heading."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    h = F.lit(350.0)
    for name, deg in (("click", 0.0), ("view", 30.0), ("purchase", 60.0), ("signup", 90.0)):
        h = F.when(F.col("event_type") == name, deg).otherwise(h)
    return events(spark, sf).join(c, "user_id").select(
        "user_id", "event_id", (F.col("c_nationkey") * 10000 + F.col("at") / 3_600_000_000 % 10000).alias("x"), (F.col("value") / 50).alias("y"), h.alias("h")
    )


_COVER = (
    _PTS
    + """, d as (select a.s as a, a.i, b.s as b, b.i as j, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) as d, a.h as h, b.h as h2 from pt a join pt b on a.s <> b.s
  and b.x between a.x - 6 and a.x + 6 and b.y between a.y - 6 and a.y + 6),
n as (select a, b, i, arg_min({'d': d, 'h': h, 'h2': h2}, (d, j)) as m from d group by a, b, i),
ok as (select a, b, count(*) filter (m.d <= 6 and abs(((m.h - m.h2 + 180) % 360 + 360) % 360 - 180) <= 30) as k from n group by a, b),
z as (select s, count(*) as n from pt group by s),
cov as (select a, b, k / n as cover from ok join z on a = s where k / n >= 0.45)
"""
)


@query(_COVER + "select a, b, round(cover, 6) as cover from cov")
def pair_cover(spark, sf):
    c = pairs.place_cover(_points(spark, sf), "user_id", "event_id", "x", "y", "h", 6.0, 30.0, 0.45)
    return c.select("a", "b", r6("cover").alias("cover"))


_EGO = """
with e as (select user_id, value, epoch_us(ts) as at from events), f as (select user_id, min(at) as t0 from e group by 1),
s as (select user_id, unnest(range(5)) as w from f),
m as (select e.user_id, (at - t0) // 518400000000 as w, avg(value) as v, avg(sqrt(value)) as u from e join f using (user_id) group by 1, 2),
ego as (select s.user_id, list(coalesce(v, 0) order by s.w) as win_v, list(coalesce(u, 0) order by s.w) as win_w from s left join m on s.user_id = m.user_id and s.w = m.w group by s.user_id)
"""


def _ego(spark, sf):
    e = events(spark, sf).select("user_id", "at", F.col("value").alias("v"), F.sqrt("value").alias("u"))
    e = e.join(e.groupBy("user_id").agg(F.min("at").alias("t0")), "user_id")
    w = series.window_means(e, ["user_id"], "at", ["v", "u"], F.col("t0"), 6 * DAY, 5)
    rows = w.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("window", "v", "u"))).alias("r"))  # five windows
    return rows.select("user_id", F.transform("r", lambda s: s["v"]).alias("win_v"), F.transform("r", lambda s: s["u"]).alias("win_w"))


@query(_EGO + """select user_id, round(sqrt((select avg(x) * 5 from (select unnest(list_transform(list_zip(win_v, [v for v in win_v[2:]] || [win_v[1]]), lambda z: ((z[1] - z[2]) / 5) ** 2)) as x)
) / 5 + (select avg(x) * 5 from (select unnest(list_transform(list_zip(win_w, [v for v in win_w[2:]] || [win_w[1]]), lambda z: ((z[1] - z[2]) / 2) ** 2)) as x)) / 5), 6) as distance from ego""")
def ego_distance(spark, sf):
    """Each scene against itself shifted by one window."""
    e = _ego(spark, sf)
    shift = lambda c: F.concat(F.slice(c, 2, 4), F.slice(c, 1, 1))
    e = e.select("user_id", "win_v", "win_w", shift("win_v").alias("v2"), shift("win_w").alias("w2"))
    return e.select("user_id", r6(pairs.ego_distance("win_v", "win_w", "v2", "w2")).alias("distance"))


@query(
    _COVER.replace("with pt", "with recursive pt")
    + ", "
    + _EGO.strip()[5:]
    + """, st as (select c.a, c.b from cov c join cov r on c.a = r.b and c.b = r.a join ego p on p.user_id = c.a join ego q on q.user_id = c.b
 where sqrt((list_sum(list_transform(list_zip(p.win_v, q.win_v), lambda z: ((z[1] - z[2]) / 5) ** 2)) + list_sum(list_transform(list_zip(p.win_w, q.win_w), lambda z: ((z[1] - z[2]) / 2) ** 2))) / 5) <= 4),
reach as (select a as n, a as r from st union select st.b, reach.r from reach join st on st.a = reach.n),
cc as (select n as user_id, min(r) as component from reach group by n)
select user_id, component from cc"""
)
def same_place_groups(spark, sf):
    pts = _points(spark, sf)
    cover = stage(pairs.place_cover(pts, "user_id", "event_id", "x", "y", "h", 6.0, 30.0, 0.45), "cover")
    ego = stage(_ego(spark, sf), "ego")
    return pairs.same_place_groups(cover, ego, pts, "user_id", 0.45, 4.0)


@query(
    """
select a.p_partkey as a, b.p_partkey as b, round(sqrt((((a.p_size - b.p_size) / 10.0) ** 2 + ((a.p_retailprice - b.p_retailprice) / 5) ** 2) / 2), 6) as behaviour,
round(sqrt((((ln(1 + a.p_size) - ln(1 + b.p_size)) / 0.35) ** 2 + ((ln(1 + a.p_retailprice) - ln(1 + b.p_retailprice)) / 0.7) ** 2) / 2), 6) as composition,
round(abs(ln((a.p_size + 20) / (b.p_size + 20))), 6) as activity
from part a join part b on b.p_partkey = a.p_partkey + 1"""
)
def pair_distance(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.struct("p_size", "p_retailprice").alias("s"))
    a = p.select(F.col("p_partkey").alias("a"), F.col("s").alias("sa"), (F.col("p_partkey") + 1).alias("b"))
    j = a.join(p.select(F.col("p_partkey").alias("b"), F.col("s").alias("sb")), "b")
    sa, sb = F.col("sa"), F.col("sb")
    return j.select(
        "a", "b", r6(pairs.behaviour_distance("sa", "sb", {"p_size": 10.0, "p_retailprice": 5.0})).alias("behaviour"),
        r6(pairs.composition_distance(sa["p_size"], sa["p_retailprice"], sb["p_size"], sb["p_retailprice"])).alias("composition"),
        r6(pairs.activity_distance(sa["p_size"], sb["p_size"])).alias("activity"),
    )


_CENTROIDS = {
    "night": [0.5 if i < 4 else 0.0 for i in range(64)],
    "day": [0.5 if i >= 60 else 0.0 for i in range(64)],
}


@query(
    """
with d as (select vec_id, 50 * (embedding[1]::double + embedding[2] + embedding[3] + embedding[4]) as n, 50 * (embedding[61]::double + embedding[62] + embedding[63] + embedding[64]) as d from embeddings)
select vec_id, round(1 / (1 + exp(d - n)), 6) as night, round(1 / (1 + exp(n - d)), 6) as day from d"""
)
def zero_shot_softmax(spark, sf):
    z = pairs.zero_shot(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", _CENTROIDS)
    return z.select("vec_id", r6("night").alias("night"), r6("day").alias("day"))


_FILL = """
with recursive c as (select c_nationkey, c_custkey, cast(floor(c_acctbal + 1001) as bigint) as w, row_number() over (partition by c_nationkey order by c_custkey) as rn from customer),
k as (select c_nationkey, c_custkey, rn, w as acc, 0::bigint as part from c where rn = 1
 union all select c.c_nationkey, c.c_custkey, c.rn, case when k.acc + c.w > 20000 then c.w else k.acc + c.w end, case when k.acc + c.w > 20000 then k.part + 1 else k.part end
 from k join c on c.c_nationkey = k.c_nationkey and c.rn = k.rn + 1)
"""


def _packed(spark, sf):
    return table(spark, sf, "customer").select("c_nationkey", "c_custkey", F.floor(F.col("c_acctbal") + 1001).cast("long").alias("w"))


@query(_FILL + "select c_nationkey, c_custkey, part from k")
def contiguous_fill(spark, sf):
    items = _packed(spark, sf).withColumn("bound", F.lit(20_000).cast("long"))
    return quota.fill_starts(items, ["c_nationkey"], "c_custkey", "w", "bound", 256, 100_000).select("c_nationkey", "c_custkey", "part")


@query(
    """
with d as (select doc_id, n_chars > 500 as removed from documents), l as (select doc_id, quality = 0 as dup from labels), j as (select * from d join l using (doc_id)),
c as (select count(*) as n_labeled, count(*) filter (removed and dup) as tp, count(*) filter (removed and not dup) as fp, count(*) filter (not removed and dup) as fn from j)
select *, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c"""
)
def agreement_f1(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 500).alias("removed"))
    lab = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("dup"))
    a = quota.agreement(d, lab, "doc_id", "removed", "dup")
    return a.select("n_labeled", "tp", "fp", "fn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query(
    """
with g as (select lo, hi from (values (100.0::double), (300.0), (500.0)) a(lo), (values (1000.0::double), (2000.0), (5000.0)) b(hi)),
j as (select lo, hi, d.n_chars between lo and hi as rm, l.quality = 0 as dup from documents d join labels l using (doc_id), g),
c as (select lo, hi, count(*) filter (rm and dup) as tp, count(*) filter (rm and not dup) as fp, count(*) filter (not rm and dup) as fn from j group by lo, hi)
select *, round(case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end, 6) as f1 from c"""
)
def parameter_sweep(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("dup"))
    s = quota.sweep(
        d, {"lo": [100, 300, 500], "hi": [1000, 2000, 5000]}, lambda p: F.col("n_chars").between(p["lo"], p["hi"]), lab, "doc_id", "dup"
    )
    return s.select("lo", "hi", "tp", "fp", "fn", r6("f1").alias("f1"))


@query(
    """
with a as (select distinct c_nationkey as n, o_orderpriority as p, o_custkey from orders join customer on o_custkey = c_custkey),
x as (select p, count(distinct o_custkey) as n_a from a group by p),
i as (select count(distinct o_custkey) as n_i from a where p = '1-URGENT' and o_custkey in (select o_custkey from a where p = '5-LOW'))
select n_i as both, (select n_a from x where p = '1-URGENT') + (select n_a from x where p = '5-LOW') - n_i as either,
round(n_i / ((select n_a from x where p = '1-URGENT') + (select n_a from x where p = '5-LOW') - n_i), 6) as jaccard from i"""
)
def jaccard(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    m = o.groupBy("o_custkey").agg(
        F.max(F.col("o_orderpriority") == "1-URGENT").alias("u"), F.max(F.col("o_orderpriority") == "5-LOW").alias("l")
    )
    c = m.agg(F.count_if(F.col("u") & F.col("l")).alias("both"), F.count_if(F.col("u") | F.col("l")).alias("either"))
    return c.select("both", "either", r6(F.col("both") / F.col("either")).alias("jaccard"))


@query(
    """
with recursive n as (select c_nationkey as k, count(*) as n from customer group by 1),
o as (select *, row_number() over (order by k) as rn from n),
lim as (select cast(floor(sum(n) / 3) as bigint) as room from n),
w as (select 0::bigint as rn, room as left_, 0::integer as k, 0::bigint as n, false as took from lim
 union all select o.rn, case when o.n <= w.left_ then w.left_ - o.n else w.left_ end, o.k, o.n, o.n <= w.left_ from w join o on o.rn = w.rn + 1)
select k, n from w where took"""
)
def first_fit(spark, sf):
    c = table(spark, sf, "customer")
    n = c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).withColumn("o", F.col("k").cast("long"))
    return quota.first_fit(n, "o", "n", int(c.count() // 3), 8).select("k", "n")


@query(
    """
select n_name, count(*) as n, epoch_us(min(o_orderdate)) as first_at, row_number() over (order by min(o_orderdate), n_name) as rank
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name"""
)
def log_order(spark, sf):
    from trackloom.operators.mutate import numbered

    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    o = table(spark, sf, "orders").select("o_custkey", as_micros("o_orderdate").alias("at")).join(c, "o_custkey")
    j = o.join(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    g = j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))
    return numbered(g, ["first_at", "n_name"])


@query()
def group_representatives(spark, sf):
    """Parts of a brand as scenes of one place. Two parts in one order are labelled the same if their lines went the same way.

    Each pick depends on all earlier ones of its group, which SQL cannot say; tests hold the operator against a pass over
    each group."""
    p = table(spark, sf, "part").select("p_brand", "p_partkey", "p_size", "p_retailprice", (F.length("p_name") * 1.0).alias("name_length"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    brands = p.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = stage(li.join(brands, "l_partkey"), "lines")  # parts of different brands are never compared
    other = li.select("l_orderkey", "p_brand", F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("b"), F.col("l_returnflag").alias("flag"))
    labels = li.join(other, ["l_orderkey", "p_brand"]).where("l_linenumber < n and l_partkey <> b").select(  # the few lines of an order
        F.col("l_partkey").alias("a"), "b", (F.col("l_returnflag") == F.col("flag")).alias("same")
    )
    out = cover.representatives(p, labels, "p_brand", "p_partkey", {"p_size": 6.0, "p_retailprice": 150.0, "name_length": 4.0})
    return out.select("p_brand", "p_partkey", "status", "ref", "place", "human")
