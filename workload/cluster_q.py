"""Clustering queries."""

from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import cluster as K, density as D
from tablescope.plans.views import multi_view_cluster

from .core import query

DIMS = [f"d{i}" for i in range(64)]
E10, RG, LD = ("emb",), ("regime",), ("li_dirty",)


@query("cluster_feature_pick", " union all ".join(
    f"""select '{c}' as "column", count(distinct {c}) as unique_count from li_dirty""" for c in
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_tax_n l_disc_n revenue".split()), LD)
def _(t):
    return K.feature_pick(t.li_dirty, "charge")


PSI = "case when value >= 0 then case when abs(lam) < 1e-9 then ln(1 + value) else (pow(value + 1, lam) - 1) / lam end else case when abs(lam - 2) < 1e-9 then -ln(1 - value) else -(pow(1 - value, 2 - lam) - 1) / (2 - lam) end end"


def lam_round(i, reach, count, prev):
    mid = f"(select lam from b{i - 1})" if prev else "0.0"
    return f"""g{i} as (select round_even({mid} + ({-reach!r} + {2 * reach!r} * k / {count - 1}), 6) as lam from (select unnest(generate_series(0, {count - 1})) as k)),
  s{i} as (select lam, -count(*) / 2.0 * ln(var_pop({PSI})) + (lam - 1) * sum(sign(value) * ln(1 + abs(value))) as ll from g{i}, events group by lam),
  b{i} as (select lam from s{i} order by ll desc, abs(lam) limit 1)"""


@query("yeo_johnson", "with " + ", ".join([lam_round(1, 5.0, 41, False), lam_round(2, 0.25, 21, True), lam_round(3, 0.025, 21, True)]) +
       f""", p as (select event_id, {PSI} as psi from events, b3), m as (select avg(psi) a, stddev_pop(psi) s from p)
 select event_id, round_even((select lam from b3), 4) as lam, round_even((psi - a) / s, 6) as value from p, m""")
def _(t):
    lam = K.power_lambdas(t.events, ["value"])
    d = K.power_transform(t.events.select("event_id", "value"), ["value"], lam)
    return d.select("event_id", rnd(F.lit(lam["value"]), 4).alias("lam"), rnd(F.col("value"), 6).alias("value"))


def space(t):
    """Ten principal components of all dimensions: full covariances of all of
    them need more rows than the smallest tables have."""
    return K.principal_space(t.emb, "vec_id", DIMS, 10)


SPACE = [f"e{i}" for i in range(10)]


@query("gmm_labels")
def _(t):
    return K.gmm_labels(space(t), "vec_id", SPACE, 4)


@query("cluster_count_scan")
def _(t):
    return K.cluster_count_scan(space(t), SPACE)


@query("silhouette_scan")
def _(t):
    return K.silhouette_scan(space(t), "vec_id", SPACE)


@query("kprototypes_labels")
def _(t):
    return K.kprototypes_labels(t.part, "p_partkey", ["p_size", "p_retailprice"], ["p_type", "p_brand"], 4)


@query("find_clusters")
def _(t):
    return K.find_clusters(t.part, "p_partkey", 4, cols=["p_size", "p_retailprice", "p_brand"])


@query("find_clusters_numeric")
def _(t):
    return K.find_clusters(t.part, "p_partkey", 3, cols=["p_size", "p_retailprice"])


@query("silhouette_score", "with p as (select a.vec_id, a.label as l, b.label as m, avg(" + " + ".join(f"(a.d{i} - b.d{i}) ** 2" for i in range(64)) + """) as d
   from emb a join emb b on a.vec_id <> b.vec_id group by 1, 2, 3),
 s as (select vec_id, coalesce(min(d) filter (where l = m), 0) as a, min(d) filter (where l <> m) as b, count(*) filter (where l = m) as own from p group by vec_id)
 select count(*) as n, (select count(distinct label) from emb) as k, round_even(avg(case when own = 0 then 0 else (b - a) / greatest(a, b) end), 4) as silhouette from s""", E10)
def _(t):
    return K.silhouette(t.emb, "vec_id", DIMS, "label")


@query("cluster_size_check", """with g as (select cluster, count(*) as n from regime group by 1), s as (select sum(n) t, min(n) m from g)
 select cluster, n, round_even(n / cast(t as double), 4) as share, n / cast(t as double) < 0.05 as violation, m / cast(t as double) >= 0.05 as valid from g, s""", RG)
def _(t):
    return K.cluster_size_check(t.regime, "cluster")


@query("cluster_profile", "select cluster, " + ", ".join(f"round_even(avg({c}), 3) as {c}" for c in ("l_orderkey", "x", "price", "disc", "tax", "target")) + " from regime group by 1", RG)
def _(t):
    return K.cluster_profile(t.regime, "cluster")


def embedding(t):
    return K.mixed_embedding(t.part, "p_partkey", ["p_size", "p_retailprice"], ["p_type"], 2)


@query("mixed_embedding")
def _(t):
    return embedding(t)


DENSITY = """with recursive p as (select l_partkey as id, avg(l_quantity) as x, avg(l_extendedprice) as y from lineitem group by 1),
 e as (select min(x) xl, max(x) xh, min(y) yl, max(y) yh from p),
 pc as (select id, cast(least(floor((x - xl) / ((xh - xl) / 24)), 23) as int) as cx, cast(least(floor((y - yl) / ((yh - yl) / 24)), 23) as int) as cy from p, e),
 c as (select cx, cy, count(*) as n from pc group by 1, 2),
 dn as (select a.cx, a.cy, a.n from c a join c b on abs(a.cx - b.cx) <= 1 and abs(a.cy - b.cy) <= 1 group by 1, 2, 3 having sum(b.n) >= 10 and a.n > 1),
 w as (select cx, cy, cx * 100 + cy as g from dn union select d.cx, d.cy, w.g from w join dn d on abs(d.cx - w.cx) <= 1 and abs(d.cy - w.cy) <= 1 where w.g < d.cx * 100 + d.cy),
 gr as (select cx, cy, min(g) as g from w group by 1, 2),
 al as (select c.cx, c.cy, c.n, coalesce(own.g, min(near.g)) as g from c left join gr own using (cx, cy) left join gr near on abs(near.cx - c.cx) <= 1 and abs(near.cy - c.cy) <= 1 group by c.cx, c.cy, c.n, own.g),
 sz as (select g, sum(n) as s from al where g is not null group by 1 having sum(n) >= 50),
 nr as (select g, row_number() over (order by s desc, g) - 1 as cluster from sz),
 lb as (select pc.id, cast(coalesce(nr.cluster, -1) as int) as cluster from pc join al using (cx, cy) left join nr using (g))"""


def density(t):
    return K.density_clusters(t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("q"), F.avg("l_extendedprice").alias("p")), "l_partkey", ["q", "p"], cell_share=1 / 24)[0]


@query("density_clusters", DENSITY + " select id as l_partkey, cluster from lb")
def _(t):
    return density(t)


@query("density_cluster_sizes", DENSITY + " select cluster, count(*) as n from lb group by 1")
def _(t):
    return density(t).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


PARTS_SQL = "p as (select l_partkey, avg(l_quantity) as q, avg(l_extendedprice) / 1000 as p from lineitem group by 1)"


def distance_clusters(t):
    parts = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("q"), (F.avg("l_extendedprice") / 1000).alias("p"))
    return D.dbscan(parts, "l_partkey", ["q", "p"], 0.75, 8, 20)


@query("dbscan_clusters")
def _(t):
    return distance_clusters(t)


@query("dbscan_core_points", f"""with {PARTS_SQL} select a.l_partkey, count(*) >= 8 as core
 from p a join p b on power(a.q - b.q, 2) + power(a.p - b.p, 2) <= 0.5625 group by 1""")
def _(t):
    return distance_clusters(t).select("l_partkey", "core")


@query("multi_view_cluster")
def _(t):
    return multi_view_cluster(t.part, "p_partkey", ["p_size", "p_retailprice"], ["p_type"])[0]


@query("cluster_label_names", "select l_orderkey, case cluster when 1 then 'steady' else 'C' || cast(cluster as varchar) end as cluster_label from regime", RG)
def _(t):
    return K.label_names(t.regime, "cluster", {"1": "steady"}).select("l_orderkey", "cluster_label")


@query("attach_labels", "select o_orderkey, o_totalprice, cast(c_mktsegment as varchar) as segment from orders left join (select c_custkey, c_mktsegment from customer where c_acctbal > 0) on c_custkey = o_custkey")
def _(t):
    labels = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return K.attach_labels(t.orders, labels, "o_custkey").select("o_orderkey", "o_totalprice", "segment")


@query("cluster_verdict")
def _(t):
    return K.cluster_verdict(t.regime, "cluster", "target", ["x", "price", "disc"], 0.35)
