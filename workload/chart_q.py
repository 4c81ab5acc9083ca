"""Chart-data and source queries."""

from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import charts as G
from tablescope.sources import files as S

from .clean_q import r6
from .core import query
from .profile_q import ALL, NUM, corr_sql

BOX = """, q as (select {k}, count({v}) as n, quantile_cont({v}, 0.25) as q1, median({v}) as median, quantile_cont({v}, 0.75) as q3 from b group by {k})
 select {k}, n, round_even(q1, 6) as q1, round_even(median, 6) as median, round_even(q3, 6) as q3,
  round_even(least(q1, min({v}) filter (where {v} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))), 6) as whisker_lo,
  round_even(greatest(q3, max({v}) filter (where {v} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))), 6) as whisker_hi
 from b join q using ({k}) where {v} is not null group by {k}, n, q1, median, q3"""


def box(base, keys, value):
    return base + BOX.replace("{k}", keys).replace("{v}", value)


BOXCOLS = ("q1", "median", "q3", "whisker_lo", "whisker_hi")


def hist_sql(cols, src, bins=None, by="", where=""):
    """Histogram rows per column with the bin edges."""
    k = f"{by}, " if by else ""
    parts = []
    for c in cols:
        n = str(bins) if bins else "least(30, greatest(10, count({c}) // 20))".replace("{c}", c)
        parts.append(f"""select {k}'{c}' as "column", bin, round_even(lo + (hi - lo) / bins * (bin - 1), 6) as bin_lo,
          round_even(lo + (hi - lo) / bins * bin, 6) as bin_hi, (select count(*) from {src} x where {'x.' + by + ' = s.' + by + ' and ' if by else ''}
          {c} is not null and least(floor(({c} - lo) / (hi - lo) * bins) + 1, bins) = bin) as n
          from (select {k}cast(min({c}) as double) - case when min({c}) = max({c}) then 0.5 else 0 end as lo,
           cast(max({c}) as double) + case when min({c}) = max({c}) then 0.5 else 0 end as hi, {n} as bins from {src} {where} {'group by ' + by if by else ''}) s,
          lateral (select cast(unnest(generate_series(1, bins)) as int) as bin)""")
    return " union all ".join(parts)


@query("histogram_data", "with h as (" + hist_sql(["l_quantity", "l_extendedprice", "l_disc_n", "l_const"], "li_dirty") + "), s as (" + " union all ".join(
    f"""select '{c}' as c, case when min({c}) = max({c}) then null else round_even(skewness({c}), 6) end as skew, cast(median({c}) as double) as median from li_dirty"""
    for c in ["l_quantity", "l_extendedprice", "l_disc_n", "l_const"]) + """) select h.*, skew, median from h join s on h."column" = s.c""", ("li_dirty",))
def _(t):
    d = G.histogram_data(t.li_dirty, ["l_quantity", "l_extendedprice", "l_disc_n", "l_const"])
    return r6(d, "bin_lo", "bin_hi", "skew")


@query("category_bars", """with vc as (select 'lang' as c, lang as value, count(*) as n from docs_labelled where lang is not null group by 2
  union all select 'source', source, count(*) from docs_labelled where source is not null group by 2),
 r as (select *, row_number() over (partition by c order by n desc, value) as rk, count(*) over (partition by c) as k from vc)
 select c as "column", cast(rk as int) as rank, value, n as "count" from r where k between 2 and 200 and rk <= 8""", ("docs_labelled",))
def _(t):
    return G.category_bars(t.docs_labelled)


@query("category_cumsum", """with vc as (select 'lang' as c, lang as value, count(*) as n from docs_labelled where lang is not null group by 2
  union all select 'source', source, count(*) from docs_labelled where source is not null group by 2),
 r as (select *, row_number() over (partition by c order by n desc, value) as rk, count(*) over (partition by c) as k, sum(n) over (partition by c) as t from vc),
 x as (select c, rk, substr(value, 1, 20) as label, n, k, t from r where rk <= 10 and k > 1
   union all select c, 11, '(' || cast(max(k) - 10 as varchar) || ' others)', sum(n), max(k), max(t) from r where rk > 10 and k > 1 group by c),
 p as (select *, n * 100.0 / cast(t as double) as pct from x)
 select c as "column", cast(rk as int) as rank, label, cast(n as bigint) as "count", k as "unique", round_even(pct, 6) as pct,
  round_even(sum(pct) over (partition by c order by rk), 6) as cum_pct, round_even(sum(pct) filter (where rk <= 1) over (partition by c), 6) as top1_pct,
  round_even(sum(pct) filter (where rk <= 3) over (partition by c), 6) as top3_pct from p""", ("docs_labelled",))
def _(t):
    return G.category_cumsum(t.docs_labelled)


@query("missing_map", " union all ".join(
    f"""select '{c}' as "column", round_even((count(*) - count({c})) / cast(count(*) as double) * 100, 1) as null_pct from li_dirty""" for c in ALL), ("li_dirty",))
def _(t):
    return G.missing_map(t.li_dirty)


@query("missing_map_sample", """select doc_id, lang is null as lang, source is null as source, n_chars is null as n_chars, quality is null as quality, toxic is null as toxic
 from docs_labelled where (select count(*) from docs_labelled) <= 200 or ('0x' || substr(md5(cast(doc_id as varchar)), 1, 8))::bigint % 100 < 15""", ("docs_labelled",))
def _(t):
    return G.missing_sample(t.docs_labelled, ["doc_id"])


@query("top_correlations", "with p as (" + " union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, {corr_sql(a, b)} as r" for i, a in enumerate(NUM) for j, b in enumerate(NUM) if i < j
) + ") select col_a, col_b, round_even(r, 6) as r from p where r is not null order by abs(r) desc, col_a, col_b limit 5", ("li_dirty",))
def _(t):
    return G.top_correlations(t.li_dirty)


TOPB = "b as (select * from part where p_brand in (select p_brand from part group by 1 order by count(*) desc, p_brand limit 10))"


@query("box_stats_by_category", box("with " + TOPB, "p_brand", "p_retailprice"))
def _(t):
    return r6(G.box_stats_by_category(t.part, "p_retailprice", "p_brand"), *BOXCOLS)


@query("auto_box_target", """with s as (select 0 as i, 'p_partkey' as c, stddev_samp(p_partkey) as s from part union all select 4, 'p_size', stddev_samp(p_size) from part
  union all select 5, 'p_retailprice', stddev_samp(p_retailprice) from part),
 k as (select 1 as i, 'p_name' as c, count(distinct p_name) as u from part union all select 2, 'p_brand', count(distinct p_brand) from part
  union all select 3, 'p_type', count(distinct p_type) from part)
 select (select c from s order by s desc, i limit 1) as target, (select c from k where u between 2 and 30 order by u desc, i limit 1) as grouper""")
def _(t):
    return G.auto_box_target(t.part)


@query("ts_by_category", """select cast(ts as date) as day, event_type, round_even(avg(value), 6) as value from events
 where event_type in (select event_type from events group by 1 order by count(*) desc, event_type limit 10) group by 1, 2""")
def _(t):
    d = t.events.select(F.to_date("ts").alias("day"), "event_type", "value")
    return r6(G.ts_by_category(d, "day", "value", "event_type"), "value")


@query("ts_monthly", """select cast(date_trunc('month', o_orderdate) as date) as month, o_orderpriority, round_even(median(o_totalprice), 6) as value from orders
 where o_orderpriority in (select o_orderpriority from orders group by 1 order by count(*) desc, o_orderpriority limit 10) group by 1, 2""")
def _(t):
    return r6(G.ts_monthly(t.orders, "o_orderdate", "o_totalprice", "o_orderpriority"), "value")


@query("seasonality_stats", box("with b as (select cast(month(o_orderdate) as int) as period, o_totalprice from orders)", "period", "o_totalprice"))
def _(t):
    return r6(G.seasonality_stats(t.orders, "o_orderdate", "o_totalprice"), *BOXCOLS)


@query("seasonality_weekday", box("with b as (select cast(isodow(o_orderdate) - 1 as int) as period, o_totalprice from orders)", "period", "o_totalprice"))
def _(t):
    return r6(G.seasonality_stats(t.orders, "o_orderdate", "o_totalprice", "weekday"), *BOXCOLS)


@query("stacked_share", """with top as (select event_type from events group by 1 order by count(*) desc, event_type limit 8),
 e as (select cast(ts as date) as day, event_type, value from events where event_type in (select event_type from top)),
 d as (select distinct day from e),
 g as (select d.day, top.event_type, count(e.value) as n from d cross join top left join e on e.day = d.day and e.event_type = top.event_type group by 1, 2)
 select day, event_type, n, round_even(n / cast(sum(n) over (partition by day) as double) * 100, 6) as share from g""")
def _(t):
    d = t.events.select(F.to_date("ts").alias("day"), "event_type", "value")
    return G.stacked_share(d, "day", "value", "event_type")


@query("binned_scatter", """with s as (select min(l_extendedprice) lo, max(l_extendedprice) hi from li_dirty),
 b as (select cast(greatest(1, least(25, ceil((l_extendedprice - lo) / ((hi - lo) / 25)))) as int) as bin, l_disc_n as y, lo, hi from li_dirty, s where l_disc_n is not null)
 select bin, round_even(lo + (hi - lo) / 25 * (bin - 0.5), 6) as mid, round_even(median(y), 6) as median, round_even(avg(y), 6) as mean,
  round_even(stddev_samp(y), 6) as std, count(*) as n from b group by bin, lo, hi having count(*) >= 5""".replace(
      "from li_dirty),", "from li_dirty where l_disc_n is not null),"), ("li_dirty",))
def _(t):
    return r6(G.binned_scatter(t.li_dirty, "l_extendedprice", "l_disc_n"), "mid", "median", "mean", "std")


@query("range_gradient", """select range_txt, cast(split_part(range_txt, ' ', 1) as int) as sort_key, round_even(median(o_totalprice), 6) as median,
 count(o_totalprice) as n from raw_strings group by 1""", ("raw_strings",))
def _(t):
    return r6(G.range_gradient(t.raw_strings, "range_txt", "o_totalprice"), "median")


@query("faceted_box", box("""with b as (select * from part where p_brand in (select p_brand from part group by 1 order by count(*) desc, p_brand limit 10)
 and p_type in (select p_type from part group by 1 order by count(*) desc, p_type limit 5))""", "p_brand, p_type", "p_retailprice"))
def _(t):
    return r6(G.faceted_box(t.part, "p_retailprice", "p_brand", "p_type"), *BOXCOLS)


VD = """with e as (select list_distinct(list(x)) as es from (select unnest(quantile_cont(p_size, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) as x from part)),
 l as (select 'p_type' as f, p_type as v, p_retailprice as y from part union all select 'p_brand', p_brand, p_retailprice from part
  union all select 'p_size', cast(greatest(len(list_filter(es, lambda x: x < p_size)), 1) as varchar), p_retailprice from part, e),
 m as (select f, avg(y) over (partition by f, v) as gm from l)
 select f as factor, least(1.0, round_even(var_samp(gm) / (select var_samp(p_retailprice) from part), 4)) as explained from m group by f"""


@query("variance_decomposition", VD)
def _(t):
    return G.variance_decomposition(t.part, "p_retailprice", ["p_type", "p_brand", "p_size"])


@query("cluster_histograms", hist_sql(["x", "price"], "regime", 40, "cluster").replace(' as n\n', ' as n\n'), ("regime",))
def _(t):
    return r6(G.cluster_histograms(t.regime, "cluster", ["x", "price"]).drop("n_values"), "bin_lo", "bin_hi")


@query("target_by_cluster", hist_sql(["target"], "regime", 50, "cluster"), ("regime",))
def _(t):
    return r6(G.cluster_histograms(t.regime, "cluster", ["target"], 50).drop("n_values"), "bin_lo", "bin_hi")


@query("cluster_radar", " union all ".join(
    f"""select cluster, '{c}' as "column", round_even((avg({c}) - (select avg({c}) from regime)) / (select stddev_pop({c}) from regime), 6) as z_mean
    from regime group by cluster""" for c in ("x", "price", "disc", "tax")), ("regime",))
def _(t):
    return G.cluster_radar(t.regime, "cluster", ["x", "price", "disc", "tax"])


@query("cluster_sizes", "select cluster, count(*) as n, round_even(count(*) / cast((select count(*) from regime) as double), 6) as share from regime group by 1", ("regime",))
def _(t):
    return G.cluster_sizes(t.regime, "cluster")


@query("target_corr_rank", "with p as (" + " union all ".join(f"select '{c}' as c, {corr_sql(c, 'charge')} as r" for c in NUM if c != "charge") +
       """) select c as "column", round_even(abs(r), 6) as abs_r from p""", ("li_dirty",))
def _(t):
    return G.target_corr_rank(t.li_dirty, "charge")


FR = ", ".join(str(i / 20) for i in range(21))


@query("interaction_lines", f"""with g as (select l_returnflag as grp, l_extendedprice as x, ln(1 + charge) as y from li_dirty),
 e as (select grp, list_sort(list_distinct(quantile_cont(x, [{FR}]))) as es from g group by grp having count(*) >= 30),
 b as (select grp, greatest(len(list_filter(es, lambda v: v < x)), 1) as bin, es, y from g join e using (grp))
 select grp, cast(bin as int) as bin, round_even((es[bin] + es[bin + 1]) / 2, 6) as x_mid, round_even(median(y), 6) as median_y, count(*) as n from b group by grp, bin, es""", ("li_dirty",))
def _(t):
    return r6(G.interaction_lines(t.li_dirty, "l_extendedprice", "charge", "l_returnflag"), "x_mid", "median_y")


@query("interaction_lines_numeric", f"""with qe as (select list_sort(list_distinct(quantile_cont(o_totalprice, [0, 0.25, 0.5, 0.75, 1.0]))) as q from orders),
 g as (select 'Q' || cast(greatest(len(list_filter(q, lambda v: v < o_totalprice)), 1) as varchar) as grp, cast(o_custkey as double) as x, ln(1 + o_totalprice) as y from orders, qe),
 e as (select grp, list_sort(list_distinct(quantile_cont(x, [{FR}]))) as es from g group by grp having count(*) >= 30),
 b as (select grp, greatest(len(list_filter(es, lambda v: v < x)), 1) as bin, es, y from g join e using (grp))
 select grp, cast(bin as int) as bin, round_even((es[bin] + es[bin + 1]) / 2, 6) as x_mid, round_even(median(y), 6) as median_y, count(*) as n from b group by grp, bin, es""")
def _(t):
    return r6(G.interaction_lines(t.orders, "o_custkey", "o_totalprice", "o_totalprice"), "x_mid", "median_y")


# Sources

@query("scan_csv", "select * from orders")
def _(t):
    path = S.scratch_dir(t.spark, "csv")
    S.write_csv(t.orders, path)
    d = S.read_csv(t.spark, path)
    return d.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority").select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("pages_to_table", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(t):
    rec = F.struct(F.col("c_custkey").alias("_id"), "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    pages = t.customer.groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.collect_list(rec).alias("records"))
    path = S.scratch_dir(t.spark, "pages")
    pages.select(F.struct("records", F.size("records").cast("bigint").alias("total")).alias("result")).write.json(path)
    return S.read_pages(t.spark, path, "_id: bigint, c_custkey: bigint, c_name: string, c_nationkey: int, c_acctbal: double, c_mktsegment: string")


@query("metadata_flatten", """with m as (select doc_id, source, lang from documents)
 select 'm' || cast(doc_id as varchar) as dataset_id, 0 as position, 'lang_' || lang as name, 'Language' as title, 'Text' as data_type, true as categorical from m
 union all select 'm' || cast(doc_id as varchar), 1, 'n_chars', 'Length', 'Numeric', false from m
 union all select 'm' || cast(doc_id as varchar), 2, null, null, null, false from m""")
def _(t):
    meta = t.documents.select(F.concat(
        F.lit('{"datasetId": "m'), F.col("doc_id").cast("string"), F.lit('", "name": "'), F.col("source"),
        F.lit('", "format": "CSV", "collectionIds": [], "columnMetadata": {"order": ["c9", "c1", "c5"], "metaMapping": {'
              '"c1": {"name": "n_chars", "columnTitle": "Length", "dataType": "Numeric"}, "c9": {"name": "lang_'),
        F.col("lang"), F.lit('", "columnTitle": "Language", "dataType": "Text", "isCategorical": true}}}}')).alias("j"))
    return S.flatten_metadata(meta, "j")


@query("collection_flatten", """select 'c' || cast(s_suppkey as varchar) as collection_id, s_name as name, null::varchar as description,
 case when s_nationkey < 10 then 'monthly' end as frequency, 'agency' as sources, 'owner' as managed_by,
 'd' || cast(s_suppkey as varchar) || ',e' || cast(s_suppkey as varchar) as child_datasets from supplier where s_acctbal >= 0""")
def _(t):
    k = F.col("s_suppkey").cast("string")
    full = F.concat(F.lit('{"data": {"collectionMetadata": {"collectionId": "c'), k, F.lit('", "name": "'), F.col("s_name"),
                    F.when(F.col("s_nationkey") < 10, '", "frequency": "monthly').otherwise(""),
                    F.lit('", "sources": ["agency"], "managedBy": "owner", "childDatasets": ["d'), k, F.lit('", "e'), k, F.lit('"]}}}'))
    rec = t.supplier.select(F.when(F.col("s_acctbal") >= 0, full).otherwise('{"data": {"collectionMetadata": {"name": "no id"}}}').alias("j"))
    d = S.flatten_collections(rec, "j")
    return d.withColumn("sources", F.array_join("sources", ",")).withColumn("child_datasets", F.array_join("child_datasets", ","))


@query("content_id", """select 'local_' || substr(md5(text), 1, 12) as dataset_id, source || '_' || cast(doc_id as varchar) as title,
 '/data/in.v1/' || source || '_' || cast(doc_id as varchar) || '.csv' as path from documents""")
def _(t):
    f = t.documents.select(F.concat(F.lit("/data/in.v1/"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("path"),
                           F.encode("text", "UTF-8").alias("content"))
    return S.content_ids(f)


@query("local_metadata", """select 'local_orders' as dataset_id, (select count(*) from orders) as row_count, cast(i as int) as position, c as name, c as title,
 'Text' as data_type, false as categorical
 from (values (0, 'o_orderkey'), (1, 'o_custkey'), (2, 'o_orderstatus'), (3, 'o_totalprice'), (4, 'o_orderdate'), (5, 'o_orderpriority')) v(i, c)""")
def _(t):
    return S.local_metadata(t.orders, "local_orders")


@query("head_sample", "select * from orders order by o_orderkey limit 500")
def _(t):
    return S.head_sample(t.orders, ["o_orderkey"], 500)


PLAN = """select case when doc_id % 10 = 0 then 'local_' else 's' end || cast(doc_id as {s}) as id, case when doc_id % 9 = 0 then null else doc_id * 7 % 1000 end as known_total,
 case when doc_id % 4 = 0 then null else doc_id % 100 end as cached_rows, n_chars * 5000 as cached_bytes from {documents}"""


@query("download_plan", f"""with c as ({PLAN.replace('{s}', 'varchar').replace('{documents}', 'documents')}),
 p as (select *, cached_rows is not null and coalesce(known_total, 0) > 0 and cached_rows < known_total * 0.2 and not starts_with(id, 'local_') as nf,
  cast(floor(cached_bytes / cast(greatest(cached_rows, 1) as double) * coalesce(known_total, 0)) as bigint) as est from c)
 select id, nf as needs_full, case when nf then est end as est_bytes,
  case when cached_rows is null then 'fetch_sample' when nf and est > 524288000 then 'reject' when nf then 'download' else 'use_cache' end as plan,
  case when nf and est > 524288000 then 'too_large_to_download: estimated ' || format('{{:.0f}}', est / 1048576.0) || ' MB' end as reject_reason from p""")
def _(t):
    return S.download_plan(t.sql(PLAN.replace("{s}", "string")))


SRC = """(select *, lpad(cast(o_orderkey % 30 + 1 as varchar), 2, '0') || ' TO ' || lpad(cast(o_orderkey % 30 + 3 as varchar), 2, '0') as span from orders)"""


@query("endgame_bundle", f"""with o as {SRC}, s as (select min(o_custkey) lo, max(o_custkey) hi from o),
 b as (select cast(greatest(1, least(25, ceil((o_custkey - lo) / ((hi - lo) / cast(25 as double))))) as int) as bin, o_totalprice as y from o, s),
 q as (select o_orderstatus, o_orderpriority, quantile_cont(o_totalprice, 0.25) as q1, median(o_totalprice) as m, quantile_cont(o_totalprice, 0.75) as q3 from o
   where o_orderpriority in (select o_orderpriority from o group by 1 order by count(*) desc, 1 limit 5) group by 1, 2),
 w as (select q.*, min(o_totalprice) filter (where o_totalprice >= q1 - 1.5 * (q3 - q1)) as lo, max(o_totalprice) filter (where o_totalprice <= q3 + 1.5 * (q3 - q1)) as hi
   from q join o on o.o_orderstatus = q.o_orderstatus and o.o_orderpriority = q.o_orderpriority group by all),
 u as (
 select 'ts_o_totalprice_by_o_orderpriority' as chart, o_orderpriority as series, cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as position, median(o_totalprice) as value from o group by 1, 2, 3
 union all select 'o_totalprice_vs_o_custkey', 'median', cast(bin as varchar), median(y) from b group by bin having count(*) >= 5
 union all select 'o_totalprice_by_span', span, cast(cast(split_part(span, ' ', 1) as int) as varchar), median(o_totalprice) from o group by 2, 3
 union all select 'boxplot_o_totalprice_by_o_orderstatus_o_orderpriority', o_orderstatus || ' / ' || o_orderpriority, k, v from w, lateral (select unnest(['whisker_lo', 'q1', 'median', 'q3', 'whisker_hi']) as k, unnest([least(lo, q1), q1, m, q3, greatest(hi, q3)]) as v)
 union all select 'variance_decomposition_o_totalprice', 'o_orderstatus', 'explained', (select var_samp(gm) / (select var_samp(o_totalprice) from o) from (select avg(o_totalprice) over (partition by o_orderstatus) as gm from o)))
 select chart, series, position, round_even(value, 4) as value from u""")
def _(t):
    from tablescope.plans.chart_bundle import endgame

    pad = lambda k: F.lpad(((F.col("o_orderkey") % 30) + k).cast("string"), 2, "0")
    src = t.orders.withColumn("span", F.concat(pad(1), F.lit(" TO "), pad(3)))
    d = endgame(src, {"date_col": "o_orderdate", "price_col": "o_totalprice", "cat_cols": ["o_orderpriority"], "x_col": "o_custkey", "range_col": "span",
                      "group_col": "o_orderstatus", "hue_col": "o_orderpriority", "factor_cols": ["o_orderstatus"]})
    return d.withColumn("value", rnd(F.col("value"), 4))
