"""Cleaning and feature queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import clean as C, features as E, wide as W
from tablescope.operators.profile import numeric_columns, per_column
from tablescope.plans.replay import Step, replay, replay_written

from .core import query

RAW = ("raw_strings",)


def r6(df, *cols):
    for c in cols:
        df = df.withColumn(c, rnd(F.col(c), 6))
    return df


@query("clean_to_numeric", "select o_orderkey, try_cast(bad_num as double) as bad_num from raw_strings", RAW)
def _(t):
    return C.to_numeric(t.raw_strings, "bad_num").select("o_orderkey", "bad_num")


@query("clean_comma_number", "select o_orderkey, cast(replace(price_txt, ',', '') as double) as price_txt from raw_strings", RAW)
def _(t):
    return C.comma_number(t.raw_strings, "price_txt").select("o_orderkey", "price_txt")


@query("clean_range_midpoint", """select o_orderkey, (cast(split_part(range_txt, ' TO ', 1) as double) + cast(split_part(range_txt, ' TO ', 2) as double)) / 2
 as range_txt from raw_strings""", RAW)
def _(t):
    return C.range_midpoint(t.raw_strings, "range_txt").select("o_orderkey", "range_txt")


@query("clean_parse_date", "select o_orderkey, cast(strptime(month_txt, '%Y-%m') as date) as month_txt from raw_strings", RAW)
def _(t):
    return C.parse_date(t.raw_strings, "month_txt").select("o_orderkey", "month_txt")


@query("clean_duration_years", """select o_orderkey, round_even(cast(split_part(lease_txt, ' ', 1) as double) +
 cast(split_part(lease_txt, ' ', 3) as double) / 12, 6) as lease_txt from raw_strings""", RAW)
def _(t):
    return r6(C.duration_years(t.raw_strings, "lease_txt"), "lease_txt").select("o_orderkey", "lease_txt")


@query("impute_missing", """select l_orderkey, l_linenumber, coalesce(l_tax_n, (select median(l_tax_n) from li_dirty)) as l_tax_n,
 l_disc_n is null as is_missing_l_disc_n from li_dirty""", ("li_dirty",))
def _(t):
    out = C.impute_missing(t.li_dirty, {"l_tax_n": "impute_median", "l_disc_n": "flag"})
    return out.select("l_orderkey", "l_linenumber", "l_tax_n", "is_missing_l_disc_n")


@query("impute_missing_mode", """with m as (select quality from docs_labelled where quality is not null group by 1 order by count(*) desc, quality limit 1)
 select doc_id, coalesce(quality, (select quality from m)) as quality, toxic from docs_labelled where toxic is not null""", ("docs_labelled",))
def _(t):
    return C.impute_missing(t.docs_labelled, {"quality": "impute_mode", "toxic": "drop_rows"}).select("doc_id", "quality", "toxic")


@query("drop_sparse", """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
 l_linestatus, l_shipdate, l_tax_n, l_const, revenue, charge from li_dirty""", ("li_dirty",))
def _(t):
    return C.drop_sparse(t.li_dirty)


@query("flag_outliers", """with q as (select event_type, value, event_id, quantile_cont(value, 0.25) over () as a, quantile_cont(value, 0.75) over () as b from events)
 select event_id, value, value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a) as is_outlier_value from q""")
def _(t):
    return C.flag_outliers(t.events, ["value"]).select("event_id", "value", "is_outlier_value")


@query("drop_useless", """with u as (
  select 'l_const' as "column", case when count(distinct l_const) <= 1 then 'constant' end as reason from li_dirty
  union all select 'l_orderkey', case when count(distinct l_orderkey) = count(*) then 'id' end from li_dirty
  union all select 'o_orderkey', case when count(distinct o_orderkey) = count(*) then 'id' end from orders
  union all select 'o_custkey', case when count(distinct o_custkey) = count(*) then 'id' end from orders
  union all select 'c_name', case when count(distinct c_name) = count(*) then 'id' end from customer
  union all select 'c_custkey', case when count(distinct c_custkey) = count(*) then 'id' end from customer)
 select * from u where reason is not null""", ("li_dirty",))
def _(t):
    return C.useless_columns(t.li_dirty).union(C.useless_columns(t.orders)).union(C.useless_columns(t.customer))


@query("standardise_categories", """with s as (select o_orderkey, lower(trim(regexp_replace(category, '\\s+', ' ', 'g'))) as c from raw_strings)
 select o_orderkey, case when c = '4-not specified' then 'none' when c = '5-low' then 'low' else c end as category from s""", RAW)
def _(t):
    m = {"4-not specified": "none", "5-low": "low"}
    return C.standardise_categories(t.raw_strings, "category", m).select("o_orderkey", "category")


@query("near_duplicate_categories", """with v as (select distinct lower(category) as x from raw_strings union select distinct p_name from part)
 select a.x as value_a, b.x as value_b, cast(levenshtein(a.x, b.x) as int) as distance from v a join v b on a.x < b.x where levenshtein(a.x, b.x) <= 2""", RAW)
def _(t):
    both = t.raw_strings.select(F.lower("category").alias("x")).union(t.part.select("p_name"))
    return C.near_duplicate_categories(both, "x")


@query("drop_duplicates", "select distinct * from li_dup", ("li_dup",))
def _(t):
    return C.drop_duplicates(t.li_dup)


@query("fe_log1p", "select o_orderkey, round_even(ln(1 + o_totalprice), 6) as log_price from orders")
def _(t):
    return r6(E.log1p(t.orders, "o_totalprice", "log_price"), "log_price").select("o_orderkey", "log_price")


@query("fe_standardise", """select p_partkey, round_even((p_retailprice - (select avg(p_retailprice) from part)) / (select stddev_pop(p_retailprice) from part), 6) as p_retailprice_z,
 round_even((p_size - (select avg(p_size) from part)) / (select stddev_pop(p_size) from part), 6) as p_size_z from part""")
def _(t):
    return r6(E.standardise(t.part, ["p_retailprice", "p_size"]), "p_retailprice_z", "p_size_z").select("p_partkey", "p_retailprice_z", "p_size_z")


@query("fe_clip", """with q as (select quantile_cont(value, 0.25) a, quantile_cont(value, 0.75) b, quantile_cont(value, 0.05) lo, quantile_cont(value, 0.95) hi from events)
 select event_id, round_even(least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a)), 6) as value_clip,
  round_even(least(greatest(value, lo), hi), 6) as value_wins from events, q""")
def _(t):
    out = E.clip(E.clip(t.events, "value"), "value", 0.05, 0.95, "value_wins")
    return r6(out, "value_clip", "value_wins").select("event_id", "value_clip", "value_wins")


@query("fe_ratio", "select l_orderkey, l_linenumber, round_even(l_extendedprice / nullif(l_tax, 0), 4) as price_per_tax from lineitem")
def _(t):
    return E.ratio(t.lineitem, "l_extendedprice", "l_tax", "price_per_tax").select(
        "l_orderkey", "l_linenumber", rnd(F.col("price_per_tax"), 4).alias("price_per_tax"))


@query("fe_bins", """with e as (select list_distinct(list(x)) as es from (select unnest(quantile_cont(p_retailprice, [0, 0.25, 0.5, 0.75, 1.0])) as x from part)),
 m as (select min(p_size) lo, max(p_size) hi from part)
 select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'mid' else 'large' end as p_size_bucket,
  cast(least(floor((cast(p_size as double) - lo) / (hi - lo) * 5) + 1, 5) as int) as p_size_bin,
  cast(greatest(len(list_filter(es, lambda x: x < p_retailprice)), 1) as int) as p_retailprice_qbin from part, e, m""")
def _(t):
    d = E.bins(t.part, "p_size", edges=[10, 30], labels=["small", "mid", "large"])
    d = E.bins(E.bins(d, "p_size", width=5), "p_retailprice", quantiles=4)
    return d.select("p_partkey", "p_size_bucket", "p_size_bin", "p_retailprice_qbin")


@query("fe_time_parts", """select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
 cast(quarter(o_orderdate) as int) as quarter, cast(isodow(o_orderdate) - 1 as int) as weekday from orders""")
def _(t):
    return E.time_parts(t.orders, "o_orderdate").select("o_orderkey", "year", "month", "quarter", "weekday")


@query("fe_interactions", """select p_partkey, round_even(cast(p_size as double) * p_retailprice, 4) as p_size_x_p_retailprice,
 case when p_type = 'ECONOMY' then cast(p_size as double) else 0.0 end as "p_size_x_ECONOMY",
 case when p_type = 'STANDARD' then cast(p_size as double) else 0.0 end as "p_size_x_STANDARD" from part""")
def _(t):
    d = E.category_interactions(E.interaction(t.part, "p_size", "p_retailprice"), "p_size", "p_type", ["ECONOMY", "STANDARD"])
    return d.select("p_partkey", rnd(F.col("p_size_x_p_retailprice"), 4).alias("p_size_x_p_retailprice"), "p_size_x_ECONOMY", "p_size_x_STANDARD")


@query("fe_group_index", """with g as (select p_brand, median(p_retailprice) as m from part group by 1)
 select p_partkey, round_even(m / (select median(p_retailprice) from part), 6) as brand_index from part join g using (p_brand)""")
def _(t):
    return r6(E.group_index(t.part, "p_brand", "p_retailprice", "brand_index"), "brand_index").select("p_partkey", "brand_index")


@query("fe_flags", """select p_partkey, cast(p_type in ('PROMO', 'ECONOMY') as int) as is_cheap, cast(contains(p_name, 'ring') as int) as is_ring from part""")
def _(t):
    d = E.flag_contains(E.flag_in(t.part, "p_type", ["PROMO", "ECONOMY"], "is_cheap"), "p_name", "ring", "is_ring")
    return d.select("p_partkey", "is_cheap", "is_ring")


@query("fe_one_hot_vector", """select place, n from (select row_number() over (order by o_custkey) - 1 as place, count(*) as n from orders group by o_custkey)
 where place > 0""")
def _(t):
    """Rows per vector element: the vectors are added up, never spread out."""
    d = W.one_hot_vector(t.orders.select("o_custkey"), "o_custkey", out="v")
    total = d.select(Summarizer.sum(F.col("v")).alias("s")).select(F.posexplode(vector_to_array("s")).alias("place", "n"))
    return total.select((F.col("place") + 1).cast("bigint").alias("place"), F.col("n").cast("bigint").alias("n"))


@query("fe_one_hot", """select o_orderkey, case when o_orderstatus = 'O' then 1.0::double else 0.0 end as "o_orderstatus_O",
 case when o_orderstatus = 'P' then 1.0::double else 0.0 end as "o_orderstatus_P" from orders""")
def _(t):
    return E.one_hot(t.orders, "o_orderstatus").select("o_orderkey", "o_orderstatus_O", "o_orderstatus_P")


@query("fe_frequency", "select o_orderkey, count(*) over (partition by o_custkey) as o_custkey_freq from orders")
def _(t):
    return E.frequency(t.orders, "o_custkey").select("o_orderkey", "o_custkey_freq")


@query("fe_group_rare", """with v as (select p_brand from part group by 1 order by count(*) desc, p_brand limit 8)
 select p_partkey, case when p_brand in (select p_brand from v) then p_brand else '(other)' end as p_brand from part""")
def _(t):
    return E.group_rare(t.part, "p_brand", 8).select("p_partkey", "p_brand")


@query("segment_pivot", """select o_orderpriority, round_even(avg(o_totalprice) filter (where o_orderstatus = 'F'), 4) as "F",
 round_even(avg(o_totalprice) filter (where o_orderstatus = 'O'), 4) as "O",
 round_even(avg(o_totalprice) filter (where o_orderstatus = 'P'), 4) as "P" from orders group by 1""")
def _(t):
    d = E.segment_pivot(t.orders, "o_orderpriority", "o_orderstatus", "o_totalprice")
    return d.select("o_orderpriority", *[rnd(F.col(c), 4).alias(c) for c in ("F", "O", "P")])


@query("agg_merge_back", """select p_partkey, round_even(avg(p_retailprice) over w, 6) as p_retailprice_mean,
 round_even(stddev_samp(p_retailprice) over w, 6) as p_retailprice_std from part window w as (partition by p_brand)""")
def _(t):
    return r6(E.merge_group_stats(t.part, "p_brand", "p_retailprice"), "p_retailprice_mean", "p_retailprice_std").select(
        "p_partkey", "p_retailprice_mean", "p_retailprice_std")


def monthly(t):
    m = F.trunc("o_orderdate", "month")
    return t.orders.groupBy("o_orderpriority", m.alias("month")).agg(F.avg("o_totalprice").alias("avg_price"))


MONTHLY = "s as (select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month, avg(o_totalprice) as avg_price from orders group by 1, 2)"


@query("period_change", f"""with {MONTHLY}, l as (select *, lag(avg_price) over (partition by o_orderpriority order by month) as p from s)
 select o_orderpriority, month, round_even(avg_price, 5) as avg_price, round_even(p, 5) as previous, round_even(avg_price - p, 5) as change,
 round_even((avg_price - p) / p, 6) as change_share from l""")
def _(t):
    d = E.period_change(monthly(t), "month", "avg_price", ["o_orderpriority"])
    return d.select("o_orderpriority", "month", *[rnd(F.col(c), 5).alias(c) for c in ("avg_price", "previous", "change")],
                    rnd(F.col("change_share"), 6).alias("change_share"))


@query("seasonal_decompose", f"""with {MONTHLY}, a as (select *, month(month) as season,
   case when count(*) over w = 13 then (sum(avg_price) over w - 0.5 * first_value(avg_price) over w - 0.5 * last_value(avg_price) over w) / 12 end as trend
   from s window w as (partition by o_orderpriority order by month rows between 6 preceding and 6 following)),
 m as (select o_orderpriority, season, avg(avg_price - trend) as sm from a group by 1, 2),
 c as (select o_orderpriority, avg(sm) as cm from m group by 1)
 select a.o_orderpriority, month, round_even(avg_price, 5) as avg_price, cast(a.season as int) as season, round_even(trend, 3) as trend,
  round_even(sm - cm, 3) as seasonal, round_even(avg_price - trend - (sm - cm), 3) as remainder
 from a join m on a.o_orderpriority = m.o_orderpriority and a.season = m.season join c on c.o_orderpriority = a.o_orderpriority""")
def _(t):
    d = E.seasonal_decompose(monthly(t), "month", "avg_price", F.month("month"), 12, ["o_orderpriority"])
    return d.select("o_orderpriority", "month", rnd(F.col("avg_price"), 5).alias("avg_price"), "season",
                    *[rnd(F.col(c), 3).alias(c) for c in ("trend", "seasonal", "remainder")])


@query("corr_by_segment", "select l_returnflag, count(*) as n, round_even(corr(revenue, l_disc_n), 6) as r from li_dirty group by 1", ("li_dirty",))
def _(t):
    return r6(E.corr_by_segment(t.li_dirty, "l_returnflag", "l_disc_n", "revenue"), "r")


@query("ks_two_sample", """with c as (select l_extendedprice as v, count(*) filter (where l_returnflag = 'A') as ca, count(*) filter (where l_returnflag = 'R') as cb
   from lineitem where l_returnflag in ('A', 'R') group by 1),
 r as (select sum(ca) over (order by v) as ra, sum(cb) over (order by v) as rb, sum(ca) over () as na, sum(cb) over () as nb from c)
 select cast(max(na) as bigint) as n_a, cast(max(nb) as bigint) as n_b, round_even(max(abs(ra / cast(na as double) - rb / cast(nb as double))), 9) as ks from r""")
def _(t):
    return E.ks_two_sample(t.lineitem, "l_returnflag", "A", "R", "l_extendedprice").withColumn("ks", rnd(F.col("ks"), 9))


@query("class_imbalance", """with c as (select quality as class, count(*) as n from docs_labelled where quality is not null group by 1),
 s as (select sum(n) as t, max(n) / cast((select count(*) from docs_labelled) as double) as top from c)
 select class, n, round_even(n / cast(t as double), 6) as share, round_even(top, 6) as top_share,
  case when top > 0.8 then 'severe_imbalance' when top > 0.5 then 'moderate_imbalance' else 'balanced' end as flag from c, s""", ("docs_labelled",))
def _(t):
    return E.class_imbalance(t.docs_labelled, "quality")


STEPS = [
    Step("step_01_log", lambda d: E.log1p(d, "p_retailprice"), "log of the price"),
    Step("step_02_bad", lambda d: d.withColumn("x", F.col("no_such_column")), "fails"),
    Step("step_03_ratio", lambda d: E.ratio(d, "p_retailprice", "p_size", "price_per_size"), "price per size"),
    Step("step_01_log", lambda d: E.log1p(d, "p_size", "log_size"), "replaces the first"),
]


@query("replay_steps", """select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, round_even(p_retailprice / nullif(p_size, 0), 6) as price_per_size,
 round_even(ln(1 + p_size), 6) as log_size from part""")
def _(t):
    return r6(replay(t.part, STEPS)[0], "price_per_size", "log_size")


@query("replay_log", """select * from (values
  (1, 'step_02_bad', null, null, 'FAILED: AnalysisException', null),
  (2, 'step_03_ratio', 'append_column', 'price_per_size', 'OK: +1 cols (price_per_size)', (select count(nullif(p_size, 0)) from part)),
  (3, 'step_01_log', 'append_column', 'log_size', 'OK: +1 cols (log_size)', (select count(p_size) from part)))
 as v(position, step_name, action, "column", result, filled_rows)""")
def _(t):
    done, log = replay(t.part, STEPS)
    filled = per_column(done, numeric_columns(done), {"filled_rows": F.count("value")})
    rows = log.select("position", "step_name", "action", F.explode_outer("columns_added").alias("column"), "result")
    return rows.join(filled, "column", "left").select("position", "step_name", "action", "column", "result", "filled_rows")


@query("replay_written_steps", """select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, round_even(p_retailprice / nullif(p_size, 0), 6) as price_per_size,
 round_even(ln(1 + p_size), 6) as log_size from part""")
def _(t):
    """Like replay_steps, with a step that fails on the row of greatest key."""
    most = t.part.agg(F.max("p_partkey")).first()[0]
    fails = Step("step_04_row", lambda d: d.withColumn("bad", F.when(F.col("p_partkey") == most, F.raise_error(F.lit("row")).cast("int"))))
    done, _ = replay_written(t.part, [*STEPS[:1], fails, *STEPS[1:]], f"{t.sf_dir}/part {most}")
    return r6(done, "price_per_size", "log_size")
