"""Profiling queries."""

from tablescope.operators import profile as P

from .core import query

NUM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
       "l_tax_n l_disc_n l_const revenue charge").split()
ALL = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
       "l_returnflag l_linestatus l_shipdate l_tax_n l_disc_n l_const revenue charge").split()
INT = {"l_linenumber", "l_const"}
LONG = {"l_orderkey", "l_partkey", "l_suppkey"}
TEXT = {"l_returnflag", "l_linestatus"}


def dtype(c):
    if c in LONG:
        return "bigint"
    if c in INT:
        return "int"
    if c in TEXT:
        return "string"
    return "timestamp_ntz" if c == "l_shipdate" else "double"


def per(cols, template):
    """UNION ALL of the template per column; {c} and {t} are name and type."""
    return " union all ".join(template.replace("{c}", c).replace("{t}", dtype(c)) for c in cols)


OUT = """(select count(*) from li_dirty, (select quantile_cont({c}, 0.25) a, quantile_cont({c}, 0.75) b from li_dirty) f
  where {c} < a - 1.5 * (b - a) or {c} > b + 1.5 * (b - a))"""


@query("table_summary", """
 select count(*) as row_count, 11 as col_count,
  count(*) - (select count(*) from (select distinct * from li_dup)) as duplicate_rows,
  cast(0 as bigint) as missing_total from li_dup""", ("li_dup",))
def _(t):
    return P.table_summary(t.li_dup)


@query("column_profile", per(ALL, """select '{c}' as "column", '{t}' as dtype, count(*) - count({c}) as null_count,
 round_even((count(*) - count({c})) / cast(count(*) as double) * 100, 1) as null_pct, count(distinct {c}) as unique_count from li_dirty"""), ("li_dirty",))
def _(t):
    return P.column_profile(t.li_dirty)


@query("numeric_profile", per(NUM, """select '{c}' as "column", cast(min({c}) as double) as min, cast(max({c}) as double) as max,
 round_even(avg({c}), 4) as mean, round_even(stddev_samp({c}), 4) as std, cast(median({c}) as double) as median from li_dirty"""), ("li_dirty",))
def _(t):
    return P.numeric_profile(t.li_dirty)


@query("iqr_outliers", per(NUM, f"""select '{{c}}' as "column",
 round_even({OUT} / cast(count(*) as double) * 100, 1) as outlier_pct from li_dirty"""), ("li_dirty",))
def _(t):
    return P.iqr_outliers(t.li_dirty)


@query("top_values", """
 with vc as (
   select 'l_returnflag' as c, l_returnflag as value, count(*) as n from li_dirty group by 2
   union all select 'l_linestatus', l_linestatus, count(*) from li_dirty group by 2
   union all select 'l_shipdate', cast(l_shipdate as varchar), count(*) from li_dirty group by 2)
 select c as "column", cast(row_number() over (partition by c order by n desc, value) as int) as rank, value, n as "count"
 from vc where value is not null qualify rank <= 5""", ("li_dirty",))
def _(t):
    return P.top_values(t.li_dirty)


@query("numeric_summary", per(NUM, f"""select '{{c}}' as "column", '{{t}}' as dtype, count(*) - count({{c}}) as nulls,
 round_even((count(*) - count({{c}})) / cast(count(*) as double) * 100, 1) as null_pct, count(distinct {{c}}) as "unique",
 cast(min({{c}}) as double) as min, round_even(quantile_cont(cast({{c}} as double), 0.25), 2) as q25, cast(median({{c}}) as double) as median,
 round_even(quantile_cont(cast({{c}} as double), 0.75), 2) as q75, cast(max({{c}}) as double) as max,
 round_even(avg({{c}}), 4) as mean, round_even(stddev_samp({{c}}), 4) as std,
 case when min({{c}}) = max({{c}}) then null else round_even(skewness({{c}}), 2) end as skew,
 round_even({OUT} / cast(count(*) as double) * 100, 1) as outlier_pct,
 case when min({{c}}) < max({{c}}) and abs(round_even(skewness({{c}}), 2)) > 1 then 'yes' else '' end as needs_log
 from li_dirty"""), ("li_dirty",))
def _(t):
    return P.numeric_summary(t.li_dirty)


@query("value_counts", """
 with vc as (
   select 'lang' as c, coalesce(lang, '(Null)') as value, count(*) as n from docs_labelled group by 2
   union all select 'source', coalesce(source, '(Null)'), count(*) from docs_labelled group by 2),
 r as (select *, row_number() over (partition by c order by n desc, value) as rk, count(*) over (partition by c) as k,
   sum(n) over (partition by c) as tot from vc)
 select c as "column", cast(rk as int) as rank, value, n as "count", round_even(n / cast(tot as double) * 100, 1) as pct from r where rk <= 10
 union all
 select c, 11, '(' || cast(max(k) - 10 as varchar) || ' more)', cast(sum(n) as bigint), round_even(sum(n) / cast(max(tot) as double) * 100, 1)
 from r where rk > 10 group by c""", ("docs_labelled",))
def _(t):
    return P.value_counts_report(t.docs_labelled)


PAIRS = [(i, j, a, b) for i, a in enumerate(NUM) for j, b in enumerate(NUM) if i < j]


def corr_sql(a, b, src="li_dirty"):
    return (f"(select case when isnan(corr({b}, {a})) then null else corr({b}, {a}) end from {src})")


@query("correlation_pairs", "with p as (" + " union all ".join(
    f"select {i} as i, {j} as j, '{a}' as col_a, '{b}' as col_b, {corr_sql(a, b)} as r" for i, j, a, b in PAIRS
) + ") select i, j, col_a, col_b, round_even(r, 3) as r from p", ("li_dirty",))
def _(t):
    return P.correlation_pairs(t.li_dirty)


@query("column_assessment", "with s as (" + per(ALL, """
  select '{c}' as c, '{t}' as dtype, count(*) as n, count(distinct {c}) as u,
   round_even((count(*) - count({c})) / cast(count(*) as double) * 100, 1) as null_pct,
   (select max(k) from (select count(*) as k from li_dirty where {c} is not null group by {c})) as top from li_dirty""") + """),
 m as (""" + per(NUM, f"""select '{{c}}' as c, case when min({{c}}) = max({{c}}) then 0 else skewness({{c}}) end as skew,
   round_even({OUT} / cast(count(*) as double) * 100, 1) as o from li_dirty""") + """),
 j as (select s.*, m.skew, m.o, m.c is not null as isnum from s left join m on s.c = m.c),
 f as (select c, dtype, u, null_pct, list_filter([
   case when null_pct > 50 then 'majority_missing|consider_dropping' when null_pct > 5 then
      case when isnum then 'significant_missing|impute_median' else 'significant_missing|impute_mode' end
      when null_pct > 0 then 'minor_missing|impute_or_drop_rows' end,
   case when isnum and abs(skew) > 1.5 then 'high_skew|log_transform' end,
   case when isnum and o > 5 then 'high_outliers|clip_or_winsorize' end,
   case when isnum and u = 1 then 'constant|drop_column' when isnum and u <= 10 then 'low_cardinality_numeric|treat_as_categorical' end,
   case when not isnum and u > 100 then 'high_cardinality|group_rare_categories' when not isnum and u = 1 then 'constant|drop_column' end,
   case when not isnum and top / cast(n as double) > 0.8 then 'severe_imbalance|stratified_sampling'
        when not isnum and top / cast(n as double) > 0.5 then 'moderate_imbalance|' end,
   case when u = n then 'all_unique|likely_id_or_key' end], lambda x: x is not null) as l from j)
 select c as "column", dtype, u as "unique", null_pct,
  case when len(l) = 0 then 'clean' else array_to_string(list_transform(l, lambda x: split_part(x, '|', 1)), '; ') end as flags,
  case when len(list_filter(l, lambda x: split_part(x, '|', 2) <> '')) = 0 then 'none_needed' else
   array_to_string(list_filter(list_transform(l, lambda x: split_part(x, '|', 2)), lambda x: x <> ''), '; ') end as suggested_strategy from f""", ("li_dirty",))
def _(t):
    return P.column_assessment(t.li_dirty)


@query("nan_columns", "with s as (" + per(ALL, """select '{c}' as c, '{t}' as ty, (count(*) - count({c})) / cast(count(*) as double) as p from li_dirty""") + """)
 select c as "column", case when ty = 'string' then 'categorical' when ty = 'timestamp_ntz' then 'other' else 'numeric' end as class,
  round_even(p, 6) as null_share, p > 0.2 as over_threshold from s""", ("li_dirty",))
def _(t):
    return P.column_classes(t.li_dirty)


@query("drop_correlated", "with p as (" + " union all ".join(
    f"select '{b}' as c, abs({corr_sql(a, b)}) as r" for i, j, a, b in PAIRS
) + """) select c as "column", round_even(max(r), 6) as max_abs_r, coalesce(max(r) > 0.9, false) as dropped from p group by c""", ("li_dirty",))
def _(t):
    return P.correlated_columns(t.li_dirty)


@query("drop_constant", "select " + ", ".join(c for c in ALL if c != "l_const") + " from li_dirty", ("li_dirty",))
def _(t):
    return P.drop_constant(t.li_dirty)


O_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
          ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("table_snapshot", " union all ".join(
    f"""select 'orders_raw' as name, '' as parent, '10-eda' as created_by, count(*) as row_count, 6 as col_count, '{c}' as "column",
    '{ty}' as dtype, count(distinct {c}) as n_unique, count(*) - count({c}) as n_null,
    cast(arg_min({c}, o_orderkey) as varchar) as sample_val from orders""" for c, ty in O_COLS))
def _(t):
    return P.table_snapshot(t.orders, "o_orderkey", "orders_raw", "10-eda")


@query("schema_delta", per([c for c in ALL if c != "l_tax"], """select '{c}' as "column",
   case when '{c}' in ('l_tax_n', 'l_disc_n', 'l_const', 'revenue', 'charge') then 'added' else 'original' end as status,
   '{t}' as dtype, count({c}) as non_null from li_dirty""") + " union all select 'l_tax', 'removed', 'double', null", ("li_dirty",))
def _(t):
    return P.schema_delta(t.lineitem, t.li_dirty.drop("l_tax"))


@query("describe_numeric", per(NUM, """select '{c}' as "column", count({c}) as "count", round_even(avg({c}), 4) as mean,
 round_even(stddev_samp({c}), 4) as std, cast(min({c}) as double) as min, cast(max({c}) as double) as max from li_dirty"""), ("li_dirty",))
def _(t):
    return P.describe_numeric(t.li_dirty)
