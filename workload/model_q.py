"""Selection and model queries."""

from functools import lru_cache

from pyspark.sql import SparkSession, functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import models as L, selection as X
from tablescope.plans.select_run import result_rows, run_models, run_selection

from .clean_q import r6
from .core import Tables, query
from .profile_q import ALL, NUM, PAIRS, TEXT, corr_sql

LD, DL, SCORED = ("li_dirty",), ("docs_labelled",), ("scored",)


def s1(cols, src):
    return " union all ".join(
        f"""select '{c}' as c, (count(*) - count({c})) / cast(count(*) as double) as miss, count(distinct {c}) as u, count(*) as n,
         {f'stddev_samp({c})' if c in NUM else 'null'} as sd, {str(c in NUM).lower()} as num from {src}""" for c in cols)


@query("select_stage1", "with s as (" + s1(ALL, "li_dirty") + """), r as (select c, case when c = 'charge' then null when miss > 0.7 then 'missing ' || format('{:.0f}', miss * 100) || '%'
  when num and sd < 0.001 then 'near-zero variance (std=' || format('{:.6f}', sd) || ')' when not num and u / cast(n as double) > 0.95 then 'ID-like column (unique ratio=' || format('{:.2f}', u / cast(n as double)) || ')'
  when u <= 1 then 'constant (1 unique value)' end as reason from s) select c as "column", reason is null as kept, reason from r""", LD)
def _(t):
    return X.stage1(t.li_dirty, "charge")


SURV = [c for c in ALL if c != "l_const"]
SN = [c for c in NUM if c != "l_const"]


@query("select_stage2", "with p as (" + " union all ".join(
    f"select '{a}' as a, '{b}' as b, abs({corr_sql(a, b)}) as r" for _, _, a, b in PAIRS if "l_const" not in (a, b)) +
    "), e as (select a, b from p where r >= 0.85 union select b, a from p where r >= 0.85 union " + " union ".join(f"select '{c}', '{c}'" for c in SN) + """),
 st as (""" + " union all ".join(f"select {SN.index(c)} as i, '{c}' as c, var_samp({c}) as v, 1 - count({c}) / cast(count(*) as double) as m from li_dirty" for c in SN) + """),
 k as (select e.a as c, min(s.i) as g from e join st s on s.c = e.b group by 1),
 w as (select k.c, g, first_value(k.c) over (partition by g order by v desc, m, length(k.c), k.c desc) as best from k join st on st.c = k.c),
 num as (select *, dense_rank() over (order by g) as cl from w)
 select c as "column", cast(cl as int) as cluster, c = best as kept, case when c <> best then 'correlated with ' || best || ' (cluster ' || cl || ')' end as reason from num
 union all """ + " union all ".join(f"select '{c}', null, true, null" for c in SURV if c not in SN), LD)
def _(t):
    return X.stage2(t.li_dirty, SURV)


R3 = ["l_quantity", "l_extendedprice", "revenue"]


def ridge(i):
    o = [c for c in R3 if c != R3[i]]
    return f"""select '{R3[i]}' as c, (with v as (select count(*) n, corr({o[0]}, {o[1]}) r, corr({R3[i]}, {o[0]}) a, corr({R3[i]}, {o[1]}) b from li_dirty),
     d as (select *, (n + 1.0) * (n + 1.0) - n * r * n * r as det from v), w as (select *, n * ((n + 1.0) * a - n * r * b) / det as x, n * ((n + 1.0) * b - n * r * a) / det as y from d)
     select round_even(2 * (x * a + y * b) - (x * x + y * y + 2 * x * y * r), 4) from w) as r2"""


@query("select_stage3", "with s as (" + " union all ".join(ridge(i) for i in range(3)) + """) select c as "column", r2 as predictability_r2, r2 <= 0.95 as kept,
 case when r2 > 0.95 then 'redundant (R²=' || format('{:.3f}', r2) || ' from other features)' end as reason from s
 union all select 'l_returnflag', null, true, null union all select 'charge', null, true, null""", LD)
def _(t):
    return X.stage3(t.li_dirty, [*R3, "l_returnflag", "charge"], "charge")


def qbin(c, src):
    e = f"(select list_sort(list_distinct(quantile_cont(coalesce({c}, 0)::double, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) from {src})"
    return f"greatest(len(list_filter({e}, lambda v: v < coalesce({c}, 0))), 1)"


def mi_sql(feats, target_bin, src):
    parts = " union all ".join(f"select '{f}' as f, {qbin(f, src)} as b, {target_bin} as t from {src}" for f in feats)
    return f"""b as ({parts}), j as (select f, b, t, count(*) as n from b group by all),
     m as (select f, n, sum(n) over (partition by f, b) as nb, sum(n) over (partition by f, t) as nt, sum(n) over (partition by f) as a from j),
     mi as (select f, round_even(greatest(sum(n / cast(a as double) * ln(cast(n as double) * a / (cast(nb as double) * nt))), 0), 4) as mi from m group by 1)"""


@query("mutual_information", f"with {mi_sql(['l_quantity', 'l_extendedprice', 'l_disc_n'], 'l_returnflag', 'li_dirty')} select f as feature, mi as mutual_info from mi", LD)
def _(t):
    return X.mutual_information(t.li_dirty, ["l_quantity", "l_extendedprice", "l_disc_n"], "l_returnflag")


@query("select_stage4", f"with {mi_sql(['l_quantity', 'l_extendedprice', 'l_disc_n'], qbin('charge', 'li_dirty'), 'li_dirty')}" + """,
 r as (select 'l_quantity' as f, corr(charge, l_quantity) as r from li_dirty union all select 'l_extendedprice', corr(charge, l_extendedprice) from li_dirty
  union all select 'l_disc_n', corr(charge, coalesce(l_disc_n, 0)) from li_dirty)
 select mi.f as "column", mi as mutual_info, round_even(abs(r.r), 4) as target_corr, true as kept from mi join r on r.f = mi.f
 union all select 'l_returnflag', null, null, true""", LD)
def _(t):
    return X.stage4(t.li_dirty, ["l_quantity", "l_extendedprice", "l_disc_n", "l_returnflag", "charge"], "charge")


@query("select_stage6", "with s as (" + s1([c for c in ALL if c not in NUM], "li_dirty") + """) select c as "column", case when c = 'l_shipdate' then 'datetime — time series charts'
 else 'categorical (' || u || ' values) — segmentation/faceting' end as reason from s where c = 'l_shipdate' or u between 2 and 30""", LD)
def _(t):
    return X.stage6(t.li_dirty, ALL)


@query("select_stage5")
def _(t):
    """Mean absolute attribution of the numeric features."""
    fit = L.fit_tree(t.events.withColumn("hour", F.hour("ts")), "event_type", ["value", "user_id", "hour"], "event_id", trees=100, depth=3)
    return L.shap_importance(fit)


def with_row_id(lines):
    return lines.withColumn("row_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query("selection_full_run")
def _(t):
    return run_selection(with_row_id(t.li_dirty), "charge", "row_id")["decisions"]


@query("selection_scores")
def _(t):
    d = t.part.withColumn("half_size", F.col("p_size") / 2 + F.col("p_partkey") % 3)
    return run_selection(d, "p_retailprice", "p_partkey")["scores"]


@query("selection_waterfall")
def _(t):
    return run_selection(with_row_id(t.li_dirty), "charge", "row_id")["stages"]


@query("infer_task", """select 'quality' as target, count(distinct quality) as n_unique, case when count(distinct quality) <= 20 then 'classify' else 'regress' end as task from docs_labelled
 union all select 'n_chars', count(distinct n_chars), case when count(distinct n_chars) <= 20 then 'classify' else 'regress' end from docs_labelled""", DL)
def _(t):
    return L.infer_task(t.docs_labelled, "quality").union(L.infer_task(t.docs_labelled, "n_chars"))


@query("confusion_matrix", """with l as (select distinct actual from scored), c as (select actual, pred, count(*) as n from scored group by 1, 2)
 select a.actual, p.actual as predicted, coalesce(n, 0) as n from l a cross join l p left join c on c.actual = a.actual and c.pred = p.actual""", SCORED)
def _(t):
    return L.confusion_matrix(t.scored, "actual", "pred")


@query("confusion_counts", """with l as (select distinct actual from scored)
 select actual, pred as predicted, count(*) as n from scored where pred in (select actual from l) group by 1, 2""", SCORED)
def _(t):
    return L.confusion_matrix(t.scored, "actual", "pred", zeros=False)


ROC = """c as (select score, sum(actual) as pos, sum(1 - actual) as neg from scored group by 1),
 r as (select score, pos, neg, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp, sum(pos) over () as p, sum(neg) over () as n from c)"""


@query("roc_curve", f"""with {ROC} select score as threshold, round_even(fp / cast(n as double), 9) as fpr, round_even(tp / cast(p as double), 9) as tpr from r
 union all select null, 0.0, 0.0""", SCORED)
def _(t):
    d = L.roc_curve(t.scored, "actual", "score")
    return d.withColumn("fpr", rnd(F.col("fpr"), 9)).withColumn("tpr", rnd(F.col("tpr"), 9))


@query("auc_score", f"""with {ROC}, g as (select *, lag(tp, 1, 0) over (order by score desc) as tp0, lag(fp, 1, 0) over (order by score desc) as fp0 from r)
 select cast(max(p) as bigint) as positives, cast(max(n) as bigint) as negatives, round_even(sum((fp - fp0) * (tp + tp0) / 2.0) / (cast(max(p) as double) * max(n)), 9) as auc from g""", SCORED)
def _(t):
    return L.auc_score(t.scored, "actual", "score").withColumn("auc", rnd(F.col("auc"), 9))


OVR = " union all ".join(f"""select '{k}' as class, (with c as (select score, count(*) filter (where l_returnflag = '{k}') as pos, count(*) filter (where l_returnflag <> '{k}') as neg from scored group by 1),
 r as (select pos, neg, sum(pos) over (order by score desc) as tp from c) select round_even(sum(neg * (2 * tp - pos)) / 2.0 / (cast(sum(pos) as double) * sum(neg)), 9) from r) as auc""" for k in "ANR")


@query("auc_one_vs_rest", OVR, SCORED)
def _(t):
    return L.auc_one_vs_rest(t.scored, "l_returnflag", {k: "score" for k in "ANR"}).withColumn("auc", rnd(F.col("auc"), 9))


@query("classification_scores", """with k as (select actual as c from scored union select pred from scored),
 m as (select c, (select count(*) from scored where actual = c) as a, (select count(*) from scored where pred = c) as p, (select count(*) from scored where actual = c and pred = c) as h from k)
 select round_even(sum(a * coalesce(h / nullif(cast(p as double), 0), 0)) / sum(a), 6) as precision, round_even(sum(a * coalesce(h / nullif(cast(a as double), 0), 0)) / sum(a), 6) as recall,
  round_even(sum(a * coalesce(2.0 * h / nullif(a + p, 0), 0)) / sum(a), 6) as f1, round_even(sum(h) / cast(sum(a) as double), 6) as accuracy, cast(sum(a) as bigint) as n from m""", SCORED)
def _(t):
    return r6(L.classification_scores(t.scored, "actual", "pred"), "precision", "recall", "f1", "accuracy")


@query("r2_score", """select count(*) as n, round_even(1 - sum((charge - revenue) ** 2) / (var_pop(charge) * count(*)), 6) as r2 from li_dirty""", LD)
def _(t):
    return r6(L.r2_score(t.li_dirty, "charge", "revenue"), "r2")


@lru_cache(maxsize=2)
def fitted_prices(app, sf_dir):
    """One model for all questions asked of it in a session."""
    part = Tables(SparkSession.active(), sf_dir).part
    return L.fit_tree(part, "p_retailprice", ["p_size", "p_partkey", "p_type"], "p_partkey", trees=200, depth=3, log_target=True)


def price_fit(t):
    return fitted_prices(t.spark.sparkContext.applicationId, t.sf_dir)


@query("tree_importance")
def _(t):
    return price_fit(t).importance()


@query("tree_metric")
def _(t):
    return price_fit(t).summary()


@query("cv_f1")
def _(t):
    d = t.events.withColumn("big", F.when(F.col("value") > 20, "yes").otherwise("no")).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return L.cv_f1(d, "big", ["user_id", "k"], "event_id", trees=100, depth=3)


@query("permutation_importance")
def _(t):
    return L.permutation_importance(price_fit(t), 5)


@query("shap_importance")
def _(t):
    return L.shap_importance(price_fit(t))


@query("shap_dependence")
def _(t):
    return L.shap_dependence(price_fit(t), "p_partkey", "p_size")


@query("actual_vs_predicted")
def _(t):
    return L.actual_vs_predicted(price_fit(t))


@query("model_run")
def _(t):
    return result_rows(run_models(t.part, "p_retailprice", ["p_size", "p_partkey", "p_type"], "p_partkey"))


@query("lag_features", "select ts, event_id, value, row_number() over w as row_index, " + ", ".join(f"lag(value, {k}) over w as lag_{k}" for k in range(1, 13)) +
       " from events window w as (order by ts, event_id)")
def _(t):
    return L.lag_features(t.events, ["ts", "event_id"], "value")


@query("lag_scores", """with w as (select value as v, cast(event_type = 'click' as int) as y, row_number() over o as rn, """ + ", ".join(f"lag(value, {k}) over o as l{k}" for k in range(1, 13)) + """
   from events window o as (order by ts, event_id)),
 c as (select *, rn - 12 as pos, (select count(*) - 12 from w) as n from w where rn > 12),
 z as (select *, n // 6 as sz, n - 5 * (n // 6) as f0 from c),
 p as (select *, cast(case when pos <= f0 then 0 else least((pos - f0 - 1) // sz + 1, 5) end as int) as part from z),
 e as (select list_sort(list_distinct(quantile_cont(v, [""" + ", ".join(repr(i / 16) for i in range(17)) + """]))) as es from p where part = 0),
 b as (select part, y, lag, greatest(len(list_filter(es[1:len(es) - 1], lambda q: q < v)), 1) as bin from (
   """ + " union all ".join(f"select part, y, {k} as lag, l{k} as v from p" for k in range(1, 13)) + """), e),
 k as (select part, lag, bin, count(*) as n, sum(y) as pos from b group by 1, 2, 3),
 f as (select unnest(generate_series(1, 5)) as fold),
 tr as (select fold, lag, bin, sum(n) as tn, sum(pos) as tp from k join f on part < fold group by 1, 2, 3),
 df as (select fold, lag, sum(tp) * 2 > sum(tn) as d from tr group by 1, 2),
 j as (select k.lag, k.part as fold, k.n, k.pos, coalesce(tp * 2 > tn, d) as say from k left join tr on tr.fold = k.part and tr.lag = k.lag and tr.bin = k.bin
   join df on df.fold = k.part and df.lag = k.lag where k.part > 0),
 s as (select lag, fold, sum(case when say then pos else 0 end) as tp, sum(case when say then n - pos else 0 end) as fp, sum(pos) as p, sum(n - pos) as q from j group by 1, 2)
 select cast(lag as int) as lag, round_even(avg(case when p = 0 or q = 0 then 0.5 else (tp / cast(p as double) + 1 - fp / cast(q as double)) / 2 end), 6) as score from s group by 1""")
def _(t):
    d = L.lag_scores(t.events.withColumn("y", (F.col("event_type") == "click").cast("int")), ["ts", "event_id"], "value", "y")
    return r6(d, "score")
