"""Statistics and linear-model queries."""

from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import stats as M, wide as W

from .clean_q import r6
from .core import query
from .profile_q import OUT  # noqa: F401

LD, RG = ("li_dirty",), ("regime",)

G3 = """g as (select sum(l_quantity * l_quantity) a, sum(l_extendedprice * l_extendedprice) b, sum(l_discount * l_discount) c,
  sum(l_quantity * l_extendedprice) d, sum(l_quantity * l_discount) e, sum(l_extendedprice * l_discount) f from li_dirty),
 t as (select *, a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e) as det from g)"""


@query("vif_scores", f"""with {G3} select 'l_quantity' as feature, round_even(a * (b * c - f * f) / det, 6) as vif from t
 union all select 'l_extendedprice', round_even(b * (a * c - e * e) / det, 6) from t
 union all select 'l_discount', round_even(c * (a * b - d * d) / det, 6) from t""", LD)
def _(t):
    return r6(M.vif_scores(t.li_dirty, ["l_quantity", "l_extendedprice", "l_discount", "l_disc_n"]), "vif")


ANOVA = """g as (select cluster, count(*) as n, avg(target) as m, var_samp(target) as v from regime group by 1),
 s as (select count(*) as k, sum(n) as n, sum((n - 1) * v) as ssw, sum(n * (m - (select avg(target) from regime)) ** 2) as ssb from g)"""


@query("anova_by_group", f"""with {ANOVA} select k, cast(n as bigint) as n, round_even((ssb / (k - 1)) / (ssw / (n - k)), 2) as f_stat,
 round_even(ssb / (select var_pop(target) * count(*) from regime), 4) as eta_squared from s""", RG)
def _(t):
    a = M.anova(t.regime, "target", "cluster")
    return a.withColumn("f_stat", rnd(F.col("f_stat"), 2)).withColumn("eta_squared", rnd(F.col("eta_squared"), 4))


@query("anova_test")
def _(t):
    return M.anova_test(t.regime, "target", "cluster")


REG = " union all ".join(f"""select '{f}' as feature, (select count(*) from regime) as n, 3::bigint as k, (with c as (select regr_sxx(target, {f}) xx, regr_sxy(target, {f}) xy, regr_syy(target, {f}) yy from regime group by cluster),
 s as (select sum(yy - xy * xy / xx) as s1, sum(yy) - sum(xy) ** 2 / sum(xx) as s0 from c) select ((s0 - s1) / 2) / (s1 / ((select count(*) from regime) - 6)) from s) as f,
 (with c as (select count(*) n, sum({f}) x, sum(target) y, sum({f} * {f}) xx, sum({f} * target) xy, sum(target * target) yy,
   regr_syy(target, {f}) - regr_sxy(target, {f}) ** 2 / regr_sxx(target, {f}) as e from regime group by cluster),
 s as (select sum(n - x * x / xx) a, sum(y - x * xy / xx) b, sum(yy - xy * xy / xx) c, sum(e) s1 from c)
 select ((c - b * b / a - s1) / 2) / (s1 / ((select count(*) from regime) - 6)) from s) as fi""" for f in ("x", "price", "disc"))


@query("regime_slope_f", f"with r as ({REG}) select feature, n, k, round_even(f, 4) as slope_f, round_even(fi, 3) as intercept_f from r", RG)
def _(t):
    d = M.regime_statistics(t.regime, "target", ["x", "price", "disc"], "cluster")
    return d.withColumn("slope_f", rnd(F.col("slope_f"), 4)).withColumn("intercept_f", rnd(F.col("intercept_f"), 3))


@query("regime_tests")
def _(t):
    return M.regime_tests(t.regime, "target", ["x", "price", "disc", "tax"], "cluster")


OLS = """s as (select count(*) n, avg(charge) my, avg(l_extendedprice) m1, avg(l_tax) m2, var_pop(l_extendedprice) * count(*) s11, var_pop(l_tax) * count(*) s22,
  covar_pop(l_extendedprice, l_tax) * count(*) s12, covar_pop(charge, l_extendedprice) * count(*) s1y, covar_pop(charge, l_tax) * count(*) s2y, var_pop(charge) * count(*) syy from li_dirty),
 b as (select *, s11 * s22 - s12 * s12 as det, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from s),
 e as (select *, syy - b1 * s1y - b2 * s2y as sse, my - b1 * m1 - b2 * m2 as b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) as s2 from b)"""


@query("ols_coefficients", f"""with {OLS}, r as (
 select 'l_extendedprice' as feature, b1 as coef, sqrt(s2 * s22 / det) as se from e
 union all select 'l_tax', b2, sqrt(s2 * s11 / det) from e
 union all select 'const', b0, sqrt(s2 * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)) from e)
 select feature, round_even(coef, 4) as coef, round_even(se, 4) as std_err, round_even(coef / se, 2) as t_stat from r""", LD)
def _(t):
    c = M.fit_ols(t.li_dirty, "charge", ["l_extendedprice", "l_tax"])[0]
    return c.select("feature", rnd(F.col("coef"), 4).alias("coef"), rnd(F.col("std_err"), 4).alias("std_err"), rnd(F.col("t_stat"), 2).alias("t_stat"))


@query("ols_fit_stats", f"""with {OLS}, f as (select *, 1 - sse / syy as r2, n * (ln(2 * pi()) + ln(sse / n) + 1) as base from e)
 select 'charge' as target, false as log_target, n as n_obs, round_even(r2, 6) as r_squared, round_even(1 - (1 - r2) * (n - 1) / (n - 3), 6) as adj_r_squared,
  round_even(base + 6, 2) as aic, round_even(base + 3 * ln(n), 2) as bic from f""", LD)
def _(t):
    f = M.fit_ols(t.li_dirty, "charge", ["l_extendedprice", "l_tax"])[1]
    return r6(f, "r_squared", "adj_r_squared").withColumn("aic", rnd(F.col("aic"), 2)).withColumn("bic", rnd(F.col("bic"), 2))


@query("ols_inference")
def _(t):
    """All columns of the coefficient table, with a category and log target."""
    return M.fit_ols(t.li_dirty, "charge", ["l_extendedprice", "l_discount", "l_tax", "l_returnflag"], log_target=True)[0]


@query("ols_wide_category", """with m as (select l_partkey as g, count(*) as m, avg(charge) as y, avg(l_extendedprice) as x from li_dirty group by 1),
 w as (select sum((l_extendedprice - x) * (l_extendedprice - x)) as xx, sum((l_extendedprice - x) * (charge - y)) as xy from li_dirty join m on g = l_partkey),
 b as (select xy / xx as b from w), z as (select y - b * x as a from m, b order by cast(g as varchar) limit 1)
 select case when cast(g as varchar) = (select min(cast(g as varchar)) from m) then 'const' else concat('part_', g) end as feature,
  round_even(y - b * x - case when cast(g as varchar) = (select min(cast(g as varchar)) from m) then 0 else a end, 3) as coef from m, b, z
 union all select 'l_extendedprice', round_even(b, 3) from b""", LD)
def _(t):
    d = t.li_dirty.withColumn("part", F.col("l_partkey").cast("string"))
    return W.fit_absorbed(d, "charge", ["l_extendedprice", "part"], "part")[0].select("feature", rnd(F.col("coef"), 3).alias("coef"))


@query("ols_top_coefficients", f"""with {OLS} select 'l_tax' as feature, round_even(b2, 4) as coef from e union all select 'l_extendedprice', round_even(b1, 4) from e""", LD)
def _(t):
    c = M.fit_ols(t.li_dirty, "charge", ["l_extendedprice", "l_tax"])[0]
    return M.top_coefficients(c).select("feature", rnd(F.col("coef"), 4).alias("coef"))


@query("partial_residuals", """with f as (select regr_slope(charge, l_tax) a, regr_intercept(charge, l_tax) b, regr_slope(l_extendedprice, l_tax) c, regr_intercept(l_extendedprice, l_tax) d from li_dirty)
 select l_orderkey, l_linenumber, round_even(l_extendedprice - c * l_tax - d, 3) as x_resid, round_even(charge - a * l_tax - b, 3) as y_resid from li_dirty, f""", LD)
def _(t):
    d = M.partial_residuals(t.li_dirty, "charge", ["l_extendedprice", "l_tax"], "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return d.withColumn("x_resid", rnd(F.col("x_resid"), 3)).withColumn("y_resid", rnd(F.col("y_resid"), 3))


@query("partial_residual_box", """with f as (select regr_slope(charge, l_extendedprice) a, regr_intercept(charge, l_extendedprice) b from li_dirty),
 r as (select l_returnflag, charge - a * l_extendedprice - b as y from li_dirty, f)
 select l_returnflag, count(*) as n, round_even(quantile_cont(y, 0.25), 3) as q1, round_even(median(y), 3) as median, round_even(quantile_cont(y, 0.75), 3) as q3 from r group by 1""", LD)
def _(t):
    d = M.partial_residuals(t.li_dirty, "charge", ["l_extendedprice", "l_returnflag"], "l_returnflag")
    return d.select("l_returnflag", "n", *[rnd(F.col(c), 3).alias(c) for c in ("q1", "median", "q3")])


PS = [i / 20 for i in range(21)]
LO = [min(max(0.0, p - 0.15), 0.7) for p in PS]
QS = ", ".join(repr(p) for p in PS), ", ".join(repr(a) for a in LO), ", ".join(repr(a + 0.3) for a in LO)


@query("local_trend", f"""with q as (select quantile_cont(o_custkey::double, [{QS[0]}]) as g, quantile_cont(o_custkey::double, [{QS[1]}]) as a, quantile_cont(o_custkey::double, [{QS[2]}]) as b from orders),
 t as (select cast(i - 1 as int) as grid, g[i] as g, greatest(g[i] - a[i], b[i] - g[i]) as h from q, (select unnest(generate_series(1, 21)) as i)),
 r as (select grid, g, (1 - (abs(o_custkey - g) / h) ** 3) ** 3 as w, o_custkey - g as dx, o_totalprice as y from orders, t where abs(o_custkey - g) < h),
 s as (select grid, g, count(*) n, sum(w) w0, sum(w * dx) w1, sum(w * dx * dx) w2, sum(w * y) v0, sum(w * dx * y) v1 from r group by 1, 2)
 select grid, round_even(g, 6) as x, round_even((w2 * v0 - w1 * v1) / (w0 * w2 - w1 * w1), 3) as trend, n from s""")
def _(t):
    d = M.local_trend(t.orders, "o_custkey", "o_totalprice")
    return r6(d, "x").withColumn("trend", rnd(F.col("trend"), 3))


@query("robust_trend")
def _(t):
    d = M.robust_trend(t.orders, "o_custkey", "o_totalprice")
    return d.select("grid", rnd(F.col("x"), 3).alias("x"), rnd(F.col("trend"), 2).alias("trend"), "n")
