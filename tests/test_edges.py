"""Empty tables, one row, null, constant and single-group input."""

import pytest
from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import charts as G, clean as C, cluster as K, features as E, jsonfields as J, models as L, profile as P, selection as X, stats as M
from tablescope.plans.replay import Step, replay
from tablescope.sources import files as S

SCHEMA = "id long, x double, k double, void double, g string"
FRAMES = {
    "empty": [], "one": [(1, 2.0, 1.0, None, "a")],
    "group": [(i, float(i), 1.0, None, "a") for i in range(6)],
}


@pytest.fixture(params=sorted(FRAMES))
def frame(request, spark):
    return spark.createDataFrame(FRAMES[request.param], SCHEMA)


OPERATORS = {
    "summary": P.table_summary, "columns": P.column_profile, "numeric": P.numeric_profile, "outliers": P.iqr_outliers, "top": P.top_values,
    "summary_table": P.numeric_summary, "values": P.value_counts_report, "pairs": P.correlation_pairs, "assessment": P.column_assessment,
    "classes": P.column_classes, "correlated": P.drop_correlated, "constant": P.drop_constant, "describe": P.describe_numeric,
    "snapshot": lambda d: P.table_snapshot(d, "id", "t"), "delta": lambda d: P.schema_delta(d, d.drop("x")),
    "impute": lambda d: C.impute_missing(d, {"void": "impute_median", "g": "impute_mode"}), "sparse": C.drop_sparse, "flags": C.flag_outliers, "useless": C.drop_useless,
    "near": lambda d: C.near_duplicate_categories(d, "g"), "z": lambda d: E.standardise(d, ["x", "k"]), "clip": lambda d: E.clip(d, "x"),
    "bins": lambda d: E.bins(E.bins(d, "x", width=4), "x", quantiles=4), "index": lambda d: E.group_index(d, "g", "x"), "hot": lambda d: E.one_hot(d, "g"),
    "rare": lambda d: E.group_rare(d, "g", 2), "ks": lambda d: E.ks_two_sample(d, "g", "a", "b", "x"), "imbalance": lambda d: E.class_imbalance(d, "g"),
    "histogram": G.histogram_data, "cumsum": G.category_cumsum, "bars": G.category_bars, "map": G.missing_map, "box": lambda d: G.box_stats_by_category(d, "x", "g"),
    "auto": G.auto_box_target, "scatter": lambda d: G.binned_scatter(d, "x", "k"), "variance": lambda d: G.variance_decomposition(d, "x", ["g", "k"]),
    "radar": lambda d: G.cluster_radar(d.withColumn("c", F.lit(0)), "c", ["x", "k", "void"]), "lines": lambda d: G.interaction_lines(d, "x", "k", "g"),
    "anova": lambda d: M.anova(d, "x", "g"), "regime": lambda d: M.regime_tests(d, "x", ["k"], "g"), "vif": M.vif_scores, "trend": lambda d: M.local_trend(d, "x", "k"),
    "sizes": lambda d: K.cluster_size_check(d, "g"), "silhouette": lambda d: K.silhouette(d.withColumn("c", F.lit(0)), "id", ["x"], "c"),
    "stage1": lambda d: X.stage1(d, "x"), "stage2": lambda d: X.stage2(d, d.columns), "stage3": lambda d: X.stage3(d, d.columns),
    "stage4": lambda d: X.stage4(d, d.columns, "x"), "stage6": lambda d: X.stage6(d, d.columns), "task": lambda d: L.infer_task(d, "x"),
    "auc": lambda d: L.auc_score(d, "g", "x", "a"), "scores": lambda d: L.classification_scores(d, "g", "g"), "r2": lambda d: L.r2_score(d, "x", "x"), "lag": lambda d: L.lag_features(d, ["id"], "x", 2),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_survives(frame, name):
    OPERATORS[name](frame).collect()


def test_constant_and_null_columns(spark):
    d = spark.createDataFrame(FRAMES["group"], SCHEMA)
    a = {r["column"]: r for r in P.column_assessment(d).collect()}
    assert a["k"]["flags"] == "constant" and a["void"]["null_pct"] == 100.0 and "majority_missing" in a["void"]["flags"]
    assert {r["r"] for r in P.correlation_pairs(d).collect() if "k" in (r["col_a"], r["col_b"])} == {None}
    assert set(P.drop_constant(d).columns) == {"id", "x"}
    r = M.anova_test(d, "x", "g").first()
    assert (r["f_stat"], r["p_value"], r["eta_squared"]) == (0.0, 1.0, 0.0)


def test_half_even_rounding(spark):
    got = spark.createDataFrame([(2.5,), (3.5,), (0.125,), (-2.5,)], "x double").select(rnd(F.col("x"), 0).alias("a"), rnd(F.col("x"), 2).alias("b")).collect()
    assert [r["a"] for r in got] == [2.0, 4.0, 0.0, -2.0] and got[2]["b"] == 0.12


def test_cleaning_steps_may_run_twice(spark):
    d = spark.createDataFrame([("1,234.5", "01 TO 03", "61 years 04 months", "2020-05"), ("x", "?", "", "bad")], "n string, r string, l string, m string")
    run = lambda f: C.parse_date(C.duration_years(C.range_midpoint(C.comma_number(f, "n"), "r"), "l"), "m")
    once = run(d)
    assert once.collect() == run(once).collect()
    a, b = once.collect()
    assert (a["n"], a["r"], str(a["m"])) == (1234.5, 2.0, "2020-05-01") and a["l"] == pytest.approx(61 + 4 / 12) and tuple(b) == (None,) * 4


def test_replay_skips_and_replaces(spark):
    d = spark.range(3).withColumn("x", F.col("id") * 1.0)
    steps = [Step("a", lambda f: f.withColumn("p", F.lit(1))), Step("bad", lambda f: f.select("nope")), Step("a", lambda f: f.withColumn("q", F.lit(2)))]
    done, log = replay(d, steps)
    assert done.columns == ["id", "x", "q"]
    assert [(r["step_name"], r["result"][:6]) for r in log.orderBy("position").collect()] == [("bad", "FAILED"), ("a", "OK: +1")]


def test_near_duplicates_against_all_pairs(spark):
    import random

    rnd_ = random.Random(2)
    words = sorted({"".join(rnd_.choice("ab") for _ in range(rnd_.randint(0, 6))) for _ in range(60)})

    def distance(s, t):
        row = list(range(len(t) + 1))
        for i, a in enumerate(s, 1):
            last, row[0] = row[0], i
            for j, b in enumerate(t, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
        return row[-1]

    want = {(a, b, distance(a, b)) for a in words for b in words if a < b and distance(a, b) <= 2}
    got = C.near_duplicate_categories(spark.createDataFrame([(w,) for w in words], "w string"), "w")
    assert {tuple(r) for r in got.collect()} == want


def test_json_normalisers(spark):
    rows = [(None,), ('"a"',), ('["a","b"]',), ('[{"feature":"a"},{"z":"b"}]',), ('{"feature":"a"}',), ('" "',), ("7",), ("not json",)]
    d = spark.createDataFrame(rows, "j string")
    got = [r[0] for r in d.select(J.json_to_string_list(F.col("j"))).collect()]
    assert got == [[], ["a"], ["a", "b"], ["a", "b"], ["a"], [], ["7"], []]
    e = spark.createDataFrame([('"clean"',), (None,), ('{"z":"y","value":"x"}',), ('{"z":"y"}',)], "j string")
    assert [r[0] for r in e.select(J.json_to_string(F.col("j"))).collect()] == ["clean", "", "x", "y"]


def test_files(spark, tmp_path):
    import hashlib

    body = b"a,b\n1,NaN\n2,3.5\n"
    (tmp_path / "flats.csv").write_bytes(body)
    r = S.content_catalog(spark, str(tmp_path)).first()
    assert tuple(r) == ("local_" + hashlib.md5(body).hexdigest()[:12], "flats", 2)
    d = S.read_csv(spark, str(tmp_path / "flats.csv"))
    assert [tuple(x) for x in d.orderBy("a").collect()] == [(1, None), (2, 3.5)]
    S.write_csv(d, str(tmp_path / "out"))
    assert S.read_csv(spark, str(tmp_path / "out"), "a int, b double").count() == 2


def test_a_common_prefix_joins_nothing(spark):
    """Codes of one form: what meets is near the number of true pairs."""
    step = 7919  # any two codes differ in several digits
    codes = spark.range(20_000).selectExpr(f"concat('Customer#', lpad(cast((id * {step} * 1009) % 1000000007 as string), 10, '0')) as v")
    met = C.met_by_deletions(codes, 2)
    near = met.distinct().filter(F.levenshtein("short", "long") <= 2).count()
    assert 0 < near <= met.count() <= 5 * 20_000


def test_long_values_meet_on_pieces(spark):
    base = "x" * 30 + "abcdefghij" * 3
    words = [base, base[:-1], base + "k", base[:10] + "?" + base[11:], base[5:], base[: C.SHORT], base[: C.SHORT + 1], base[: C.SHORT - 1]]
    got = {(r.value_a, r.value_b, r.distance) for r in C.near_duplicate_categories(spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    assert got == {(a, b, edits(a, b)) for a in words for b in words if a < b and edits(a, b) <= 2}
