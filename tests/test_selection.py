"""The staged selection run: every stage takes part and shows in the result."""

import random

import pytest

from tablescope.plans import select_run

SCHEMA = "id long, x double, z double, g string, y double"


@pytest.fixture(scope="module")
def sold(spark):
    """y follows x, which varies more; every third row has no id."""
    draw = random.Random(5)
    rows = []
    for i in range(600):
        x, z = draw.uniform(0, 100), draw.uniform(0, 10)
        rows.append((None if i % 3 == 0 else i, x, z, "abc"[i % 3], 0.9 * x + z))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def run(sold):
    fits, fit_tree = [], select_run.models.fit_tree
    with pytest.MonkeyPatch.context() as m:
        m.setattr(select_run.models, "fit_tree", lambda *a, **k: fits.append(fit_tree(*a, **k)) or fits[-1])
        return select_run.run_selection(sold, "y", "id", trees=5), fits


def test_a_target_like_a_feature_stays(run):
    out, _ = run
    assert [r["stage"] for r in out["stages"].collect()] == [1, 2, 3, 4, 5, 6]
    assert {r["column"] for r in out["decisions"].collect() if r["kept"]} == {"id", "x", "z", "g", "y"}


def test_a_decision_shows_what_the_stages_found(run):
    out, _ = run
    d = {r["column"]: r for r in out["decisions"].collect()}
    assert d["x"]["mutual_info"] > d["z"]["mutual_info"] >= 0 and d["x"]["target_corr"] > 0.9
    assert d["x"]["shap"] > d["z"]["shap"] >= 0 and d["id"]["shap"] is None and d["y"]["shap"] is None
    assert all(d[c]["predictability_r2"] is not None for c in ("id", "x", "z"))
    assert {c for c in d if d[c]["chart_reason"]} == {"g"} == {r["column"] for r in out["retained"].collect()}
    scores = {(r["column"], r["metric"]): r["value"] for r in out["scores"].collect()}
    assert all(d[c][m] == v for (c, m), v in scores.items())


def test_rows_without_an_id_are_fitted(run, sold):
    _, (fit,) = run
    assert fit.n_train + fit.n_test == sold.count() and fit.n_test > 0


def test_stage_two_groups_features_alone(sold):
    s = select_run.selection.stage2
    assert {r["column"] for r in s(sold, ["x", "z", "y"]).collect() if not r["kept"]} == {"y"}
    assert {r["column"] for r in s(sold, ["x", "z", "y"], target="y").collect() if not r["kept"]} == set()
