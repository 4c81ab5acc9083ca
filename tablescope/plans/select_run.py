"""The whole staged selection and the model run that follows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import col, label_columns, numeric_columns, temporal_columns
from ..operators import models, selection, stats

METRICS = ("predictability_r2", "mutual_info", "target_corr", "shap")
DECISIONS = "column string, kept boolean, stage int, stage_name string, reason string, " + ", ".join(f"{m} double" for m in METRICS) + ", chart_reason string"
STAGES = "stage int, name string, input_cols int, dropped int, survivors int"
SCORES = "column string, metric string, value double"
RETAINED = "column string, reason string"
NAMES = {1: "cheap_prune", 2: "correlation_cluster", 3: "pseudo_target", 4: "light_scoring", 5: "shap_scores", 6: "chart_filter"}


def run_selection(df: DataFrame, target: str | None = None, id_col: str | None = None, run_shap: bool = True,
                  trees: int = 100) -> dict[str, DataFrame]:
    """decisions, stages, scores and retained tables of all stages in order.

    Stages 1 to 3 drop columns, but never the target; 4 and 5 score and 6 marks
    what is left. A decision has the scores and the mark of its column.

    Stage 5 fits trees on rows told apart by ``id_col`` and only scores; with a
    target and two numeric features it must have that column, unless
    ``run_shap`` is off. A row without an id is told apart by its features.

    Every stage is cheaper than the next and sees only the survivors, so the
    scans of later stages read fewer columns.
    """
    spark = df.sparkSession
    dropped: dict[str, tuple] = {}
    stages, scores = [], []
    alive = list(df.columns)

    def close(stage: int, rows) -> None:
        nonlocal alive
        before = len(alive)
        for r in rows:
            if not r["kept"]:
                dropped[r["column"]] = (stage, r["reason"] if "reason" in r else None)
        alive = [c for c in alive if c not in dropped]
        stages.append((stage, NAMES[stage], before, before - len(alive), len(alive)))

    close(1, selection.stage1(df, target).collect())
    close(2, selection.stage2(df, alive, target=target).collect())
    third = selection.stage3(df, alive, target).collect()
    scores += [(r["column"], "predictability_r2", r["predictability_r2"]) for r in third if r["predictability_r2"] is not None]
    close(3, third)
    if target and target in alive:
        fourth = selection.stage4(df, alive, target).collect()
        for r in fourth:
            scores += [(r["column"], "mutual_info", r["mutual_info"]), (r["column"], "target_corr", r["target_corr"])]
        close(4, fourth)
        feats = [c for c in alive if c in numeric_columns(df) and c not in (target, id_col)]
        if run_shap and len(feats) >= 2:
            if id_col is None:
                raise ValueError("stage 5 needs id_col; set run_shap=False to leave it out")
            row = F.coalesce(col(id_col).cast("string"), F.concat_ws("|", *[col(c).cast("string") for c in feats]))
            fit = models.fit_tree(df.fillna(0, feats).withColumn("__row", row), target, feats, "__row", trees=trees)
            scores += [(r["feature"], "shap", round(r["mean_abs_shap"], 6)) for r in models.shap_importance(fit).collect()]
            close(5, [])
    charts = {r["column"]: r["reason"] for r in selection.stage6(df, alive).collect()}  # at most one row per column
    stages.append((6, NAMES[6], len(alive), 0, len(alive)))
    score = {(c, m): v for c, m, v in scores}
    rows = [(c, c not in dropped, *(dropped[c][:1] if c in dropped else (None,)), NAMES[dropped[c][0]] if c in dropped else None,
             dropped[c][1] if c in dropped else None, *[score.get((c, m)) for m in METRICS], charts.get(c)) for c in df.columns]
    return {
        "decisions": spark.createDataFrame(rows, DECISIONS), "stages": spark.createDataFrame(stages, STAGES),
        "scores": spark.createDataFrame(scores, SCORES), "retained": spark.createDataFrame(list(charts.items()), RETAINED),
    }


def run_models(df: DataFrame, target: str, features: Sequence[str], id_col: str, task: str = "auto", trees: int = 200) -> dict[str, object]:
    """Models by task: a linear model on the log target and trees for a number,
    trees with confusion matrix and curves for classes."""
    times = set(temporal_columns(df))
    usable = [c for c in features if c != target and c in df.columns and c not in times]
    nums = [c for c in usable if c in numeric_columns(df)]
    cats = [c for c in usable if c in label_columns(df)]
    task = models.infer_task(df, target).first()["task"] if task == "auto" else task
    out: dict[str, object] = {"task": task, "features": usable}
    if task == "regress" and nums:
        coefs, fit = stats.fit_ols(df, target, nums, log_target=True)
        top = [r["feature"] for r in stats.top_coefficients(coefs, 2).collect()]
        out |= {"ols_coefficients": coefs, "ols_fit": fit, "ols_top": stats.top_coefficients(coefs, 5, signed=True),
                "partial_residuals": {f: stats.partial_residuals(df, target, nums, f, [id_col], log_target=True) for f in top}}
    tree = models.fit_tree(df, target, [*nums, *cats], id_col, task, log_target=task == "regress", trees=trees)
    out |= {"tree": tree, "tree_importance": tree.importance(), "tree_summary": tree.summary()}
    if task == "classify":
        out["confusion_matrix"] = models.confusion_matrix(tree.test, "label", "prediction")
        out |= models.tree_curves(tree)
    else:
        best = tree.importance(1).first()["feature"]
        out["shap_dependence"] = models.shap_dependence(tree, best)
        out["actual_vs_predicted"] = models.actual_vs_predicted(tree)
    return out


def result_rows(results: dict[str, object]) -> DataFrame:
    """All result tables of a run as one: (result, row as JSON text)."""
    frames = {k: v for k, v in results.items() if isinstance(v, DataFrame)}
    for k, v in results.items():
        if isinstance(v, dict):
            frames |= {f"{k}:{name}": f for name, f in v.items() if isinstance(f, DataFrame)}
    out = None
    for name, f in frames.items():
        rows = f.select(F.lit(name).alias("result"), F.to_json(F.struct("*")).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out
