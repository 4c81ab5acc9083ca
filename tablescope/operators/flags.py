"""Flag log, phase requirements and small registries folded from event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .catalog import PHASES

# Flag, phase that sets it, phases that require it.
FLAGS = [
    ("schema_vetted", "vet", ["eda"]),
    ("eda_profiled", "eda", ["clean"]),
    ("column_assessment_exists", "eda", ["clean", "engineer"]),
    ("types_parsed", "clean", ["engineer"]),
    ("missing_handled", "clean", ["engineer"]),
    ("outliers_flagged", "clean", []),
    ("candidate_features_created", "engineer", ["cluster", "select"]),
    ("cheap_prune_done", "engineer", ["cluster"]),
    ("log_target_created", "engineer", []),
    ("interaction_terms_created", "engineer", []),
    ("clusters_discovered", "cluster", []),
    ("regime_validated", "cluster", []),
    ("cluster_label_added", "cluster", []),
    ("target_identified", "select", ["report"]),
    ("features_selected", "select", ["report"]),
    ("structural_features_preserved", "select", []),
    ("ols_fitted", "report", []),
    ("tree_fitted", "report", []),
    ("report_generated", "report", []),
    ("target_declared", "human", ["cluster"]),
    ("structural_features_declared", "human", []),
]


def flag_catalog(spark) -> DataFrame:
    return spark.createDataFrame(FLAGS, "flag string, set_by string, required_for array<string>")


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)]) if values else F.array().cast("array<string>")


def current_flags(history: DataFrame) -> DataFrame:
    """Flags whose newest event per (dataset, flag) is a set."""
    newest = F.max_by(F.struct("action", "timestamp", "run_id"), F.struct("timestamp", "run_id")).alias("e")
    set_by = F.create_map(*[F.lit(x) for f, s, _ in FLAGS for x in (f, s)])
    return (
        history.groupBy("dataset_id", "flag").agg(newest).filter(F.col("e.action") == "set")
        .select("dataset_id", "flag", F.col("e.timestamp").alias("set_at"),
                F.coalesce(F.try_element_at(set_by, F.col("flag")), F.lit("unknown")).alias("set_by"), F.col("e.run_id").alias("run_id"))
    )


def _flag_sets(datasets: DataFrame, current: DataFrame) -> DataFrame:
    # A set per dataset holds at most the flags of the catalog.
    known = current.filter(F.col("flag").isin([f for f, _, _ in FLAGS]))
    sets = known.groupBy("dataset_id").agg(F.collect_set("flag").alias("have"))
    return datasets.select("dataset_id").join(sets, "dataset_id", "left").select(
        "dataset_id", F.coalesce("have", F.array().cast("array<string>")).alias("have"))


def _phase_rules() -> Column:
    rules = []
    for code, action in PHASES.items():
        required = [f for f, _, need in FLAGS if action in need]
        prior = {a for c, a in PHASES.items() if c < code}
        optional = [f for f, by, _ in FLAGS if by in prior and f not in required]
        own = [f for f, by, _ in FLAGS if by == action]
        rules.append(F.struct(F.lit(code).alias("code"), F.lit(action).alias("action"), _texts(required).alias("required"),
                              _texts(optional).alias("optional"), _texts(own).alias("own")))
    return F.array(*rules)


def check_requirements(datasets: DataFrame, current: DataFrame) -> DataFrame:
    """Per dataset and phase: missing, satisfied and optional flags."""
    d = _flag_sets(datasets, current).select("dataset_id", "have", F.explode(_phase_rules()).alias("p"))
    missing = F.array_sort(F.array_except("p.required", "have"))
    optional = F.array_sort(F.array_except("p.optional", "have"))
    return d.select(
        "dataset_id", F.col("p.code").alias("code"), F.col("p.action").alias("action"),
        missing.alias("missing"), F.array_sort(F.array_intersect("p.required", "have")).alias("satisfied"),
        optional.alias("optional_missing"), (F.size(missing) == 0).alias("can_proceed"),
        ((F.size(missing) == 0) & (F.size(optional) > 0)).alias("speedrun"),
        F.array_sort(F.array_intersect("p.own", "have")).alias("flags_set"))


def route_status(datasets: DataFrame, current: DataFrame) -> DataFrame:
    """completed / unlocked / locked per dataset and phase."""
    r = check_requirements(datasets, current)
    status = F.when(F.size("flags_set") > 0, "completed").when(F.col("can_proceed"), "unlocked").otherwise("locked")
    return r.select("dataset_id", F.concat_ws("-", "code", "action").alias("phase"), status.alias("status"), "flags_set",
                    F.col("missing").alias("missing_requirements"), "speedrun")


# Kind of evidence, verdict it needs, flag it proves.
EVIDENCE = [
    ("vet_report", "pass", "schema_vetted"),
    ("eda_run", None, "eda_profiled"),
    ("column_assessment", None, "column_assessment_exists"),
    ("clean_steps", None, "types_parsed"),
    ("clean_steps", None, "missing_handled"),
    ("engineer_steps", None, "candidate_features_created"),
    ("engineer_verdict", "sufficient", "cheap_prune_done"),
    ("cluster_labels", None, "cluster_label_added"),
    ("selection_target", None, "target_identified"),
    ("selection_keep", None, "features_selected"),
    ("notes_target", None, "target_declared"),
    ("notes_structural", None, "structural_features_declared"),
]


def backfill_flags(evidence: DataFrame, current: DataFrame) -> DataFrame:
    """Flags proved by evidence (dataset_id, kind, verdict, seen_at, run_id)
    and not set yet. The newest evidence of a kind decides."""
    newest = evidence.groupBy("dataset_id", "kind").agg(
        F.max_by(F.struct("verdict", "run_id"), F.struct("seen_at", "run_id")).alias("e"))
    rules = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).cast("string").alias("needs"), F.lit(f).alias("flag")) for k, v, f in EVIDENCE])
    hit = newest.select("dataset_id", "kind", "e.*", F.explode(rules).alias("r")).filter(
        (F.col("r.kind") == F.col("kind")) & (F.col("r.needs").isNull() | F.coalesce(F.col("r.needs") == F.col("verdict"), F.lit(False))))
    return hit.select("dataset_id", F.col("r.flag").alias("flag"), "run_id", F.lit("backfilled").alias("detail")).join(
        current.select("dataset_id", "flag"), ["dataset_id", "flag"], "left_anti")


def index_merge(stored: DataFrame, patch: DataFrame) -> DataFrame:
    """Merge (dataset_id, section, name, entry, version): a later entry wins per
    name, concerns are only ever appended."""
    both = stored.unionByName(patch)
    named = both.filter(F.col("section") != "concerns").groupBy("dataset_id", "section", "name").agg(
        F.max_by("entry", "version").alias("entry"), F.max("version").alias("version"))
    return named.unionByName(both.filter(F.col("section") == "concerns"))


def alive_objects(log: DataFrame) -> DataFrame:
    """Objects (dataset_id, name, action, at, shape) not retired last."""
    newest = log.groupBy("dataset_id", "name").agg(
        F.max_by("action", "at").alias("last"), F.max_by("shape", F.when(F.col("action") == "register", F.col("at"))).alias("shape"),
        F.max("at").alias("at"))
    return newest.filter(F.col("last") == "register").select("dataset_id", "name", "shape", "at")
