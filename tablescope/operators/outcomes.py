"""Target resolution and the final outcome of a selection per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import numeric_columns

# Name parts that mark a target.
NOTE_WORDS = ["price", "target", "label", "value", "score"]
TARGET_WORDS = ["resale_price", "target", "label"]
TARGET_PATTERN = r"(?i)(?:target|predict|y_col)\s*[:=]\s*(\S+)"


def guess_target(df: DataFrame, notes: DataFrame, notes_col: str) -> DataFrame:
    """Most likely target among the numeric columns, per row of notes."""
    cols = [c for c in numeric_columns(df)]
    low = F.lower(F.coalesce(F.col(notes_col), F.lit("")))
    mentioned = [c for c in cols if any(w in c.lower() for w in NOTE_WORDS)]
    rest = [c for c in cols if any(w in c.lower() for w in TARGET_WORDS)] or [
        c for c in cols if "price" in c.lower() and "log" not in c.lower() and "per" not in c.lower()]
    picks = [F.when(F.contains(low, F.lit(c.lower())), c) for c in mentioned] + [F.lit(rest[0] if rest else None).cast("string")]
    return notes.withColumn("target", F.coalesce(*picks))


def resolve_target(datasets: DataFrame, eda_response: DataFrame) -> DataFrame:
    """Target per dataset: explicit, then notes, then the last selection, then
    the newest EDA answer (dataset_id, llm_response). Columns used: id,
    explicit_target, human_notes, select_target."""
    noted = F.regexp_extract("human_notes", TARGET_PATTERN, 1)
    noted = F.regexp_replace(noted, "^[`\"']+|[`\"']+$", "")
    empty = lambda c: F.when(c != "", c)
    j = F.from_json("llm_response", "target string, target_col string")
    eda = eda_response.select(F.col("dataset_id").alias("id"), F.coalesce(empty(j["target_col"]), empty(j["target"])).alias("eda_target"))
    d = datasets.join(eda, "id", "left")
    has_note = F.regexp_like(F.coalesce("human_notes", F.lit("")), F.lit(TARGET_PATTERN))
    return d.select("id", F.coalesce(empty(F.col("explicit_target")), F.when(has_note, noted), empty(F.col("select_target")), "eda_target").alias("target"))


def two_track_outcome(final_keep: DataFrame, overrides: DataFrame, dropped: DataFrame) -> DataFrame:
    """Outcome per (dataset_id, column). final_keep: structural; overrides:
    position, action, reason; dropped: stage, stage_name, reason."""
    key = ["dataset_id", "column"]
    k = final_keep.groupBy(*key).agg(F.bool_or("structural").alias("structural"))
    o = overrides.filter(F.col("action").isin("restore", "drop")).groupBy(*key).agg(F.max_by(F.struct("action", "reason"), "position").alias("o"))
    d = dropped.groupBy(*key).agg(F.min_by(F.struct("stage", "stage_name", "reason"), "stage").alias("d"))
    j = k.join(o, key, "full_outer").join(d, key, "full_outer")
    action = F.col("o.action")
    # The outcome strings.
    stage = F.concat(F.lit("dropped — S"), F.coalesce(F.col("d.stage").cast("string"), F.lit("?")),
                     F.lit(" "), F.coalesce("d.stage_name", F.lit("")))
    kept = F.when(F.col("structural"), "kept — Track B (structural)").when(~F.col("structural"), "kept — Track A (predictive)")
    outcome = (
        F.when(action == "restore", "kept — LLM override (restore)").when(action == "drop", "dropped — LLM override")
        .when(kept.isNotNull(), kept).when(F.col("d").isNotNull(), F.trim(stage)))
    reason = F.when(action.isNotNull(), F.col("o.reason")).when(kept.isNull(), F.col("d.reason"))
    return j.select(*key, outcome.alias("selection_outcome"), reason.alias("selection_reason"))
