"""Analytics on the dataset catalog and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import col, numeric_columns, one, rnd, share, temporal_columns
from ..functions.frames import group_quantiles, row_index, unpivot_numeric
from ..sources.files import MAX_DOWNLOAD_BYTES
from .profile import distinct_counts

# Phases by code, formats that are never processed, size window.
PHASES = {"00": "vet", "10": "eda", "15": "clean", "20": "engineer", "25": "cluster", "30": "select", "50": "report"}
PHASE_LABELS = {"00": "Vet", "10": "EDA", "15": "Clean", "20": "Eng", "25": "Clst", "30": "Sel", "50": "Rpt"}
SKIP_FORMATS = ["PDF", "KMZ", "ZIP", ""]
MIN_SIZE_BYTES = 5000
MAX_SIZE_BYTES = 524288000
MB = 1048576.0


def _label(codes: dict[str, str], code: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), code)


def scan_classify(scan: DataFrame, min_size: int = MIN_SIZE_BYTES, max_size: int = MAX_SIZE_BYTES) -> DataFrame:
    """status pending / skipped with a reason, per discovered file."""
    fmt, size = F.coalesce("format", F.lit("")), F.coalesce("size_bytes", F.lit(0))
    reason = (
        F.when(fmt.isin(SKIP_FORMATS), F.concat(F.lit("format="), F.when(fmt == "", "unknown").otherwise(fmt)))
        .when(size < min_size, F.concat(F.lit("too_small="), size.cast("string")))
    )
    if max_size:
        reason = reason.when(size > max_size, F.concat(F.lit("too_large="), size.cast("string")))
    out = scan.withColumn("skip_reason", reason)
    return out.withColumn("status", F.when(F.col("skip_reason").isNull() & (fmt == "CSV"), "pending").otherwise("skipped"))


def new_candidates(found: DataFrame, *known: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in none of the known tables."""
    out = found
    for k in known:
        out = out.join(k.select(key), key, "left_anti")
    return out


def page_queue(progress: DataFrame, pages: int, ceiling: int) -> DataFrame:
    """The first unscanned pages up to the ceiling."""
    every = progress.sparkSession.range(1, ceiling + 1).select(F.col("id").alias("page"))
    return every.join(progress.select("page"), "page", "left_anti").orderBy("page").limit(pages)


def _one_per_key(rows: DataFrame, key: str, order: str | None, last: bool) -> DataFrame:
    """The first or last row of each key along ``order``; ties, and rows
    without an order, are decided by the whole row."""
    whole = F.struct(*[col(c) for c in rows.columns])
    by = F.struct(col(order).alias("o"), whole.alias("r")) if order else whole
    return rows.groupBy(col(key).alias("__key")).agg((F.max_by if last else F.min_by)(whole, by).alias("__r")).select("__r.*")


def upsert_ignore(table: DataFrame, incoming: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """INSERT OR IGNORE: rows of a known key are dropped; of incoming rows with
    one key the first along ``order`` goes in."""
    fresh = _one_per_key(incoming, key, order, last=False)
    return table.unionByName(fresh.join(table.select(key), key, "left_anti").select(table.columns))


def upsert_replace(table: DataFrame, incoming: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """INSERT OR REPLACE: an incoming row takes the place of the stored one; of
    incoming rows with one key the last along ``order`` stays."""
    fresh = _one_per_key(incoming, key, order, last=True)
    return table.join(fresh.select(key), key, "left_anti").select(table.columns).unionByName(fresh.select(table.columns))


def scan_status(scan: DataFrame) -> DataFrame:
    return scan.groupBy("portal_id", "status").agg(F.count(F.lit(1)).alias("n"))


def scan_stats(scan: DataFrame) -> DataFrame:
    g = scan.groupBy("status", "format").agg(
        F.count(F.lit(1)).alias("cnt"), rnd(F.avg("size_bytes") / 1024.0 / 1024.0, 1).alias("avg_mb"))
    return g.orderBy("status", F.desc("cnt"), "format")


def next_candidate(scan: DataFrame) -> DataFrame:
    """The largest pending CSV."""
    pending = scan.filter((F.col("status") == "pending") & (F.col("format") == "CSV"))
    return pending.orderBy(F.desc("size_bytes"), "id").limit(1)


def latest_run(runs: DataFrame, action: str, fields: Sequence[str] = ("id", "verdict", "verdict_reason", "finished_at")) -> DataFrame:
    """Newest run of an action per dataset: an aggregate, combined map-side."""
    of = runs.filter(F.col("action") == action)
    pick = F.max_by(F.struct(*fields), F.struct("finished_at", "id")).alias("r")
    return of.groupBy("dataset_id").agg(pick).select("dataset_id", "r.*")


RUN_JSON = "hypothesis string, findings array<string>, target string, target_col string"


def run_chain(runs: DataFrame, action: str, one_pass: bool | None = None) -> DataFrame:
    """Runs of an action in order per dataset with hypothesis and two findings."""
    r = runs.filter(F.col("action") == action)
    r = row_index(r, ["dataset_id"], ["finished_at", "id"], "run_no", one_pass)
    j = F.from_json("llm_response", RUN_JSON)
    ok = F.try_parse_json("llm_response").isNotNull()
    short = lambda i: F.substring(F.get(j["findings"], F.lit(i)), 1, 100)
    return r.select(
        "dataset_id", "run_no", "id", "verdict", F.substring("verdict_reason", 1, 120).alias("reason"),
        F.when(ok, F.coalesce(j["hypothesis"], F.lit("?"))).otherwise("?").alias("hypothesis"),
        F.when(ok, short(0)).alias("finding_1"), F.when(ok, short(1)).alias("finding_2"))


def _timed(runs: DataFrame, datasets: DataFrame) -> DataFrame:
    seconds = F.unix_seconds(F.col("finished_at").cast("timestamp")) - F.unix_seconds(F.col("started_at").cast("timestamp"))
    done = runs.filter((F.col("status") == "done") & F.col("started_at").isNotNull() & F.col("finished_at").isNotNull())
    known = datasets.filter(F.col("row_count") > 0).select(F.col("id").alias("dataset_id"), "row_count")
    return done.join(known, "dataset_id").select("id", "action", "finished_at", "row_count", seconds.alias("duration_s"))


def phase_timing(runs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Median seconds, runs and median rows per action; medians are truncated."""
    t = _timed(runs, datasets).filter(F.col("duration_s") > 0)
    med = group_quantiles(unpivot_numeric(t, ["duration_s", "row_count"], ["action"]), ["action", "column"], "value", [0.5])
    pick = lambda c: F.max(F.when(F.col("column") == c, F.col("q")[0])).cast("bigint")
    return med.groupBy("action").agg(pick("duration_s").alias("median_s"), F.max("n").alias("sample_count"), pick("row_count").alias("median_rows"))


def phase_estimate(runs: DataFrame, datasets: DataFrame, action: str, last: int = 30) -> DataFrame:
    """Seconds an action will take per dataset, scaled from the last runs."""
    recent = _timed(runs.filter(F.col("action") == action), datasets).orderBy(F.desc("finished_at"), "id").limit(last)
    ok = recent.filter(F.col("duration_s") > 0)
    # At most ``last`` rows are ranked.
    d = F.array_sort(F.collect_list("duration_s"))
    s = one(ok, n=F.count(F.lit(1)), md=F.median("duration_s"), mr=F.median("row_count"),
            fl=F.get(d, F.floor(F.size(d) / 4).cast("int")))
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    scaled = F.when((s["mr"] == 0) | (rows == 0), s["md"]).otherwise(s["md"] * (rows / s["mr"]))
    est = F.when(s["n"] >= 2, F.greatest(scaled, s["fl"].cast("double")).cast("bigint"))
    return datasets.select("id", "row_count", est.alias("estimate_s"))


def eta_label(seconds: Column) -> Column:
    m = F.floor(seconds / 60).cast("bigint")
    text = lambda c: c.cast("bigint").cast("string")
    return (
        F.when(seconds.isNull(), "unknown")
        .when(seconds < 60, F.concat(F.lit("~"), text(seconds), F.lit("s")))
        .when(m < 60, F.concat(F.lit("~"), text(m), F.lit("m")))
        .otherwise(F.concat(F.lit("~"), text(F.floor(m / 60)), F.lit("h "), text(m % 60), F.lit("m")))
    )


def phase_label(code: Column, rejected: Column) -> Column:
    return (
        F.when(rejected != 0, "rejected").when(code.isNull() | (code == ""), "queued")
        .otherwise(F.coalesce(_label(PHASE_LABELS, code), code))
    )


def dataset_overview(datasets: DataFrame, runs: DataFrame) -> DataFrame:
    """Datasets with run count, phase label and progress (1 = phase reached)."""
    n = runs.groupBy(F.col("dataset_id").alias("id")).agg(F.count(F.lit(1)).alias("run_count"))
    code = F.col("max_action_code")
    bar = F.concat(*[F.when(F.coalesce(F.lit(p) <= code, F.lit(False)), "1").otherwise("0") for p in PHASES])
    return datasets.join(n, "id", "left").select(
        "id", "title", "pipeline_type", "max_action_code", "rejected", "row_count",
        F.coalesce("run_count", F.lit(0)).cast("bigint").alias("run_count"),
        phase_label(code, F.col("rejected")).alias("phase_label"),
        F.when(F.col("rejected") != 0, "rejected").otherwise(bar).alias("progress"))


def overview_metrics(datasets: DataFrame) -> DataFrame:
    live, code = F.col("rejected") == 0, F.coalesce("max_action_code", F.lit(""))
    return datasets.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(live & (code == "00")).alias("at_vet"),
        F.count_if(live & (code > "00")).alias("active"), F.count_if(code == "50").alias("complete"),
        F.count_if(~live).alias("rejected"))


def overview_page(overview: DataFrame, page: int = 1, size: int = 25, types: Sequence[str] = (), phases: Sequence[str] = (),
                  status: str | None = None, search: str = "") -> DataFrame:
    d, code, live = overview, F.coalesce("max_action_code", F.lit("")), F.col("rejected") == 0
    if types:
        d = d.filter(F.col("pipeline_type").isin(*types))
    if phases:
        d = d.filter(F.col("phase_label").isin(*phases))
    wanted = {"Active": live & (code > "00") & (code != "50"), "Complete": code == "50",
              "Rejected": ~live, "At vet": live & (code == "00")}
    if status:
        d = d.filter(wanted[status])
    if search:
        q = search.lower()
        d = d.filter(F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit(q)) | F.contains(F.lower("id"), F.lit(q)))
    return d.orderBy(F.desc("row_count"), "id").offset((page - 1) * size).limit(size)


def stale_datasets(datasets: DataFrame, runs: DataFrame, cutoff: str) -> DataFrame:
    """Unfinished datasets without a run since the cutoff."""
    last = runs.groupBy(F.col("dataset_id").alias("id")).agg(F.max("finished_at").alias("last_run"))
    live = datasets.filter((F.col("rejected") == 0) & F.col("max_action_code").isNotNull() & (F.col("max_action_code") != "50"))
    return live.join(last, "id", "left").filter(
        F.col("last_run").isNull() | (F.col("last_run") < F.lit(cutoff).cast("timestamp_ntz"))
    ).select("id", F.coalesce("title", "id").alias("title"), "max_action_code", "last_run")


def rejected_collectable(datasets: DataFrame, runs: DataFrame) -> DataFrame:
    """Rejected datasets at code 00: collect when a vet run is on record."""
    vets = runs.filter(F.col("action") == "vet").groupBy(F.col("dataset_id").alias("id")).agg(F.count(F.lit(1)).alias("run_count"))
    d = datasets.filter((F.col("rejected") == 1) & (F.coalesce("max_action_code", F.lit("00")) == "00"))
    n = F.coalesce("run_count", F.lit(0)).cast("bigint")
    return d.join(vets, "id", "left").select(
        "id", "title", n.alias("run_count"), F.when(n == 0, "skip_no_db_record").otherwise("collect").alias("action"))


def orphan_files(files: DataFrame, *known: DataFrame) -> DataFrame:
    """Files (id, path, size_bytes) of no known dataset, with their size in MB."""
    return new_candidates(files, *known).select("id", "path", rnd(F.col("size_bytes") / MB, 3).alias("size_mb"))


def graduated_datasets(datasets: DataFrame) -> DataFrame:
    c = F.col("cron_actions")
    return datasets.filter(c.isNotNull() & ~c.isin("", "[]")).select("id", "title", "cron_actions")


def cleanup_summary(actions: DataFrame) -> DataFrame:
    """Actions (policy, size_mb) to MB and count per policy."""
    return actions.groupBy("policy").agg(F.count(F.lit(1)).alias("actions"), rnd(F.sum("size_mb"), 3).alias("mb"))


def apply_verdicts(datasets: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Gate transitions from (dataset_id, action, verdict, verdict_reason), one
    per dataset: vet fail and eda reject close it, eda promote raises it to 20."""
    v = verdicts.select(F.col("dataset_id").alias("id"), F.col("action").alias("__a"), F.col("verdict").alias("__v"), F.col("verdict_reason").alias("__r"))
    j = datasets.join(v, "id", "left")
    closed = F.coalesce(((F.col("__a") == "vet") & (F.col("__v") == "fail")) | ((F.col("__a") == "eda") & (F.col("__v") == "reject")), F.lit(False))
    raised = F.coalesce((F.col("__a") == "eda") & (F.col("__v") == "promote"), F.lit(False))
    code = F.col("max_action_code")
    return j.select(
        "id", F.when(closed, 1).otherwise(F.col("rejected")).alias("rejected"),
        F.when(closed, F.col("__a")).alias("rejected_at_action"), F.when(closed, F.col("__r")).alias("reject_reason"),
        F.when(raised, F.greatest(F.coalesce(code, F.lit("")), F.lit("20"))).otherwise(code).alias("max_action_code"))


def size_gate(scan: DataFrame, limit: int = MAX_DOWNLOAD_BYTES) -> DataFrame:
    over = F.coalesce(F.col("size_bytes") > limit, F.lit(False))
    text = F.concat(F.lit("too_large: "), F.format_string("%.0f", F.col("size_bytes") / F.lit(MB)), F.lit(" MB in catalog"))
    return scan.select("id", "size_bytes", F.when(over, "skip").otherwise("continue").alias("verdict"), F.when(over, text).alias("reason"))


def column_glossary(metadata: DataFrame, clean_log: DataFrame, feature_log: DataFrame, outcome: DataFrame) -> DataFrame:
    """Origin and making of every column, with its selection outcome.

    All inputs carry (dataset_id, column). metadata: title, data_type.
    clean_log: position, description. feature_log: position, step_name,
    description. outcome: the table of ``two_track_outcome``.
    """
    key = ["dataset_id", "column"]
    meta = metadata.select(*key, F.col("title"), F.concat(F.coalesce("data_type", F.lit("?")), F.lit(" field from source data")).alias("m_how"), F.lit(True).alias("in_meta"))
    clean = clean_log.groupBy(*key).agg(
        F.max_by("description", "position").alias("c_last"), F.min_by("description", "position").alias("c_first"),
        F.count(F.lit(1)).alias("c_n"))
    feat = feature_log.groupBy(*key).agg(F.min_by(F.struct("step_name", "description"), "position").alias("f"))
    j = meta.join(clean, key, "full_outer").join(feat, key, "full_outer").join(outcome, key, "left")
    original, cleaned = F.col("in_meta").isNotNull(), F.col("c_n").isNotNull()
    label = F.trim(F.regexp_replace(F.regexp_replace("f.step_name", "^step_?", ""), r"[_\d]+", " "))
    made = F.concat(label, F.lit(": "), F.substring("f.description", 1, 120))
    return j.select(
        *key,
        F.when(original, "original").when(cleaned, "clean").otherwise("engineered").alias("origin"),
        F.when(cleaned & (original | (F.col("c_n") > 1)), F.concat(F.lit("Cleaned: "), F.col("c_last")))
        .when(original, F.col("m_how")).when(cleaned, F.col("c_first")).otherwise(made).alias("how"),
        F.when(original, F.coalesce("title", "column")).when(cleaned, "").otherwise(F.substring("f.description", 1, 200)).alias("intuition"),
        "selection_outcome", "selection_reason")


def step_log_summary(log: DataFrame, by: Sequence[str], position: str, steps: int = 15) -> DataFrame:
    """The first steps per dataset, texts cut to their display length."""
    w = Window.partitionBy(*by).orderBy(position)
    # Only ``steps`` rows per dataset leave each task.
    first = log.withColumn("step_no", F.row_number().over(w)).filter(F.col("step_no") <= steps)
    return first.select(*by, "step_no", "step_name", F.substring("description", 1, 100).alias("description"),
                        F.substring("result", 1, 60).alias("result"), F.substring("reason", 1, 80).alias("reason"))


def join_key_overlap(left: DataFrame, right: DataFrame, strip: str = r"^[a-z]+_") -> DataFrame:
    """Columns of like name and type with the share of left values found right."""
    import re

    base = lambda c: re.sub(strip, "", c)
    pairs = [(a, b) for a in left.columns for b in right.columns
             if base(a) == base(b) and left.schema[a].dataType.typeName()[:3] == right.schema[b].dataType.typeName()[:3]]
    schema = "left_col string, right_col string, left_distinct bigint, matched bigint, overlap double"
    out = left.sparkSession.createDataFrame([], schema)
    for a, b in pairs:
        l = left.filter(col(a).isNotNull()).select(col(a).cast("string").alias("v")).distinct()
        r = right.filter(col(b).isNotNull()).select(col(b).cast("string").alias("v")).distinct().withColumn("hit", F.lit(1))
        got = l.join(r, "v", "left").agg(F.count(F.lit(1)).alias("left_distinct"), F.count("hit").alias("matched"))
        out = out.union(got.select(F.lit(a), F.lit(b), "left_distinct", "matched", share(F.col("matched"), F.col("left_distinct"), 6)))
    return out


def approved_keys(proposals: DataFrame) -> DataFrame:
    """Approved proposals with their key list read from the JSON array."""
    return proposals.filter(F.col("status") == "approved").select("id", F.from_json("join_keys", "array<string>").alias("keys"))


def enrichment_join(base: DataFrame, side: DataFrame, keys: Sequence[str], measures: dict[str, Column] | None = None) -> DataFrame:
    """Left join that cannot multiply rows. With ``measures`` ({name: aggregate})
    the side is brought to one row per key by them; without, its keys must be
    unique already, and repeated ones are an error that names how many."""
    if measures:
        side = side.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    else:
        twice = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").count()
        if twice:
            raise ValueError(f"{twice} keys of the side table occur more than once; give measures that combine their rows")
    return base.join(side, list(keys), "left")


def dataset_route(name: str, df: DataFrame, small: int = 500) -> DataFrame:
    """transactional, aggregate or reference from rows, types and uniqueness:
    reference tables are small maps from a unique key to text without a time."""
    nums = numeric_columns(df)
    d = distinct_counts(df, df.columns)
    s = d.agg(F.max("row_count").alias("row_count"), F.max(F.try_divide(F.col("unique_count") * 1.0, F.col("row_count") * 1.0)).alias("u"))
    text_share = 1.0 - len(nums) / max(len(df.columns), 1)
    lookup = (F.col("row_count") < small) & (F.col("u") == 1.0) & F.lit(text_share > 0.3 and not temporal_columns(df) and len(nums) <= 2)
    kind = F.when(lookup, "reference").when(F.col("row_count") < small, "aggregate").otherwise("transactional")
    route = F.when(F.col("kind") == "transactional", " ".join(PHASES)).when(F.col("kind") == "aggregate", "00 10 join").otherwise("00 join")
    return s.select(F.lit(name).alias("name"), "row_count", rnd(F.col("u"), 6).alias("max_unique_ratio"), kind.alias("kind")).withColumn("route", route)
