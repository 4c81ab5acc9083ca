"""Catalog, run log, flag and JSON queries."""

from pyspark.sql import functions as F

from tablescope.functions.exprs import rnd
from tablescope.operators import catalog as D, flags as W, jsonfields as J, outcomes as O

from .clean_q import r6
from .core import FIX, query

SC = ("scan_catalog",)
DS, RN = ("datasets",), ("runs",)
BOTH = ("datasets", "runs")

CLASSIFY = """c as (select *, case when format in ('PDF', 'KMZ', 'ZIP', '') then 'format=' || case when format = '' then 'unknown' else format end
  when size_bytes < 5000 then 'too_small=' || cast(size_bytes as varchar) when size_bytes > 524288000 then 'too_large=' || cast(size_bytes as varchar) end as skip_reason
  from scan_catalog), s as (select *, case when skip_reason is null and format = 'CSV' then 'pending' else 'skipped' end as status from c)"""


@query("scan_classify", f"with {CLASSIFY} select * from s", SC)
def _(t):
    return D.scan_classify(t.scan_catalog)


# Known ids: documents that carry a label, and those of one language.
@query("new_candidates", """select id, format from scan_catalog where id not in (select 's' || cast(doc_id as varchar) from labels)
 and id not in (select 's' || cast(doc_id as varchar) from documents where lang = 'en')""", SC)
def _(t):
    labelled = t.labels.select(F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("id"))
    english = t.documents.filter("lang = 'en'").select(F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("id"))
    return D.new_candidates(t.scan_catalog, labelled, english).select("id", "format")


@query("page_queue", """with done as (select distinct page from scan_catalog where format = 'GEOJSON' or format = 'ZIP')
 select page from (select unnest(generate_series(1::bigint, 600)) as page) where page not in (select page from done) order by page limit 20""", SC)
def _(t):
    done = t.scan_catalog.filter("format in ('GEOJSON', 'ZIP')").select("page").distinct()
    return D.page_queue(done, 20, 600)


UPS = """a as (select id, format, size_bytes from scan_catalog where format <> 'PDF'),
 c as (select id, 'NEW' as format, size_bytes * 2 as size_bytes from scan_catalog where format <> 'CSV'
   union all select id, 'TWICE', size_bytes * 3 from scan_catalog where format <> 'CSV' and page % 3 = 0
   union all select 'x' || cast(page as varchar), 'KEY', size_bytes from scan_catalog)"""


def ups(t):
    s = t.scan_catalog.select("id", "format", "size_bytes")
    new = s.filter("format <> 'CSV'").select("id", F.lit("NEW").alias("format"), (F.col("size_bytes") * 2).alias("size_bytes"))
    # Keys that come twice, and new keys that come for every row of a page.
    again = t.scan_catalog.filter("format <> 'CSV' and page % 3 = 0").select("id", F.lit("TWICE").alias("format"), (F.col("size_bytes") * 3).alias("size_bytes"))
    pages = t.scan_catalog.select(F.concat(F.lit("x"), F.col("page").cast("string")).alias("id"), F.lit("KEY").alias("format"), "size_bytes")
    return s.filter("format <> 'PDF'"), new.union(again).union(pages)


def one_of(last):
    way = "desc" if last else "asc"
    return f"b as (select id, format, size_bytes from c qualify row_number() over (partition by id order by size_bytes {way}, format {way}) = 1)"


@query("upsert_ignore", f"with {UPS}, {one_of(False)} select * from a union all select * from b where id not in (select id from a)", SC)
def _(t):
    return D.upsert_ignore(*ups(t), "id", "size_bytes")


@query("upsert_replace", f"with {UPS}, {one_of(True)} select * from b union all select * from a where id not in (select id from b)", SC)
def _(t):
    return D.upsert_replace(*ups(t), "id", "size_bytes")


@query("scan_status", f"with {CLASSIFY} select portal_id, status, count(*) as n from s group by 1, 2", SC)
def _(t):
    return D.scan_status(D.scan_classify(t.scan_catalog))


@query("scan_stats", f"with {CLASSIFY} select status, format, count(*) as cnt, round_even(avg(size_bytes) / 1024.0 / 1024.0, 1) as avg_mb from s group by 1, 2", SC)
def _(t):
    return D.scan_stats(D.scan_classify(t.scan_catalog))


@query("next_candidate", f"with {CLASSIFY} select id, name, size_bytes from s where status = 'pending' order by size_bytes desc, id limit 1", SC)
def _(t):
    return D.next_candidate(D.scan_classify(t.scan_catalog)).select("id", "name", "size_bytes")


LATEST = """select dataset_id, id, verdict, verdict_reason, finished_at from runs where action = '{a}'
 qualify row_number() over (partition by dataset_id order by finished_at desc, id desc) = 1"""


@query("latest_run", LATEST.replace("{a}", "vet"), RN)
def _(t):
    return D.latest_run(t.runs, "vet")


@query("run_chain", """with r as (select *, row_number() over (partition by dataset_id order by finished_at, id) as run_no, json_valid(llm_response) as ok from runs where action = 'engineer')
 select dataset_id, run_no, id, verdict, substr(verdict_reason, 1, 120) as reason, case when ok then llm_response->>'hypothesis' else '?' end as hypothesis,
  case when ok then substr(llm_response->'findings'->>0, 1, 100) end as finding_1, case when ok then substr(llm_response->'findings'->>1, 1, 100) end as finding_2 from r""", RN)
def _(t):
    return D.run_chain(t.runs, "engineer")


TIMED = """t as (select r.id, r.action, r.finished_at, d.row_count, cast(epoch(r.finished_at) - epoch(r.started_at) as bigint) as s
  from runs r join datasets d on d.id = r.dataset_id where r.status = 'done' and d.row_count > 0)"""


@query("phase_timing", f"""with {TIMED} select action, cast(trunc(median(s)) as bigint) as median_s, count(*) as sample_count,
 cast(trunc(median(row_count)) as bigint) as median_rows from t where s > 0 group by 1""", BOTH)
def _(t):
    return D.phase_timing(t.runs, t.datasets)


EST = f"""with {TIMED}, l as (select * from t where action = 'eda' order by finished_at desc, id limit 30),
 m as (select median(s) as md, median(row_count) as mr, list_sort(list(s))[cast(floor(count(*) / 4) as int) + 1] as fl, count(*) as n from l where s > 0),
 e as (select d.id, d.row_count, case when n >= 2 then cast(trunc(greatest(case when mr = 0 or d.row_count = 0 then md else md * (d.row_count / cast(mr as double)) end, fl)) as bigint) end as estimate_s from datasets d, m)"""


@query("phase_estimate", EST + " select * from e", BOTH)
def _(t):
    return D.phase_estimate(t.runs, t.datasets, "eda")


@query("eta_label", EST + """, x as (select id, case when row_count > 4900 then null else estimate_s * (row_count // 100 + 1) end as s from e)
 select id, case when s is null then 'unknown' when s < 60 then '~' || s || 's' when s // 60 < 60 then '~' || s // 60 || 'm'
  else '~' || s // 3600 || 'h ' || (s // 60) % 60 || 'm' end as eta from x""", BOTH)
def _(t):
    e = D.phase_estimate(t.runs, t.datasets, "eda")
    s = F.when(F.col("row_count") <= 4900, F.col("estimate_s") * (F.floor(F.col("row_count") / 100) + 1))
    return e.select("id", D.eta_label(s).alias("eta"))


OVER = """n as (select dataset_id, count(*) as run_count from runs group by 1),
 o as (select d.id, title, pipeline_type, max_action_code, rejected, row_count, coalesce(run_count, 0) as run_count,
  case when rejected <> 0 then 'rejected' when max_action_code is null then 'queued' else case max_action_code when '00' then 'Vet' when '10' then 'EDA'
   when '15' then 'Clean' when '20' then 'Eng' when '25' then 'Clst' when '30' then 'Sel' else 'Rpt' end end as phase_label,
  case when rejected <> 0 then 'rejected' else array_to_string(list_transform(['00', '10', '15', '20', '25', '30', '50'], lambda p: case when p <= max_action_code then '1' else '0' end), '') end as progress
  from datasets d left join n on n.dataset_id = d.id)"""


@query("dataset_overview", f"with {OVER} select * from o", BOTH)
def _(t):
    return D.dataset_overview(t.datasets, t.runs)


@query("overview_metrics", """select count(*) as total, count(*) filter (where rejected = 0 and max_action_code = '00') as at_vet,
 count(*) filter (where rejected = 0 and max_action_code > '00') as active, count(*) filter (where max_action_code = '50') as complete,
 count(*) filter (where rejected = 1) as rejected from datasets""", DS)
def _(t):
    return D.overview_metrics(t.datasets)


@query("overview_page", f"""with {OVER} select * from o where pipeline_type in ('transactional', 'aggregate') and rejected = 0 and max_action_code > '00' and max_action_code <> '50'
 and (contains(lower(title), '00') or contains(lower(id), '00')) order by row_count desc, id limit 25 offset 25""", BOTH)
def _(t):
    return D.overview_page(D.dataset_overview(t.datasets, t.runs), page=2, types=["transactional", "aggregate"], status="Active", search="00")


@query("stale_datasets", """select d.id, title, max_action_code, max(r.finished_at) as last_run from datasets d left join runs r on r.dataset_id = d.id
 where rejected = 0 and max_action_code is not null and max_action_code <> '50' group by 1, 2, 3
 having max(r.finished_at) is null or max(r.finished_at) < timestamp '2001-11-01'""", BOTH)
def _(t):
    return D.stale_datasets(t.datasets, t.runs, "2001-11-01")


@query("rejected_collectable", """select d.id, title, count(r.id) as run_count, case when count(r.id) = 0 then 'skip_no_db_record' else 'collect' end as action
 from datasets d left join runs r on r.dataset_id = d.id and r.action = 'vet' where rejected = 1 and (max_action_code = '00' or max_action_code is null) group by 1, 2""", BOTH)
def _(t):
    return D.rejected_collectable(t.datasets, t.runs)


@query("orphan_files", """select 'r' || cast(page_id as varchar) as id, url as path, round_even(length(html) / 1048576.0, 3) as size_mb from pages
 where 'r' || cast(page_id as varchar) not in (select id from runs where action = 'vet') and page_id not in (select doc_id from labels)""", RN)
def _(t):
    files = t.pages.select(F.concat(F.lit("r"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("path"), F.length("html").alias("size_bytes"))
    known = t.labels.select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("id"))
    return D.orphan_files(files, t.runs.filter("action = 'vet'"), known)


@query("graduated_datasets", "select id, title, cron_actions from datasets where cron_actions is not null and cron_actions not in ('', '[]')", DS)
def _(t):
    return D.graduated_datasets(t.datasets)


@query("cleanup_summary", """with a as (select case when rejected = 1 then 'rejected' when cron_actions = '["refresh"]' then 'archived' else 'orphan_data' end as policy, row_count / 64.0 as size_mb from datasets)
 select policy, count(*) as actions, round_even(sum(size_mb), 3) as mb from a group by 1""", DS)
def _(t):
    a = t.datasets.select(F.when(F.col("rejected") == 1, "rejected").when(F.col("cron_actions") == '["refresh"]', "archived").otherwise("orphan_data").alias("policy"),
                          (F.col("row_count") / 64.0).alias("size_mb"))
    return D.cleanup_summary(a)


@query("apply_verdicts", """with v as (select * from runs qualify row_number() over (partition by dataset_id order by finished_at desc, id desc) = 1),
 j as (select d.id, d.rejected, d.max_action_code as code, v.action as a, v.verdict as v, v.verdict_reason as r from datasets d left join v on v.dataset_id = d.id),
 k as (select *, coalesce((a = 'vet' and v = 'fail') or (a = 'eda' and v = 'reject'), false) as closed from j)
 select id, case when closed then 1 else rejected end as rejected, case when closed then a end as rejected_at_action, case when closed then r end as reject_reason,
  case when a = 'eda' and v = 'promote' and (code is null or code < '20') then '20' else code end as max_action_code from k""", BOTH)
def _(t):
    newest = t.runs.groupBy("dataset_id").agg(F.max_by(F.struct("action", "verdict", "verdict_reason"), F.struct("finished_at", "id")).alias("r")).select("dataset_id", "r.*")
    return D.apply_verdicts(t.datasets, newest)


@query("size_gate", """select id, size_bytes * 100 as size_bytes, case when size_bytes * 100 > 524288000 then 'skip' else 'continue' end as verdict,
 case when size_bytes * 100 > 524288000 then 'too_large: ' || format('{:.0f}', size_bytes * 100 / 1048576.0) || ' MB in catalog' end as reason from scan_catalog""", SC)
def _(t):
    return D.size_gate(t.scan_catalog.withColumn("size_bytes", F.col("size_bytes") * 100))


# Column metadata, step logs and selections of all customers' datasets, read
# from their orders: the priority says which log an order belongs to.
FIX["g_base"] = """select o_custkey as dataset_id, concat('col_', cast(o_orderkey % 5 as string)) as "column", o_orderkey as position,
  o_orderpriority as p, o_orderstatus as s from {orders}"""
FIX["g_base"] = (FIX["g_base"].replace('"column"', "`column`"), FIX["g_base"])

KEEP = """keep as (select dataset_id, "column", bool_or(s = 'F') as structural from g_base where p = '4-NOT SPECIFIED' group by 1, 2),
 ov as (select dataset_id, "column", case when s = 'F' then 'restore' else 'drop' end as action, 'because ' || cast(position as varchar) as reason from g_base
   where p = '5-LOW' and s <> 'P' qualify row_number() over (partition by dataset_id, "column" order by position desc) = 1),
 dr as (select dataset_id, "column", cast(position % 3 + 1 as int) as stage, 'why ' || cast(position as varchar) as reason, position from g_base
   where p = '1-URGENT' qualify row_number() over (partition by dataset_id, "column" order by position % 3) = 1),
 outc as (select dataset_id, "column", case when ov.action = 'restore' then 'kept — LLM override (restore)' when ov.action = 'drop' then 'dropped — LLM override'
   when structural then 'kept — Track B (structural)' when not structural then 'kept — Track A (predictive)'
   else 'dropped — S' || cast(stage as varchar) || ' prune' end as selection_outcome,
   case when ov.action is not null then ov.reason when structural is null then dr.reason end as selection_reason
   from keep full join ov using (dataset_id, "column") full join dr using (dataset_id, "column"))"""


def outcome(t):
    g = t.g_base
    keep = g.filter("p = '4-NOT SPECIFIED'").select("dataset_id", "column", (F.col("s") == "F").alias("structural"))
    ov = g.filter("p = '5-LOW'").select("dataset_id", "column", "position",
        F.when(F.col("s") == "F", "restore").when(F.col("s") == "O", "drop").otherwise("note").alias("action"),
        F.concat(F.lit("because "), F.col("position").cast("string")).alias("reason"))
    dr = g.filter("p = '1-URGENT'").select("dataset_id", "column", (F.col("position") % 3 + 1).cast("int").alias("stage"),
        F.lit("prune").alias("stage_name"), F.concat(F.lit("why "), F.col("position").cast("string")).alias("reason"))
    # One dropped entry per stage and column, as a selection run writes them.
    dr = dr.groupBy("dataset_id", "column", "stage", "stage_name").agg(F.min("reason").alias("reason"))
    return O.two_track_outcome(keep, ov, dr)


OUTQ = KEEP.replace("""order by position % 3) = 1""", """order by position % 3, 'why ' || cast(position as varchar)) = 1""")


@query("two_track_outcome", f"with {OUTQ} select * from outc", ("g_base",))
def _(t):
    return outcome(t)


@query("column_glossary", f"""with {OUTQ},
 meta as (select distinct dataset_id, "column", 'Title ' || "column" as title from g_base where p in ('1-URGENT', '2-HIGH')),
 cl as (select dataset_id, "column", arg_max('clean ' || cast(position as varchar), position) as last, arg_min('clean ' || cast(position as varchar), position) as first, count(*) as n
   from g_base where p = '3-MEDIUM' group by 1, 2),
 fe as (select dataset_id, "column", arg_min('adds ' || cast(position as varchar), position) as d from g_base where p = '4-NOT SPECIFIED' group by 1, 2)
 select dataset_id, "column", case when title is not null then 'original' when n is not null then 'clean' else 'engineered' end as origin,
  case when n is not null and (title is not null or n > 1) then 'Cleaned: ' || last when title is not null then 'Text field from source data' when n is not null then first
   else 'make ratio: ' || d end as how,
  case when title is not null then title when n is not null then '' else d end as intuition, selection_outcome, selection_reason
 from meta full join cl using (dataset_id, "column") full join fe using (dataset_id, "column") left join outc using (dataset_id, "column")""", ("g_base",))
def _(t):
    g = t.g_base
    meta = g.filter("p in ('1-URGENT', '2-HIGH')").select("dataset_id", "column").distinct().select(
        "*", F.concat(F.lit("Title "), F.col("column")).alias("title"), F.lit("Text").alias("data_type"))
    log = lambda p, word: g.filter(F.col("p") == p).select("dataset_id", "column", "position", F.lit("step_03_make_ratio").alias("step_name"),
        F.concat(F.lit(word), F.col("position").cast("string")).alias("description"))
    return D.column_glossary(meta, log("3-MEDIUM", "clean "), log("4-NOT SPECIFIED", "adds "), outcome(t))


@query("step_log_summary", """select conv_id, row_number() over (partition by conv_id order by turn) as step_no, role as step_name, substr(text, 1, 100) as description,
 substr(text, 1, 60) as result, substr(text, 1, 80) as reason from conversations qualify step_no <= 15""")
def _(t):
    log = t.conversations.select("conv_id", "turn", F.col("role").alias("step_name"), F.col("text").alias("description"), F.col("text").alias("result"), F.col("text").alias("reason"))
    return D.step_log_summary(log, ["conv_id"], "turn").withColumn("step_no", F.col("step_no").cast("bigint"))


def overlap(a, b, ta, tb):
    return f"""select '{a}' as left_col, '{b}' as right_col, count(*) as left_distinct, count(r.v) as matched, round_even(count(r.v) / cast(count(*) as double), 6) as overlap
     from (select distinct {a} as v from {ta} where {a} is not null) l left join (select distinct {b} as v from {tb}) r on l.v = r.v"""


@query("join_key_overlap", overlap("l_partkey", "p_partkey", "lineitem", "part"))
def _(t):
    return D.join_key_overlap(t.lineitem, t.part)


@query("enrichment_join", """with s as (select s_nationkey, count(*) as n_suppliers, round_even(avg(s_acctbal), 2) as side_balance from supplier group by 1),
 p as (select p_partkey, p_brand, p_size from part)
 select l_orderkey, l_linenumber, n_nationkey as nationkey, p_brand, p_size, n_suppliers, side_balance
 from lineitem left join (select s_suppkey, s_nationkey as n_nationkey from supplier) on s_suppkey = l_suppkey
 left join s on s_nationkey = n_nationkey left join p on p_partkey = l_partkey""")
def _(t):
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nationkey"))
    base = D.enrichment_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), nations, ["l_suppkey"])
    side = t.supplier.select(F.col("s_nationkey").alias("nationkey"), "s_acctbal")
    proposals = t.spark.createDataFrame([("j1", '["nationkey"]', "approved"), ("j2", '["c_custkey"]', "rejected")], "id string, join_keys string, status string")
    keys = D.approved_keys(proposals).first()["keys"]
    wide = D.enrichment_join(base, side, keys, {"n_suppliers": F.count(F.lit(1)), "side_balance": rnd(F.avg("s_acctbal"), 2)})
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    return D.enrichment_join(wide, parts, ["l_partkey"]).select("l_orderkey", "l_linenumber", "nationkey", "p_brand", "p_size", "n_suppliers", "side_balance")


def route_sql(name, cols, lookup):
    u = ", ".join(f"count(distinct {c}) / cast(count(*) as double)" for c in cols)
    return f"""select '{name}' as name, count(*) as row_count, round_even(greatest({u}), 6) as max_unique_ratio,
     case when count(*) < 500 and greatest({u}) = 1 and {lookup} then 'reference' when count(*) < 500 then 'aggregate' else 'transactional' end as kind from {name}"""


@query("dataset_route", "with k as (" + " union all ".join([
    route_sql("nation", ["n_nationkey", "n_name", "n_regionkey"], "true"), route_sql("region", ["r_regionkey", "r_name"], "true"),
    route_sql("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], "false"), route_sql("orders", ["o_orderkey"], "false"),
    route_sql("labels", ["doc_id", "quality", "toxic"], "false")]) + """) select *, case kind when 'transactional' then '00 10 15 20 25 30 50' when 'aggregate' then '00 10 join' else '00 join' end as route from k""")
def _(t):
    out = None
    for n in ("nation", "region", "supplier", "orders", "labels"):
        r = D.dataset_route(n, getattr(t, n))
        out = r if out is None else out.union(r)
    return out


# Targets

@query("guess_target", """select id, case when contains(lower(human_notes), 'l_extendedprice') then 'l_extendedprice' else 'l_extendedprice' end as target from datasets""", DS)
def _(t):
    return O.guess_target(t.lineitem, t.datasets, "human_notes").select("id", "target")


@query("resolve_target", """with e as (select dataset_id, case when json_valid(llm_response) then llm_response->>'target' end as et from runs where action = 'eda'
  qualify row_number() over (partition by dataset_id order by finished_at desc, id desc) = 1)
 select id, coalesce(case when rejected = 1 then 'given' end, nullif(trim(regexp_extract(human_notes, '(target|predict|y_col)\\s*[:=]\\s*(\\S+)', 2, 'i'), '`'), ''), select_target, et) as target
 from datasets d left join e on e.dataset_id = d.id""", BOTH)
def _(t):
    d = t.datasets.withColumn("explicit_target", F.when(F.col("rejected") == 1, "given"))
    return O.resolve_target(d, D.latest_run(t.runs, "eda", ["id", "llm_response"]))


# Flags

FIX["flag_history"] = (
    """select user_id as dataset_id, element_at(array({f}), cast(event_id % 21 as int) + 1) as flag, case when event_type = 'error' then 'unset' else 'set' end as action,
     ts as timestamp, event_id as run_id from {events}""".replace("{f}", ", ".join(f"'{f}'" for f, _, _ in W.FLAGS)),
    """select user_id as dataset_id, [{f}][event_id % 21 + 1] as flag, case when event_type = 'error' then 'unset' else 'set' end as action,
     ts as timestamp, event_id as run_id from {events}""".replace("{f}", ", ".join(f"'{f}'" for f, _, _ in W.FLAGS)))
FIX["flag_list"] = " union all ".join(
    f"select '{f}' as flag, '{b}' as set_by, ',{','.join(n)},' as req" for f, b, n in W.FLAGS)
FH = ("flag_history",)
CUR = """cur as (select dataset_id, flag, timestamp as set_at, run_id from (select * from flag_history
  qualify row_number() over (partition by dataset_id, flag order by timestamp desc, run_id desc) = 1) where action = 'set')"""


@query("current_flags", f"with {CUR} select dataset_id, cur.flag, set_at, set_by, run_id from cur join flag_list using (flag)", ("flag_history", "flag_list"))
def _(t):
    return W.current_flags(t.flag_history)


PHASE_VALUES = "ph as (select * from (values ('00', 'vet'), ('10', 'eda'), ('15', 'clean'), ('20', 'engineer'), ('25', 'cluster'), ('30', 'select'), ('50', 'report')) v(code, action))"
REQ = f"""{CUR}, {PHASE_VALUES}, ds as (select distinct user_id as dataset_id from events),
 x as (select ds.dataset_id, ph.code, ph.action, f.flag, contains(f.req, ',' || ph.action || ',') as need, f.set_by = ph.action as own,
   exists (select 1 from ph q where q.action = f.set_by and q.code < ph.code) as prior, cur.flag is not null as have
   from ds cross join ph cross join flag_list f left join cur on cur.dataset_id = ds.dataset_id and cur.flag = f.flag),
 a as (select dataset_id, code, action, coalesce(string_agg(flag, ',' order by flag) filter (where need and not have), '') as missing,
   coalesce(string_agg(flag, ',' order by flag) filter (where need and have), '') as satisfied,
   coalesce(string_agg(flag, ',' order by flag) filter (where prior and not need and not have), '') as optional_missing,
   count(*) filter (where need and not have) = 0 as can_proceed, count(*) filter (where need and not have) = 0 and count(*) filter (where prior and not need and not have) > 0 as speedrun,
   coalesce(string_agg(flag, ',' order by flag) filter (where own and have), '') as flags_set from x group by 1, 2, 3)"""


def users(t):
    return t.events.select(F.col("user_id").alias("dataset_id")).distinct()


def texts(df):
    return df.select(*[F.array_join(c, ",").alias(c) if ty.startswith("array") else F.col(c) for c, ty in df.dtypes])


@query("check_requirements", f"with {REQ} select * from a", ("flag_history", "flag_list"))
def _(t):
    return texts(W.check_requirements(users(t), W.current_flags(t.flag_history)))


@query("route_status", f"""with {REQ} select dataset_id, code || '-' || action as phase, case when flags_set <> '' then 'completed' when can_proceed then 'unlocked' else 'locked' end as status,
 flags_set, missing as missing_requirements, speedrun from a""", ("flag_history", "flag_list"))
def _(t):
    return texts(W.route_status(users(t), W.current_flags(t.flag_history)))


FIX["evidence"] = """select user_id as dataset_id, case event_id % 10 when 0 then 'vet_report' when 1 then 'eda_run' when 2 then 'column_assessment' when 3 then 'clean_steps'
  when 4 then 'engineer_steps' when 5 then 'engineer_verdict' when 6 then 'cluster_labels' when 7 then 'selection_target' when 8 then 'selection_keep' else 'notes_target' end as kind,
  case when event_type = 'click' then 'pass' when event_type = 'view' then 'sufficient' else 'fail' end as verdict, ts as seen_at, event_id as run_id from {events}"""


@query("backfill_flags", f"""with {CUR}, e as (select * from evidence qualify row_number() over (partition by dataset_id, kind order by seen_at desc, run_id desc) = 1),
 r as (select * from (values {', '.join(f"('{k}', {'null' if v is None else repr(v)}, '{f}')" for k, v, f in W.EVIDENCE)}) x(kind, needs, flag))
 select e.dataset_id, r.flag, e.run_id, 'backfilled' as detail from e join r on r.kind = e.kind and (needs is null or needs = e.verdict)
 where not exists (select 1 from cur where cur.dataset_id = e.dataset_id and cur.flag = r.flag)""", ("flag_history", "evidence"))
def _(t):
    return W.backfill_flags(t.evidence, W.current_flags(t.flag_history))


FIX["index_rows"] = """select user_id as dataset_id, case event_type when 'click' then 'columns' when 'view' then 'tables' when 'error' then 'concerns' else 'charts' end as section,
  concat('n', cast(event_id % 4 as string)) as name, props as entry, event_id as version, value from {events}"""


@query("index_merge", """select dataset_id, section, name, arg_max(entry, version) as entry, max(version) as version from index_rows where section <> 'concerns' group by 1, 2, 3
 union all select dataset_id, section, name, entry, version from index_rows where section = 'concerns'""", ("index_rows",))
def _(t):
    r = t.index_rows
    return W.index_merge(r.filter("value < 10").drop("value"), r.filter("value >= 10").drop("value"))


@query("alive_objects", """with l as (select user_id as dataset_id, 'obj' || cast(event_id % 3 as varchar) as name, case when event_type = 'error' then 'retire' else 'register' end as action, event_id as seen, props as shape from events)
 select dataset_id, name, arg_max(shape, seen) filter (where action = 'register') as shape, max(seen) as "at" from l group by 1, 2 having arg_max(action, seen) = 'register'""")
def _(t):
    log = t.events.select(F.col("user_id").alias("dataset_id"), F.concat(F.lit("obj"), (F.col("event_id") % 3).cast("string")).alias("name"),
                          F.when(F.col("event_type") == "error", "retire").otherwise("register").alias("action"), F.col("event_id").alias("at"), F.col("props").alias("shape"))
    return W.alive_objects(log)


# JSON fields

FIX["mixed_json"] = """select event_id, case event_id % 8 when 0 then null when 1 then concat('"', event_type, '"') when 2 then concat('{"feature": "', event_type, '", "value": ', cast(user_id as string), '}')
  when 3 then concat('["a", "', event_type, '"]') when 4 then concat('[{"feature": "x"}, {"other": "', event_type, '"}, 7]') when 5 then cast(user_id as string)
  when 6 then '"  "' else props end as j, event_type, user_id, props from {events}"""


@query("json_to_string_list", """select event_id, case event_id % 8 when 0 then '' when 1 then event_type when 2 then event_type when 3 then 'a|' || event_type
 when 4 then 'x|' || event_type || '|7' when 5 then cast(user_id as varchar) when 6 then '' else replace(props, ' ', '') end as items,
 cast(case event_id % 8 when 0 then 0 when 3 then 2 when 4 then 3 when 6 then 0 else 1 end as int) as n from mixed_json""", ("mixed_json",))
def _(t):
    a = J.json_to_string_list(F.col("j"))
    return t.mixed_json.select("event_id", F.array_join(a, "|").alias("items"), F.size(a).alias("n"))


@query("json_to_string", """select event_id, case event_id % 8 when 0 then '' when 1 then event_type when 2 then cast(user_id as varchar) when 3 then '["a","' || event_type || '"]'
 when 4 then '[{"feature":"x"},{"other":"' || event_type || '"},7]' when 5 then cast(user_id as varchar) when 6 then '  ' else props->>'k' end as text from mixed_json""", ("mixed_json",))
def _(t):
    return t.mixed_json.select("event_id", J.json_to_string(F.col("j")).alias("text"))


@query("json_join_list", """select event_id, case event_id % 8 when 0 then '' when 1 then event_type when 2 then event_type when 3 then 'a, ' || event_type
 when 4 then 'x, ' || event_type || ', 7' when 5 then cast(user_id as varchar) when 6 then '' else replace(props, ' ', '') end as text from mixed_json""", ("mixed_json",))
def _(t):
    return t.mixed_json.select("event_id", J.json_join_list(F.col("j")).alias("text"))


@query("split_response", r"""with p as (select *, case when contains(response, '```json') then '```json' when contains(response, '```') then '```' end as f from responses)
 select conv_id, turn, case when f is null then '' else regexp_replace(split_part(response, f, 1), '^\s+|\s+$', '', 'g') end as reasoning,
  regexp_replace(case when f is null then response else split_part(split_part(response, f, 2), '```', 1) end, '^\s+|\s+$', '', 'g') as json_block from p""", ("responses",))
def _(t):
    return J.split_response(t.responses, "response").select("conv_id", "turn", "reasoning", "json_block")
