"""Query registry, table access and the derived inputs of the queries.

A derived input is SQL text over the given tables, written so that Spark and
DuckDB read it alike; where the dialects differ there is one text for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablescope.sources.files import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

REGISTRY: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None, uses: tuple[str, ...] = ()):
    """Register fn(t: Tables) with its twin SQL; ``uses`` names derived inputs."""

    def deco(fn):
        REGISTRY[name] = (fn, duck(oracle, uses) if oracle else None)
        return fn

    return deco


FIX: dict[str, str | tuple[str, str]] = {
    # Lineitem with nulls, a constant and correlated columns.
    "li_dirty": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
               nullif(l_tax, 0.0) as l_tax_n,
               case when l_linenumber <= 4 then null else l_discount end as l_disc_n,
               1 as l_const,
               l_extendedprice * (1 - l_discount) as revenue,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge
        from {lineitem}""",
    # Lineitem in which the small orders occur twice.
    "li_dup": """
        select * from {lineitem}
        union all
        select * from {lineitem} where l_quantity <= 3""",
    "docs_labelled": """
        select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        from {documents} d left join {labels} l on d.doc_id = l.doc_id""",
    "raw_strings": """
        select o_orderkey, o_totalprice,
               concat(cast(cast(floor(round(o_totalprice * 100) / 100000) as bigint) as string), ',',
                      lpad(cast(cast(floor(round(o_totalprice * 100) / 100) as bigint) % 1000 as string), 3, '0'), '.',
                      lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as string), 2, '0')) as price_txt,
               concat(lpad(cast(o_orderkey % 30 + 1 as string), 2, '0'), ' TO ',
                      lpad(cast(o_orderkey % 30 + 3 as string), 2, '0')) as range_txt,
               concat(cast(year(o_orderdate) as string), '-',
                      lpad(cast(month(o_orderdate) as string), 2, '0')) as month_txt,
               concat(cast(40 + o_orderkey % 59 as string), ' years ',
                      lpad(cast(o_custkey % 12 as string), 2, '0'), ' months') as lease_txt,
               case when o_orderkey % 7 = 0 then 'n/a' else cast(o_totalprice as string) end as bad_num,
               case when o_custkey % 3 = 0 then upper(concat('  ', o_orderpriority))
                    when o_custkey % 3 = 1 then lower(o_orderpriority)
                    else concat(o_orderpriority, ' ') end as category
        from {orders}""",
    "regime": """
        select l_orderkey,
               case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as cluster,
               l_quantity as x, l_extendedprice as price, l_discount as disc, l_tax as tax,
               l_extendedprice * (1 + 0.02 * (case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end) * l_quantity) as target
        from {lineitem}""",
    "emb": (
        "select vec_id, label, "
        + ", ".join(f"cast(element_at(embedding, {i + 1}) as double) as d{i}" for i in range(64))
        + " from {embeddings}",
        "select vec_id, label, "
        + ", ".join(f"cast(embedding[{i + 1}] as double) as d{i}" for i in range(64))
        + " from {embeddings}",
    ),
    "scored": """
        select l_orderkey, l_linenumber, l_returnflag,
               case when l_returnflag = 'R' then 1 else 0 end as actual,
               (l_partkey % 97) / cast(97 as double) as score,
               case when (l_partkey % 97) / cast(97 as double) > 0.5 then 1 else 0 end as pred
        from {lineitem}""",
    "datasets": """
        select concat('d', cast(c_custkey as string)) as id, 'p1' as portal_id, c_name as title,
               case c_mktsegment when 'BUILDING' then 'aggregate' when 'FURNITURE' then 'reference'
                    else 'transactional' end as pipeline_type,
               (c_custkey * 37) % 5000 as row_count,
               case when c_custkey % 11 = 0 then null
                    else case c_custkey % 7 when 0 then '00' when 1 then '10' when 2 then '15' when 3 then '20'
                         when 4 then '25' when 5 then '30' else '50' end end as max_action_code,
               case when c_acctbal < 0 then 1 else 0 end as rejected,
               case when c_custkey % 13 = 0 then '["refresh"]' when c_custkey % 13 = 1 then ''
                    when c_custkey % 13 = 2 then null else '[]' end as cron_actions,
               concat('notes for ', c_name,
                      case when c_custkey % 5 = 0 then '; Target: acct_balance'
                           when c_custkey % 5 = 1 then '; predict = `seg_price`' else '' end) as human_notes,
               case when c_custkey % 3 = 0 then 'order_total' else null end as select_target
        from {customer}""",
    "runs": (
        """
        select concat('r', cast(o_orderkey as string)) as id,
               concat('d', cast(o_custkey as string)) as dataset_id,
               case o_orderpriority when '1-URGENT' then 'vet' when '2-HIGH' then 'eda' when '3-MEDIUM' then 'clean'
                    when '4-NOT SPECIFIED' then 'engineer' else 'cluster' end as action,
               case o_orderstatus when 'F' then 'done' when 'O' then 'running' else 'failed' end as status,
               timestampadd(SECOND, -cast(o_orderkey % 600 as int), o_orderdate) as started_at,
               o_orderdate as finished_at,
               case o_orderkey % 4 when 0 then 'pass' when 1 then 'fail' when 2 then 'promote' else 'reject' end as verdict,
               concat('reason ', cast(o_orderkey as string)) as verdict_reason,
               case when o_orderkey % 50 = 0 then 'not json {'
                    else concat('{"hypothesis": "h', cast(o_custkey % 10 as string),
                                '", "target": "t', cast(o_custkey % 4 as string),
                                '", "findings": ["f', cast(o_orderkey as string), 'a", "f', cast(o_orderkey as string),
                                'b", "extra"]}') end as llm_response
        from {orders}""",
        """
        select concat('r', cast(o_orderkey as string)) as id,
               concat('d', cast(o_custkey as string)) as dataset_id,
               case o_orderpriority when '1-URGENT' then 'vet' when '2-HIGH' then 'eda' when '3-MEDIUM' then 'clean'
                    when '4-NOT SPECIFIED' then 'engineer' else 'cluster' end as action,
               case o_orderstatus when 'F' then 'done' when 'O' then 'running' else 'failed' end as status,
               o_orderdate - to_seconds(cast(o_orderkey % 600 as int)) as started_at,
               o_orderdate as finished_at,
               case o_orderkey % 4 when 0 then 'pass' when 1 then 'fail' when 2 then 'promote' else 'reject' end as verdict,
               concat('reason ', cast(o_orderkey as string)) as verdict_reason,
               case when o_orderkey % 50 = 0 then 'not json {'
                    else concat('{"hypothesis": "h', cast(o_custkey % 10 as string),
                                '", "target": "t', cast(o_custkey % 4 as string),
                                '", "findings": ["f', cast(o_orderkey as string), 'a", "f', cast(o_orderkey as string),
                                'b", "extra"]}') end as llm_response
        from {orders}""",
    ),
    "scan_catalog": """
        select concat('s', cast(doc_id as string)) as id,
               case when doc_id % 2 = 0 then 'p1' else 'p2' end as portal_id,
               case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then 'PDF' when lang = 'de' then 'GEOJSON'
                    when doc_id % 17 = 0 then 'ZIP' else 'CSV' end as format,
               n_chars * 1000 as size_bytes,
               cast(floor(doc_id / 10) as bigint) as page,
               source as name
        from {documents}""",
    "responses": """
        select conv_id, turn,
               case when conv_id % 3 = 0 then concat('I think ', role, '.\n```json\n{"text": "', cast(turn as string), '"}\n```\nbye')
                    when conv_id % 3 = 1 then concat(text, '\n```\n{"turn": ', cast(turn as string), '}\n```')
                    else concat('  ', text, ' ') end as response
        from {conversations}""",
}


def fixture_sql(name: str, dialect: str) -> str:
    text = FIX[name]
    if isinstance(text, tuple):
        text = text[0 if dialect == "spark" else 1]
    return text


def steady(sql: str) -> str:
    """round_even(x, d) as the engine rounds: last bits dropped first."""
    out, i = "", 0
    while (k := sql.find("round_even(", i)) >= 0:
        start = k + len("round_even(")
        depth, j, comma = 1, start, start
        while depth:
            ch = sql[j]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = j
            j += 1
        inner, digits = steady(sql[start:comma]), int(sql[comma + 1 : j - 1])
        out += sql[i:k] + f"round_even(round_even({inner}, {digits + 4}), {digits})"
        i = j
    return out + sql[i:]


def duck(body: str, uses: tuple[str, ...] = ()) -> str:
    body = steady(body)
    if not uses:
        return body
    plain = {t: t for t in TABLES}
    parts = []
    for u in uses:
        text = fixture_sql(u, "duck")
        for t in TABLES:
            text = text.replace("{" + t + "}", plain[t])
        parts.append(f"{u} as ({text})")
    head = ", ".join(parts)
    stripped = body.strip()
    if stripped.lower().startswith("with recursive "):
        return f"with recursive {head}, {stripped[15:]}"
    if stripped.lower().startswith("with "):
        return f"with {head}, {stripped[5:]}"
    return f"with {head} {stripped}"


class Tables:
    """The given tables and the inputs derived from them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")
        if name in FIX:
            return self.sql(fixture_sql(name, "spark"))
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        # Only table placeholders may be replaced; JSON braces stay as they are.
        for t, df in used.items():
            view = f"ts_{t}_{abs(hash(self.sf_dir)) % 10**8}"
            df.createOrReplaceTempView(view)
            text = text.replace("{" + t + "}", view)
        return self.spark.sql(text)
