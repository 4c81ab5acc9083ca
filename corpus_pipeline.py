"""A corpus pipeline of five stages over the documents.

Language identification, near-duplicate removal, removal of repeated passages,
secret redaction, packing. Each stage is a function of (spark, docs, sf_dir);
its result is written as Parquet in the shared folder and read again as the
next one's docs. A stage sees only what its predecessor kept. All but the last
return the columns of their input, in order, whatever further columns it has;
``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablescope.functions.graph import components
from tablescope.llm import langid, nearsets, packing, repeats, secrets, simhash
from tablescope.sources.files import scratch_dir

#: A text of this many characters or more of which less than this share of
#: n-grams is known in any language is in none of them.
LEAST_LENGTH, LEAST_COVERAGE = 40, 0.3
SECRET_MARK = "[SECRET]"


class Plain:
    """``docs`` under neutral column names, so that no name of a document
    column meets one of an operator, and the way back."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.df = docs.toDF(*[f"c{i}" for i in range(len(self.names))])

    def __getitem__(self, name: str) -> str:
        return f"c{self.names.index(name)}"

    def back(self, df: DataFrame, text: str | None = None) -> DataFrame:
        """The columns of the documents again; ``text`` names the new text."""
        new = F.col(text) if text else F.col(self["text"])
        own = {"text": new} | ({"n_chars": F.coalesce(F.length(new), F.lit(0)).cast("bigint")} if text else {})
        return df.select(*[own.get(n, F.col(f"c{i}")).alias(n) for i, n in enumerate(self.names)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones included, and longer texts that
    no learned language covers. Short texts with a letter stay."""
    p = Plain(docs)
    model = langid.learn(p.df, text=p["text"], lang=p["lang"], id_col=p["doc_id"])
    others = tuple(c for c in p.df.columns if c not in (p["doc_id"],))
    found = langid.predict(p.df, model, text=p["text"], id_col=p["doc_id"], keep=others)
    foreign = (F.col("coverage") < LEAST_COVERAGE) & (F.length(p["text"]) >= LEAST_LENGTH) & F.lit(bool(model.names))
    has_letter = F.col(p["text"]).rlike(r"\p{L}")
    return p.back(found.filter(has_letter & ~foreign))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: the one of smallest id
    and, of an id's different texts, the one of smallest hash. Near-copies
    have fingerprints within the radius of SimHash or, as that radius is too
    small for them, sets of five-word shingles of similarity 0.8 or more. Rows
    without an id cannot be named and stay."""
    p = Plain(docs)
    named = p.df.filter(F.col(p["doc_id"]).isNotNull()).withColumn("who", F.struct(F.col(p["doc_id"]).alias("id"), F.xxhash64(p["text"]).alias("mark")))
    by_hash = simhash.near_duplicates(named, p["text"], "who").select("who", F.col("component_id").alias("least"))
    by_set = nearsets.near_sets(named, p["text"], "who")
    by_set = by_set.join(by_set.groupBy("part").agg(F.min("who").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "part").select("who", "least")
    gone = components(by_hash.union(by_set), "who", "least").filter("node <> component").select(F.col("node").alias("who"))
    kept = named.join(gone, "who", "left_anti").dropDuplicates(["who"]).drop("who")
    return p.back(kept.unionByName(p.df.filter(F.col(p["doc_id"]).isNull())))


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every byte of strings of 200 bytes that occur twice; a document
    of which nothing is left stays with an empty text."""
    p = Plain(docs)
    return p.back(repeats.dedup_repeats(p.df, p["text"], keep_text=True), "kept")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; no document goes."""
    p = Plain(docs)
    others = tuple(c for c in p.df.columns if c not in (p["doc_id"], p["text"]))
    return p.back(secrets.scan(p.df, p["text"], p["doc_id"], keep=others, mark=SECRET_MARK), "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, bucketed by length."""
    return packing.pack_power_of_two(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeat_dedup", repeat_dedup),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the language model nor tokens; tests hold the
#: stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
