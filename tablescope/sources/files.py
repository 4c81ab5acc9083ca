"""Readers and writers: CSV, JSON pages, metadata records, Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.exprs import col
from ..functions.frames import shared_dir


def nan_to_null(df: DataFrame) -> DataFrame:
    """The one missing value of the engine is null."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns
    ])


#: Set to true where cores stand idle beside small files of one split, as on one machine.
SPREAD_KEY = "spark.tablescope.spreadSmallFiles"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan, as it is split. Only a session that asks for it spreads
    files of fewer splits than cores, at the price of a shuffle."""
    df = spark.read.parquet(path)
    if spark.conf.get(SPREAD_KEY, "false") != "true":
        return df
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place named by spark.checkpoint.dir."""
    return f"{shared_dir(spark)}/tablescope/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; without a schema the types are inferred."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return nan_to_null(r.csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_pages(spark: SparkSession, path: str, record_schema: str | None = None) -> DataFrame:
    """Union of datastore pages {result: {records: [...]}} without ``_id``."""
    r = spark.read
    if record_schema:
        r = r.schema(f"result struct<records: array<struct<{record_schema}>>, total: bigint>")
    return r.json(path).select(F.explode("result.records").alias("r")).select("r.*").drop("_id")


METADATA = (
    "datasetId string, name string, format string, collectionIds array<string>, "
    "columnMetadata struct<`order`: array<string>, metaMapping: map<string, "
    "struct<name: string, columnTitle: string, dataType: string, isCategorical: boolean>>>"
)
COLLECTION = (
    "data struct<collectionMetadata: struct<collectionId: string, name: string, description: string, "
    "frequency: string, sources: array<string>, managedBy: string, childDatasets: array<string>>>"
)


def flatten_metadata(records: DataFrame, json_col: str) -> DataFrame:
    """One row per column of a metadata record, in the record's own order."""
    m = records.select(F.from_json(col(json_col), METADATA).alias("m")).select("m.*")
    rows = m.select("datasetId", "columnMetadata.metaMapping", F.posexplode("columnMetadata.order").alias("position", "col_id"))
    info = F.try_element_at(F.col("metaMapping"), F.col("col_id"))
    return rows.select(
        F.col("datasetId").alias("dataset_id"), "position", info["name"].alias("name"), info["columnTitle"].alias("title"),
        info["dataType"].alias("data_type"), F.coalesce(info["isCategorical"], F.lit(False)).alias("categorical"),
    )


def flatten_collections(records: DataFrame, json_col: str) -> DataFrame:
    """Collection records that carry an id."""
    c = records.select(F.from_json(col(json_col), COLLECTION).alias("r")).select("r.data.collectionMetadata.*")
    found = c.filter(F.col("collectionId").isNotNull() & (F.col("collectionId") != ""))
    none = F.array().cast("array<string>")
    return found.select(
        F.col("collectionId").alias("collection_id"), "name", "description", "frequency",
        F.coalesce("sources", none).alias("sources"), F.col("managedBy").alias("managed_by"),
        F.coalesce("childDatasets", none).alias("child_datasets"),
    )


def content_ids(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """dataset_id from the content hash, title from the file stem."""
    stem = F.regexp_extract(col(path), r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select(
        F.concat(F.lit("local_"), F.substring(F.md5(col(content)), 1, 12)).alias("dataset_id"),
        stem.alias("title"), col(path).alias("path"),
    )


def content_catalog(spark: SparkSession, path: str) -> DataFrame:
    """content_ids of CSV files plus their row counts (lines after the header)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"))
    counts = lines.groupBy("path").agg((F.count(F.lit(1)) - 1).alias("row_count"))
    return content_ids(files).join(counts, "path", "left").select(
        "dataset_id", "title", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))


def local_metadata(df: DataFrame, dataset_id: str) -> DataFrame:
    """Fallback metadata of a local table: every header column as text."""
    cells = F.array(*[F.lit(c) for c in df.columns])
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(dataset_id).alias("dataset_id"), "row_count", F.posexplode(cells).alias("position", "name")).select(
        "dataset_id", "row_count", "position", "name", F.col("name").alias("title"),
        F.lit("Text").alias("data_type"), F.lit(False).alias("categorical"))


def head_sample(df: DataFrame, id_cols: list[str], n: int) -> DataFrame:
    """The first n rows by id: a top-n per task, then one merge."""
    return df.orderBy(*[col(c) for c in id_cols]).limit(n)


# Download limit and the share below which a cache is a sample.
MAX_DOWNLOAD_BYTES = 500 * 1024 * 1024
SAMPLE_SHARE = 0.2


def download_plan(catalog: DataFrame) -> DataFrame:
    """Per dataset (id, known_total, cached_rows, cached_bytes): does the cache
    have to be replaced by a full download, and is that within the limit?"""
    total, rows = F.coalesce("known_total", F.lit(0)), F.col("cached_rows")
    cached = rows.isNotNull()
    needs = cached & (total > 0) & (rows < total * SAMPLE_SHARE) & ~F.startswith(F.col("id"), F.lit("local_"))
    est = F.floor(F.col("cached_bytes") / F.greatest(rows, F.lit(1)) * total)
    too_large = needs & (est > MAX_DOWNLOAD_BYTES)
    mb = F.format_string("%.0f", est / F.lit(1048576.0))
    return catalog.select(
        "id", F.coalesce(needs, F.lit(False)).alias("needs_full"), F.when(needs, est).alias("est_bytes"),
        F.when(~cached, "fetch_sample").when(too_large, "reject").when(needs, "download").otherwise("use_cache").alias("plan"),
        F.when(too_large, F.concat(F.lit("too_large_to_download: estimated "), mb, F.lit(" MB"))).alias("reject_reason"),
    )
