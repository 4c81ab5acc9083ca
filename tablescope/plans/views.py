"""Comparison of several clusterings of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import col
from ..operators.cluster import density_clusters, gmm_labels, kprototypes_labels, mixed_embedding, silhouette, silhouette_scan, zscore

VIEW_SCHEMA = "method string, n_clusters int, silhouette double, bic double, noise_pct double"


def multi_view_cluster(df: DataFrame, id_col: str, nums: Sequence[str], cats: Sequence[str] = (), max_k: int = 6) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One row per view (mixture, prototypes, density) by falling silhouette,
    and the labels of each view."""
    spark = df.sparkSession
    nums, cats = list(nums), list(cats)
    z = zscore(df.select(col(id_col), *[col(c) for c in nums]), nums).persist()
    scored = lambda labels: silhouette(z.join(labels, id_col), id_col, nums, "cluster").first()["silhouette"]
    scan = silhouette_scan(df, id_col, nums, max_k).orderBy(F.desc("silhouette"), "n_clusters").first()
    k = scan["n_clusters"]
    labels = {"gmm": gmm_labels(z, id_col, nums, k)}
    rows = [("gmm", k, scan["silhouette"], scan["bic"], None)]
    if cats:
        labels["kprototypes"] = kprototypes_labels(df, id_col, nums, cats, k)
        rows.append(("kprototypes", k, scored(labels["kprototypes"]), None, None))
    n = z.count()
    parts = min(5, max(2, (len(nums) + len(cats)) // 3))
    space = mixed_embedding(df, id_col, nums, cats, parts).persist()
    found, info = density_clusters(space, id_col, [c for c in space.columns if c != id_col], max(50, n // 20))
    labels["density"] = found
    clustered = found.filter(F.col("cluster") >= 0).count()
    s = scored(found) if info["n_clusters"] >= 2 and clustered > 100 else 0.0
    rows.append(("density", info["n_clusters"], s, None, info["noise_pct"]))
    rows.sort(key=lambda r: -(r[2] or 0.0))
    return spark.createDataFrame(rows, VIEW_SCHEMA), labels
