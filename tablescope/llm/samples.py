"""Bounded samples of labelled rows, on which the small models are fitted."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of each class at most, bytes above which a text is taken only if the
#: class has too few shorter ones, and bytes of each class at most (its first
#: text aside). Rows are taken in order of a hash of their id, so that no source
#: is preferred.
PER_CLASS, LONGEST = 800, 32_768
CLASS_BYTES = PER_CLASS * LONGEST


def bounded(rows: DataFrame, group: str, id_col: str, size: str, most: int, most_bytes: int, longest: int = LONGEST) -> DataFrame:
    """At most ``most`` rows and ``most_bytes`` bytes of each group, shorter
    texts than ``longest`` bytes first; each group has one row at least."""
    order = (F.col(size) > longest, F.xxhash64(id_col), F.col(id_col), F.col(size))
    w = Window.partitionBy(group).orderBy(*order)
    few = rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most)
    total = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return few.withColumn("total", total).filter((F.col("r") == 1) | (F.col("total") <= most_bytes)).drop("r", "total")


def not_held_out(id_col: str, folds: int, held: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) != held


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_class: int = PER_CLASS, text: str = "text", id_col: str = "doc_id",
                    class_bytes: int = CLASS_BYTES, longest: int = LONGEST):
    """(texts, labels, weights): at most ``per_class`` rows and ``class_bytes``
    bytes of label 0 and of label 1 that are not held out, weighted so that the
    classes count as often as among all labelled rows. Longer texts fill up
    what shorter ones leave. Near-equal texts are taken once."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & not_held_out(id_col, folds, held)).groupBy(id_col).agg(F.max(label).alias("y"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    lengths = docs.filter(F.col(text).isNotNull()).groupBy(id_col).agg(F.min(F.octet_length(text)).alias("size"))
    ids = bounded(known.join(lengths, id_col), "y", id_col, "size", per_class, class_bytes, longest)
    # At most 2 * per_class rows, so they may be broadcast.
    own = docs.select(id_col, text, F.octet_length(text).alias("size")).join(F.broadcast(ids), [id_col, "size"]).groupBy(id_col).agg(F.min(text).alias("t"), F.max("y").alias("y"))
    rows = sorted(own.collect(), key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[0]))
    seen: set[int] = set()
    texts, ys = [], []
    for r in rows:
        words = (r["t"] or "").split()
        marks = sorted({xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))})[:8]
        if 2 * sum(m in seen for m in marks) >= len(marks):
            continue
        seen.update(marks)
        texts.append(r["t"] or "")
        ys.append(int(r["y"]))
    ys = np.array(ys, np.int64)
    weight = np.array([total.get(y, 0) / max(1, int((ys == y).sum())) for y in ys.tolist()])
    return texts, ys, weight * len(ys) / max(1e-9, weight.sum())
