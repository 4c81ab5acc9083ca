"""Connected components of links that are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .frames import checkpointed, leaving_nothing

#: Links of a task in a round: few links take few tasks, whatever the number of
#: shuffle partitions, as a component takes many short rounds.
TASK_LINKS = 5_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected links.

    Alternating large-star and small-star rounds. Every round is an aggregate
    by node with map-side combine and a join, and is checkpointed in the shared
    folder; the rounds end when no link changes. Each node's result is one
    link, so the links never grow beyond their first number by more than the
    number of nodes. Nodes without links do not appear.
    """
    x = links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo < hi").distinct()
    x = checkpointed(x)
    spark, last = x.sparkSession, None
    with leaving_nothing(spark):
        n = x.count()
    while True:
        tasks = 1 + n // TASK_LINKS
        few = (lambda df: df.coalesce(tasks)) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else (lambda df: df)  # noqa: B023, E731
        x = few(x)
        # Large star: every neighbour above a node meets the node's smallest neighbour.
        both = few(x.select(F.col("lo").alias("n"), F.col("hi").alias("m")).union(x.select(F.col("hi").alias("n"), F.col("lo").alias("m"))))
        least = few(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("r")))
        large = few(few(both.filter("m > n").join(least, "n")).select(F.col("r").alias("lo"), F.col("m").alias("hi")).filter("lo < hi").distinct())
        # Small star: every neighbour below a node, and the node, meet the smallest one.
        low = few(large.groupBy("hi").agg(F.min("lo").alias("r")))
        small = few(large.join(low, "hi")).select(F.col("r").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi")).filter("lo < hi").distinct()
        x = checkpointed(few(small))
        with leaving_nothing(spark):
            now = x.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            return x.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(x.select(F.col("lo"), F.col("lo"))).distinct()
        last, n = tuple(now), now[0]
