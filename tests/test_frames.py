"""Scalable building blocks against their plain forms, on skewed input."""

import glob

import pytest
from pyspark.sql import functions as F

from tablescope.functions import frames as fr
from tablescope.functions.graph import components


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of the rows hold one value, half of them one group.
    return spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 50 == 0, None).otherwise(F.rand(1) * 1e6).alias("v"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))).alias("g"), "id").persist()


def test_quantiles(skewed):
    probs = [0, 0.1, 0.5, 0.9, 1]
    a = fr.group_quantiles(skewed, ["g"], "v", probs, True)
    b = fr.group_quantiles(skewed, ["g"], "v", probs, False).select(a.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_row_index(skewed, by):
    a = fr.row_index(skewed, by, ["v", "id"], one_pass=False)
    b = fr.row_index(skewed, by, ["v", "id"], one_pass=True)
    assert a.count() == skewed.count() and a.exceptAll(b).count() == 0


ORDERS = {"hot value": ["v", "id"], "mostly null": ["n", "id"], "text": ["t"], "text, mostly null": ["tn", "id"]}


@pytest.fixture(scope="module")
def orders(skewed):
    text = F.concat(F.lit("k"), F.md5(F.col("id").cast("string").cast("binary")))
    rare = F.col("id") % 10 == 0
    return skewed.select("*", F.when(rare, F.col("v")).alias("n"), text.alias("t"), F.when(rare, text).alias("tn")).persist()


@pytest.mark.parametrize("order", ORDERS)
def test_no_bucket_is_large(orders, monkeypatch, order):
    monkeypatch.setattr(fr, "BUCKET_ROWS", 1000)
    largest = fr._placed(orders, ORDERS[order]).groupBy("__b").count().agg(F.max("count")).first()[0]
    assert largest < orders.count() / 12


@pytest.mark.parametrize("order", ORDERS)
def test_row_index_of_any_order(orders, monkeypatch, order):
    monkeypatch.setattr(fr, "BUCKET_ROWS", 1000)
    a = fr.row_index(orders, ["g"], ORDERS[order], one_pass=False).select("id", "row_index")
    b = fr.row_index(orders, ["g"], ORDERS[order], one_pass=True).select("id", "row_index")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_wide_brackets_are_narrowed(skewed, monkeypatch, accuracy):
    """Few values are ranked in one task, also when the first sketch misses."""
    monkeypatch.setattr(fr, "MAX_INSIDE", 200)
    seen = []
    narrowed = fr._narrowed
    monkeypatch.setattr(fr, "_narrowed", lambda *a: seen.append(narrowed(*a)) or seen[-1])
    probs = [0, 0.01, 0.3, 0.5, 0.77, 0.9, 1]
    a = fr.group_quantiles(skewed, ["g"], "v", probs, True)
    monkeypatch.setattr(fr, "SKETCH_ACCURACY", accuracy)
    b = fr.group_quantiles(skewed, ["g"], "v", probs, False).select(a.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    if accuracy < 1000:
        left = seen[-1].filter("__lo < __hi").agg(F.max("__inside")).first()[0]
        assert len(seen) > 0 and (left or 0) <= 200


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed, descending):
    c = skewed.groupBy("g", "v").agg(F.count("*").alias("m"))
    a = fr.running_totals(c, "v", {"r": "m"}, ["g"], False, descending)
    b = fr.running_totals(c, "v", {"r": "m"}, ["g"], True, descending)
    assert a.exceptAll(b).count() == 0


def test_same_result_with_other_partitioning(spark, skewed):
    probs = [0.25, 0.75]
    one = fr.group_quantiles(skewed.coalesce(1), ["g"], "v", probs, False).collect()
    many = fr.group_quantiles(skewed.repartition(13), ["g"], "v", probs, False).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_top_values_ties(spark):
    d = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in fr.top_values(d, "x", 2).collect()] == [("c", 2), ("a", 1)]


def test_checkpoint_leaves_no_shuffle_files(spark):
    """They went only when the driver collected its garbage, so that the rounds
    of a loop added up on disk."""
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id").groupBy("k").agg(F.sum("id").alias("s"))
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "a long, b long")
    held, was = files(), spark.conf.get(fr.CLEANUP_KEY)
    kept = fr.checkpointed(df)
    parts = components(links)
    assert not files() - held
    assert spark.conf.get(fr.CLEANUP_KEY) == was
    assert sorted(kept.collect()) == sorted(df.collect()) and kept.count() == 7
    assert {r.component for r in parts.collect()} == {0, 21}


def test_few_links_take_few_tasks(spark):
    """However many shuffle partitions there are: a round took one task for
    each, several times."""
    keys = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    links = fr.checkpointed(spark.createDataFrame([(i, i + 1) for i in range(90) if i % 30 != 29], "a long, b long"))
    tracker, name = spark.sparkContext.statusTracker(), "few-links"
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup(name, name)
        parts = components(links)
        stages = {s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {(r.node, r.component) for r in parts.collect()} == {(i, i // 30 * 30) for i in range(90)}
    assert 0 < tasks < 800
