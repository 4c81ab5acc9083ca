"""Step replay with written boundaries."""

from pyspark.sql import functions as F

from tablescope.plans.replay import Step, replay_written


def test_a_step_that_fails_on_data_is_left_out(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    calls = []

    def step(name, change):
        def run(d):
            calls.append(name)
            return change(d)

        return Step(name, run, version=name)

    bad = lambda d: d.withColumn("z", F.when(F.col("id") == 777, F.raise_error(F.lit("row 777"))).otherwise(F.lit(1)))
    steps = [
        step("double", lambda d: d.withColumn("y", F.col("x") * 2)), step("bad", bad), step("unknown", lambda d: d.select("nothing")),
        step("filter", lambda d: d.filter("y > 100")),
    ]
    out, log = replay_written(df, steps, "input-1", str(tmp_path))
    assert out.columns == ["id", "x", "y"] and out.count() == 974
    results = [r.result for r in log.orderBy("position").collect()]
    assert results[0] == "OK: +1 cols (y)" and results[1].startswith("FAILED") and results[2].startswith("FAILED") and results[3] == "OK: in-place transform"
    assert calls == ["double", "bad", "unknown", "filter"]
    # The second run takes up the written steps and adds one.
    more = [*steps, step("last", lambda d: d.withColumn("w", F.col("y") + 1))]
    out, _ = replay_written(df, more, "input-1", str(tmp_path))
    assert calls[4:] == ["bad", "unknown", "last"] and out.agg(F.sum("w")).first()[0] == sum(4 * i + 1 for i in range(26, 1000))
    # Another input has results of its own.
    out, _ = replay_written(df.limit(0), steps, "input-2", str(tmp_path))
    assert out.count() == 0 and calls[7:] == ["double", "bad", "unknown", "filter"]
