"""Replay of an ordered chain of named DataFrame steps."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.frames import shared_dir

# Log fields, action names and result texts below.
LOG_SCHEMA = ("position int, step_name string, description string, action string, "
              "columns_added array<string>, result string")


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[DataFrame], DataFrame]
    description: str = ""
    version: str = ""

    def key(self, before: str) -> str:
        """Names the step's result on the input named ``before``: by name,
        description, version and the function's own code. Values that the
        function closes over are not seen; ``version`` must tell them apart."""
        code = getattr(self.run, "__code__", None)
        own = [before, self.name, self.description, self.version, *((code.co_code.hex(), repr(code.co_names)) if code else ())]
        return hashlib.sha256("\0".join(own).encode()).hexdigest()[:32]


def logged(i: int, s: Step, before: DataFrame, after: DataFrame) -> tuple:
    added = [c for c in after.columns if c not in before.columns]
    msg = f"OK: +{len(added)} cols ({', '.join(added)})" if added else "OK: in-place transform"
    return (i + 1, s.name, s.description, "append_column" if added else "in_place_transform", added, msg)


def ordered(steps: Sequence[Step]) -> list[Step]:
    """A step added again under its name replaces the older one, at the end."""
    out: dict[str, Step] = {}
    for s in steps:
        out.pop(s.name, None)
        out[s.name] = s
    return list(out.values())


def replay(df: DataFrame, steps: Sequence[Step], probe: bool = False) -> tuple[DataFrame, DataFrame]:
    """Apply the steps; a failing one is skipped and logged.

    Spark is lazy, so a step fails here when its plan does not resolve; with
    ``probe`` one row is also computed to surface some data errors.
    Returns the resulting table and the step log.
    """
    spark: SparkSession = df.sparkSession
    log = []
    for i, s in enumerate(ordered(steps)):
        try:
            after = s.run(df)
            after.schema
            if probe:
                after.limit(1).collect()
        except Exception as e:
            log.append((i + 1, s.name, s.description, None, [], f"FAILED: {type(e).__name__}"))
            continue
        log.append(logged(i, s, df, after))
        df = after
    return df, spark.createDataFrame(log, LOG_SCHEMA)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end, in any store Spark reads."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def replay_written(df: DataFrame, steps: Sequence[Step], input_id: str, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Like ``replay``, with every step's result written before the next.

    A step that fails on the data, in whatever row, is logged and left out,
    and the chain goes on from the last good result. Results lie under a key
    of ``input_id`` (the caller's name for this state of the input) and all
    steps up to there, so a second run takes up what is written and computes
    only what is new. ``folder`` is shared by all executors; by default it is
    the session's checkpoint folder.
    """
    spark: SparkSession = df.sparkSession
    folder = folder or f"{shared_dir(spark)}/tablescope/steps"
    log, at = [], hashlib.sha256(input_id.encode()).hexdigest()[:32]
    for i, s in enumerate(ordered(steps)):
        key = s.key(at)
        path = f"{folder}/{key}"
        try:
            if not is_written(spark, path):
                s.run(df).write.mode("overwrite").parquet(path)
        except Exception as e:
            log.append((i + 1, s.name, s.description, None, [], f"FAILED: {type(e).__name__}"))
            continue
        after = spark.read.parquet(path)
        log.append(logged(i, s, df, after))
        df, at = after, key
    return df, spark.createDataFrame(log, LOG_SCHEMA)
