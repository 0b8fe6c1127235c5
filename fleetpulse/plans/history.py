"""Rebuild driver statistics from the JSON lake (batch).

As in the reference, the history job neither validates nor applies the skew
filter (lake rows carry no arrival time).  An incomplete record fails the job
in the lake reader, as the reference's decoder does, rather than being dropped
or counted as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StatsParams
from ..operators import aggregate, project
from ..operators.events import widen
from ..sources.lake import lake_path, read_lake, write_lake

HISTORY_PARAMS = StatsParams(interval_seconds=600)


def read_history(spark: SparkSession, lake_root: str) -> DataFrame:
    """The three lake folders as one wide event frame."""
    return widen({k: read_lake(spark, lake_path(lake_root, k), k)
                  for k in ("rated", "tipped", "journey")})


def history_stats(wide: DataFrame, params: StatsParams = HISTORY_PARAMS) -> DataFrame:
    es = project.to_event_stats(wide)
    t = F.col("event_time")
    es = es.withColumn("event_time", F.when(
        t.isNull(), F.raise_error(F.concat(F.lit("lake record without its instant, kind "),
                                           F.col("kind")))).otherwise(t))
    return aggregate.driver_stats(es, params.interval)


def rebuild_stats(spark: SparkSession, lake_root: str, out_path: str | None = None,
                  params: StatsParams = HISTORY_PARAMS, mode: str = "errorifexists") -> DataFrame:
    """Read the lake, aggregate, and (with ``out_path``) write the results as
    JSON (S4); ``mode="overwrite"`` replaces an earlier run's.  Returns the result DataFrame (re-read from ``out_path`` when
    written, so the caller does not recompute it)."""
    st = history_stats(read_history(spark, lake_root), params)
    if out_path is None:
        return st
    write_lake(st, out_path, "stats", mode)
    return read_lake(spark, out_path, "stats")
