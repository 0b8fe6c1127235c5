"""J3 as a correction: only the days that lost events to the skew filter are rebuilt.

The live job drops events that arrive late (F4); the reference tells its users
to repair that by rebuilding history from all events.  Here the dropped events are
kept as a side output (``runner.start_skew_split``), laid out by the day
of their interval, so a repair reads and writes no more than it must:

* the *touched* days are those of the dropped events, found from the folder names;
* events are read for these days only (partition pruning);
* statistics, laid out by the same day, are replaced for these days only
  (dynamic partition overwrite); files of other days are not touched.

A day is that of an interval's start, so an interval is never split.  A repair
can run again, or after a failure, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StatsParams
from ..operators import aggregate

DAY = "day"


def day_of_interval(params: StatsParams):
    """Day of the interval an event belongs to."""
    return F.to_date(aggregate.tumbling(params.interval)["start"])


def write_stats(stats: DataFrame, path: str, *, replace_days: bool = False) -> None:
    """Statistics by day; with ``replace_days`` only the days that ``stats`` holds are replaced."""
    by_day = stats.withColumn(DAY, F.to_date("interval_start")).repartition(DAY, F.pmod(F.xxhash64("driver_id"), F.lit(8)))
    (by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace_days else "static")
     .partitionBy(DAY).parquet(path))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(DAY)


def touched_days(events: DataFrame) -> list:
    """Days with dropped events: partition values only, one per day at most."""
    rows = events.where("dropped = 'true'").select(DAY).distinct().orderBy(DAY).collect()
    return [r[0] for r in rows]


def correct(spark: SparkSession, events_path: str, stats_path: str, params: StatsParams = StatsParams()) -> list:
    """Rebuild the touched days of ``stats_path`` from all events, kept and dropped; returns these days."""
    events = spark.read.parquet(events_path)
    days = touched_days(events)
    if days:
        some = events.where(F.col(DAY).isin(days))
        write_stats(aggregate.driver_stats(some, params.interval), stats_path, replace_days=True)
    return days
