"""Tumbling windows and the seven totals per driver.

The reference groups a whole window on one key and folds it in memory.  Here
the key is ``(window, driver_id)`` and every total is a ``sum``, so Spark
aggregates partially before the shuffle: a driver holding a third of all
events leaves at most one row per map task and window, and no window is ever
held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TOTALS


def tumbling(interval: str, col: str = "event_time") -> Column:
    """Left-closed ``[a, b)``, epoch-aligned, zero offset."""
    return F.window(col, interval)


def average_rating_sql(total: str = "total_rating", n: str = "number_of_ratings") -> str:
    """A4: total / n as float, 0 without ratings."""
    return f"CAST(CASE WHEN {n} > 0 THEN {total} / {n} ELSE 0.0D END AS FLOAT)"


def average_rating(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n).otherwise(F.lit(0.0)).cast("float")


def sum_totals() -> list:
    """A3: the seven sums."""
    return [F.expr(f"sum({c}) AS {c}") for c in TOTALS]


FINISH_SQL = ("driver_id", "window.start AS interval_start", "window.end AS interval_end",
              "total_drop_offs", "total_driver_cancels", "total_distance", "total_price",
              "total_tips", f"{average_rating_sql()} AS avg_rating")


def finish(totals: DataFrame) -> DataFrame:
    """P5: accumulator row -> result row (window bounds as data, W2/W7)."""
    return totals.selectExpr(*FINISH_SQL)


def window_totals(event_stats: DataFrame, interval: str) -> DataFrame:
    """A1+A2+A3: one row of sums per (window, driver)."""
    return event_stats.groupBy(tumbling(interval).alias("window"), "driver_id").agg(*sum_totals())


def driver_stats(event_stats: DataFrame, interval: str) -> DataFrame:
    """Windows and totals, final rows."""
    return finish(window_totals(event_stats, interval))
