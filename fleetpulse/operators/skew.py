"""drop events whose event time lags their arrival by more than the skew.

Kept iff ``event_time >= source_ts - skew`` (boundary inclusive).  There is no
upper bound: a future-dated event is kept (and moves a stream's watermark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import SOURCE_TS


def within_skew_sql(skew_seconds: int) -> str:
    return f"event_time >= timestampadd(SECOND, {-int(skew_seconds)}, {SOURCE_TS})"


def skew_filter(events: DataFrame, skew_seconds: int,
                observation: Observation | str | None = None) -> DataFrame:
    """Apply F4.  With ``observation`` (O1) the number of events seen and
    dropped is reported: for a batch job through the ``Observation`` object,
    for a stream in ``StreamingQueryProgress.observedMetrics`` under that
    name.  The count is exact: it is taken before any aggregation."""
    keep = within_skew_sql(skew_seconds)
    if observation is not None:
        events = events.observe(
            observation,
            F.expr("count(1) AS seen"),
            F.expr(f"count_if(NOT coalesce({keep}, false)) AS dropped_for_skew"),
        )
    return events.filter(F.expr(keep))


def skew_dropped(events: DataFrame, skew_seconds: int) -> DataFrame:
    """The events F4 removes (the complement, for reports)."""
    return events.filter(F.expr(f"NOT coalesce({within_skew_sql(skew_seconds)}, false)"))
