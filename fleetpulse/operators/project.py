"""Every event to the common shape ``(driver_id, event_time, 7 totals)``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import SOURCE_TS, TOTALS
from .events import event_time_sql, per_kind_sql

# Finish reasons that feed a counter.
DROP_OFF = "DROP_OFF"
DRIVER_CANCEL = "DRIVER_CANCEL"


def total_sql() -> dict:
    """Per total, its SQL value for each kind (missing kinds contribute 0).

    P1 rated:   number_of_ratings = 1, total_rating = rating.
    P2 tipped:  total_tips = amount.
    P3 journey: drop-off / driver-cancel counters; distance and price are
                summed for every finish reason (rider and admin cancels hit no
                counter but still count distance and price).
    """
    zero = "CAST(0 AS BIGINT)"
    spec = {
        "total_drop_offs": {"journey": f"CASE WHEN finish_reason = '{DROP_OFF}' THEN 1L ELSE 0L END"},
        "total_driver_cancels": {"journey": f"CASE WHEN finish_reason = '{DRIVER_CANCEL}' THEN 1L ELSE 0L END"},
        "total_distance": {"journey": f"coalesce(distance, {zero})"},
        "total_price": {"journey": f"coalesce(price, {zero})"},
        "total_tips": {"tipped": f"coalesce(amount, {zero})"},
        "number_of_ratings": {"rated": "1L"},
        "total_rating": {"rated": "rating"},
    }
    return {name: f"{per_kind_sql(spec[name], otherwise=zero)} AS {name}" for name in TOTALS}


def to_event_stats(wide: DataFrame, keep: tuple = ()) -> DataFrame:
    """Project the wide frame to the common shape; carries ``source_ts``
    and any ``keep`` columns along."""
    extra = [f"`{c}`" for c in (*keep, "kind", SOURCE_TS) if c in wide.columns]
    totals = total_sql()
    return wide.selectExpr(*extra, "driver_id", f"{event_time_sql()} AS event_time",
                           *[totals[n] for n in TOTALS])
