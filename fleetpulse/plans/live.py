"""The live job, raw payloads in, raw payloads out, one streaming query.

topic log (S1) -> decode by topic (D1-D5) -> validate (F1-F3) -> common shape
(P1-P4) -> skew filter (F4) -> one watermark after the union (T2) ->
tumbling window totals per (window, driver) (W1, A1-A4) -> final rows once
the watermark passes the window end (W3, W4; append mode) -> encode (E1) ->
output topic (S2), checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import StatsParams
from ..plans.stats import driver_stats, event_stats
from ..sources.topics import decode_events, encode_stats

# Names under which a running query reports its metrics (O1, B7 count).
SKEW_METRICS = "skew"
DECODE_METRICS = "decode"
# Event fields no statistic reads.
UNUSED = ("rider_id",)


def live_stats(raw: DataFrame, params: StatsParams = StatsParams(), *,
               observe: bool = True) -> DataFrame:
    """Typed result rows of the live job (streaming or batch input)."""
    wide = decode_events(raw, params, observation=DECODE_METRICS if observe else None, skip=UNUSED)
    return driver_stats(wide, params, watermark=raw.isStreaming,
                        observation=SKEW_METRICS if observe else None)


def live_job(raw: DataFrame, params: StatsParams = StatsParams()) -> DataFrame:
    """Encoded result rows ``(value, topic, timestamp)``; timestamp = interval end."""
    return encode_stats(live_stats(raw, params), params)


def live_pane_deltas(raw: DataFrame, params: StatsParams = StatsParams(),
                     delay_seconds: float | None = None, poll_seconds: float | None = None,
                     slots: int | None = None) -> DataFrame:
    """The reference's live trigger - all drivers of a window's pane, fired together
    ``delay_seconds`` (default: the interval) of processing time after the
    pane's first event, or when the window closes."""
    from ..streaming.panes import SLOTS, pane_deltas

    wide = decode_events(raw, params, observation=DECODE_METRICS, skip=UNUSED)
    es = event_stats(wide, params, observation=SKEW_METRICS)
    es = es.withWatermark("event_time", params.watermark)
    delay = params.interval_seconds if delay_seconds is None else delay_seconds
    return pane_deltas(es, params, delay, poll_seconds, slots or SLOTS)


def live_firings(raw: DataFrame, params: StatsParams = StatsParams(), lateness_seconds: int = 0,
                 ahead_seconds: int = 0, slots: int | None = None) -> DataFrame:
    """Accumulating firings on the watermark trigger, under a watermark that
    an event dated ahead cannot move (T2)."""
    from ..streaming.firings import SLOTS, watermark_firings, watermarked

    wide = decode_events(raw, params, observation=DECODE_METRICS, skip=UNUSED)
    es = watermarked(event_stats(wide, params, observation=SKEW_METRICS), params, ahead_seconds)
    return watermark_firings(es, params, lateness_seconds, slots or SLOTS)
