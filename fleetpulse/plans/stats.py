"""Typed events -> driver statistics, batch or streaming.

The same function serves a batch DataFrame and a streaming one.  For a stream
the caller passes ``watermark=True``: the watermark is set once, after the
union (three watermarks would take the minimum, and a silent topic would hold
back all output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from ..config import StatsParams
from ..operators import aggregate, project, skew, validate
from ..operators.events import widen


def event_stats(wide: DataFrame, params: StatsParams = StatsParams(), *,
                validated: bool = True, skew_check: bool = True,
                observation: Observation | str | None = None,
                keep: tuple = ()) -> DataFrame:
    """F1-F3, P1-P4 and F4 on the wide frame: the common shape to aggregate."""
    if validated:
        wide = validate.valid(wide)
    es = project.to_event_stats(wide, keep=keep)
    if skew_check:
        es = skew.skew_filter(es, params.skew_seconds, observation)
    return es


def driver_stats(wide: DataFrame, params: StatsParams = StatsParams(), *,
                 validated: bool = True, skew_check: bool = True,
                 watermark: bool = False,
                 observation: Observation | str | None = None) -> DataFrame:
    """The full job on a wide frame (batch, or streaming with ``watermark``)."""
    es = event_stats(wide, params, validated=validated, skew_check=skew_check,
                     observation=observation)
    if watermark:
        es = es.withWatermark("event_time", params.watermark)
    return aggregate.driver_stats(es, params.interval)


def driver_stats_typed(rated: DataFrame, tipped: DataFrame, journeys: DataFrame,
                       params: StatsParams = StatsParams(), **kw) -> DataFrame:
    """The reference's entry point: three typed inputs, one result."""
    return driver_stats(widen({"rated": rated, "tipped": tipped, "journey": journeys}),
                        params, **kw)
