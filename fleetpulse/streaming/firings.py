"""Accumulating panes on the watermark trigger.

The reference declares, for its rebuild tool, windows that fire whenever the
watermark has passed their end, with accumulated totals: the on-time firing
first, then one firing per arrival of late events while the allowed lateness
(zero there) lasts.

Here that is an event-time ``transformWithState`` processor.  A window's drivers
are dealt to ``slots`` keys (window, slot), each with its drivers' running totals, packed
as in ``panes``.  The first row of a slot registers an event-time timer at the
window's end; it emits every driver ``on_time``.  Rows that come later are added to
the totals, and the changed drivers are emitted again as ``late``.  A second
timer, at window end + lateness, drops the slot's state.

Defined cases: rows of a window whose end + lateness the watermark has passed
are dropped; rows that come in the very micro-batch of the on-time firing are part of
it if the slot was open, and a late firing if it was not; drivers without an
event never fire.

``watermarked`` (T2) sets the watermark for these operators.  An event counts for
it at most as of its arrival (+ ``ahead_seconds``), so an event dated ahead
closes no window early; the event itself still belongs to the window of its own time.  As
the skew filter bounds event times from below by arrival - skew, and the
watermark stays at least that far behind the arrivals, no kept event is late
in a log that is read in arrival order, whatever its other events say.  Spark's own
windowed aggregation (append mode) needs the watermark on the window's time and cannot use it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..config import StatsParams, ship_package
from ..operators.aggregate import average_rating
from ..schemas import TOTALS
from .panes import (PART, SLOT_KEYS, added, held_parts, keep, pack, packed_slots, pickle_by_value,
                    unpack_drivers)

#: Slots per window: the most tasks one window's drivers are spread over.
SLOTS = 32

STAGE = T.StructType([T.StructField("fired", T.BooleanType()), T.StructField("parts", T.LongType())])
OUT = T.StructType(
    [T.StructField("interval_start_ms", T.LongType()),
     T.StructField("interval_end_ms", T.LongType()),
     T.StructField("firing", T.StringType()),
     T.StructField("drivers", T.BinaryType())])


class WatermarkFirings(StatefulProcessor):
    """Per (window, slot): running totals, fired on time and again with late rows."""

    def __init__(self, lateness_ms: int):
        self.lateness_ms = int(lateness_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.stage = handle.getValueState("stage", STAGE)
        self.drivers = handle.getListState("drivers", PART)

    def handleInputRows(self, key, rows, timerValues):
        end, watermark = key[1], timerValues.getCurrentWatermarkInMs()
        if end + self.lateness_ms <= watermark:
            for _ in rows:
                pass
            return iter([])
        stage = self.stage.get()
        # A slot that opens after its window's end has no on-time firing.
        fired, held = stage or (end <= watermark, 0)
        if stage is None:
            self.handle.registerTimer(end + self.lateness_ms if fired else end)
        new = [r["drivers"] for r in rows]
        if not fired:
            self.stage.update((False, keep(self.drivers, held, new)))
            return iter([])
        import pyarrow.compute as pc

        changed, total = added(new)["driver_id"], added([*held_parts(self.drivers, held), *new])
        self.drivers.put([(pack(total),)])
        self.stage.update((True, 1))
        late = total.filter(pc.is_in(total["driver_id"], value_set=changed))
        return iter([self._row(key, pack(late), "late")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired, held = self.stage.get()
        out = []
        if not fired:
            # One slot's share of a window's drivers.
            total = pack(added(held_parts(self.drivers, held)))
            out = [self._row(key, total, "on_time")]
        if not fired and self.lateness_ms:
            self.drivers.put([(total,)])
            self.stage.update((True, 1))
            self.handle.registerTimer(key[1] + self.lateness_ms)
        else:
            self.drivers.clear()
            self.stage.clear()
        return iter(out)

    @staticmethod
    def _row(key, drivers, firing):
        return Row(interval_start_ms=key[0], interval_end_ms=key[1], firing=firing, drivers=drivers)

    def close(self) -> None:
        pass


def watermarked(event_stats: DataFrame, params: StatsParams, ahead_seconds: int = 0) -> DataFrame:
    """T2 that no event dated ahead can move: the watermark follows the earlier of
    event time and arrival + ``ahead_seconds``."""
    clock = F.expr(f"least(event_time, source_ts + INTERVAL {int(ahead_seconds)} SECONDS)")
    return event_stats.withColumn("watermark_time", clock).withWatermark("watermark_time", params.watermark)


def watermark_firings(event_stats: DataFrame, params: StatsParams, lateness_seconds: int = 0,
                      slots: int = SLOTS) -> DataFrame:
    """driver_id, interval, ``firing`` (on_time or late), the running totals and the average
    rating, of a stream with a watermark.  ``slots`` is fixed with the checkpoint."""
    ship_package(event_stats.sparkSession)
    pickle_by_value(__name__, pack.__module__)
    packed = packed_slots(event_stats, params.interval, slots)
    out = unpack_drivers(packed.groupBy(*SLOT_KEYS[1:]).transformWithState(
        WatermarkFirings(int(lateness_seconds) * 1000), OUT, "Append", "EventTime"))
    return out.select(
        "driver_id",
        F.timestamp_millis("interval_start_ms").alias("interval_start"),
        F.timestamp_millis("interval_end_ms").alias("interval_end"),
        "firing",
        *TOTALS,
        average_rating(F.col("total_rating"), F.col("number_of_ratings")).alias("avg_rating"))
