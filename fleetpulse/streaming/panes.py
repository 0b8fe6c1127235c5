"""Repeated pane deltas, the reference's live trigger.

The reference fires a window's pane a fixed processing-time delay after the
pane's first element, repeatedly, discarding what it fired: one (window,
driver) may be emitted several times, each row holding only the events that
arrived since the previous firing.  Allowed lateness is zero.  The clock is the
window's: the first element of any driver opens the pane, and all drivers
of it are fired together.

Here a window's drivers are dealt to ``slots`` keys (window, slot) of a
``transformWithState`` processor, so no task gathers a busy window.  Each slot
holds a copy of the window's clock and its drivers' open sums, packed
(``pack``): a task packs the partial sums of a slot into one row before the
shuffle, the slot keeps such parts as a list and adds them up when it fires, and
fired parts are unpacked after the operator.  So state calls and Python rows
count slots and micro-batches, not drivers.  The clock's copies agree without talking to each other: every task that sees a window in
a micro-batch sends one tick to each of its slots, so all slots learn
of the pane's first element in the same micro-batch, and take that batch's
processing time.  They hold the same timer, and Spark fires equal timers in the
same batch.

A pane that is pending when the watermark passes its window end is the
window's closing pane and does not wait for its delay: a pending pane's timer
looks at the watermark every ``poll_ms`` (at most the delay) and fires then, once
per (window, slot), however many drivers it has.  Spark does not drop late rows
in processing-time mode, so the handler drops rows whose window the watermark
has already passed.  The sum of a key's deltas equals its final total (tested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..config import StatsParams, ship_package
from ..operators.aggregate import average_rating, tumbling
from ..schemas import TOTALS

#: Slots per window: the most tasks one window's drivers are spread over.
SLOTS = 32

#: Parts a slot holds before they are added up to one, so its state is bounded by its drivers.
MOST_PARTS = 64

CLOCK = T.StructType([T.StructField("opened_ms", T.LongType()), T.StructField("parts", T.LongType())])
PART = T.StructType([T.StructField("drivers", T.BinaryType())])
DELTA_OUT = T.StructType(
    [T.StructField("interval_start_ms", T.LongType()),
     T.StructField("interval_end_ms", T.LongType()),
     T.StructField("pane_opened_ms", T.LongType()),
     T.StructField("pane_fired_ms", T.LongType()),
     T.StructField("closing", T.BooleanType()),
     T.StructField("drivers", T.BinaryType())])


def pack(drivers) -> bytes:
    """Rows of ``driver_id`` and the totals as bytes: count, totals by column, lengths of the ids
    (-1: null), ids."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = pc.cast(drivers["driver_id"], pa.binary())
    sizes = pc.fill_null(pc.binary_length(ids), -1).to_numpy().astype(np.int32)
    sums = [drivers[c].to_numpy().astype(np.int64).tobytes() for c in TOTALS]
    return b"".join([np.int64(len(sizes)).tobytes(), *sums, sizes.tobytes(),
                     *pc.fill_null(ids, b"").to_pylist()])


def unpack(parts):
    """The rows of packed parts, as one table."""
    import numpy as np
    import pyarrow as pa

    sums, sizes, ids = [], [], []
    for p in parts:
        n = int(np.frombuffer(p, np.int64, 1)[0])
        sums.append(np.frombuffer(p, np.int64, len(TOTALS) * n, 8).reshape(len(TOTALS), n))
        at = 8 + 8 * len(TOTALS) * n
        sizes.append(np.frombuffer(p, np.int32, n, at))
        ids.append(bytes(p[at + 4 * n:]))
    sums = np.concatenate([np.zeros((len(TOTALS), 0), np.int64), *sums], 1)
    sizes = np.concatenate([np.zeros(0, np.int32), *sizes])
    off = np.r_[0, np.cumsum(np.maximum(sizes, 0))].astype(np.int64)
    valid = pa.array(sizes >= 0).buffers()[1]
    names = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(off), pa.py_buffer(b"".join(ids)), valid)
    return pa.table([names.cast(pa.string()), *[pa.array(s) for s in sums]], names=["driver_id", *TOTALS])


def added(parts):
    """One row per driver of packed parts, totals added up."""
    import pyarrow as pa

    g = unpack(parts).group_by("driver_id").aggregate([(c, "sum") for c in TOTALS])
    return pa.table([g["driver_id"], *[g[f"{c}_sum"] for c in TOTALS]], names=["driver_id", *TOTALS])


def keep(state, held: int, new: list) -> int:
    """Add parts to a slot's list of ``held`` parts; how many it has then."""
    if held >= MOST_PARTS:
        state.put([(pack(added([*held_parts(state, held), *new])),)])
        return 1
    state.appendValue((new[0] if len(new) == 1 else pack(added(new)),))
    return held + 1


def held_parts(state, held: int) -> list:
    return [p[0] for p in state.get()] if held else []


def unpacked(batches, names):
    """Rows with packed ``drivers`` -> one row per driver, the other ``names`` repeated."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for i in range(b.num_rows):
            t = unpack([b.column("drivers")[i].as_py()])
            at = pa.array(np.full(t.num_rows, i))
            t = pa.table([*[b.column(n).take(at) for n in names], *t.columns], names=[*names, *t.column_names])
            yield from t.to_batches(max_chunksize=10_000)


def unpack_drivers(fired: DataFrame) -> DataFrame:
    names = [f.name for f in fired.schema if f.name != "drivers"]
    schema = T.StructType([*[f for f in fired.schema if f.name != "drivers"], T.StructField("driver_id", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in TOTALS]])
    return fired.mapInArrow(lambda it: unpacked(it, names), schema)


class PaneDeltas(StatefulProcessor):
    """Per (window, slot): accumulate the drivers of a pane, fire them together
    ``delay_ms`` after the window's first element (processing time) or once
    the window has closed, then wait for the next pane."""

    def __init__(self, delay_ms: int, poll_ms: int):
        self.delay_ms = int(delay_ms)
        self.poll_ms = min(int(poll_ms), self.delay_ms)

    def init(self, handle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", CLOCK)
        self.drivers = handle.getListState("drivers", PART)

    # Every state access is a call to the JVM state server: a few per slot and batch.
    def handleInputRows(self, key, rows, timerValues):
        if key[1] <= timerValues.getCurrentWatermarkInMs():
            for _ in rows:  # late: the window has closed (allowed lateness 0)
                pass
            return iter([])
        new = [r["drivers"] for r in rows if r["drivers"] is not None]
        clock = self.clock.get()
        opened, held = clock or (timerValues.getCurrentProcessingTimeInMs(), 0)
        if clock is None:
            self.handle.registerTimer(opened + self.poll_ms)
        if clock is None or new:
            self.clock.update((opened, keep(self.drivers, held, new) if new else held))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        clock = self.clock.get()
        if clock is None:
            return iter([])
        now, due = expiredTimerInfo.getExpiryTimeInMs(), clock[0] + self.delay_ms
        closing = key[1] <= timerValues.getCurrentWatermarkInMs()
        if now < due and not closing:
            self.handle.registerTimer(min(due, timerValues.getCurrentProcessingTimeInMs() + self.poll_ms))
            return iter([])
        # One slot's share of a window's drivers.
        fired = [Row(interval_start_ms=key[0], interval_end_ms=key[1], pane_opened_ms=clock[0], pane_fired_ms=now,
                     closing=closing, drivers=pack(added(held_parts(self.drivers, clock[1]))))] if clock[1] else []
        self.drivers.clear()
        self.clock.clear()
        return iter(fired)

    def close(self) -> None:
        pass


PANE_KEYS = ("driver_id", "interval_start_ms", "interval_end_ms")


# Keys a task holds before it sends its partial sums on.
COMBINE_KEYS = 50_000


def _combine_batches(batches, max_keys: int = COMBINE_KEYS, keys: tuple = PANE_KEYS):
    """Map-side combine: sum the totals per key over the batches of a task.

    Holds at most ``max_keys`` keys and one batch; beyond that the partial
    sums are sent on and collected anew."""
    import pyarrow as pa

    names = [*keys, *TOTALS]

    def combined(parts):
        g = pa.concat_tables(parts).group_by(list(keys)).aggregate([(c, "sum") for c in TOTALS])
        return pa.Table.from_arrays(
            [g.column(k) for k in keys] + [g.column(f"{c}_sum") for c in TOTALS], names=names)

    held = None
    for b in batches:
        if b.num_rows == 0:
            continue
        # Plain arrays: a batch's fields may be declared not null, the sums are not.
        t = pa.Table.from_arrays([b.column(n) for n in names], names=names)
        held = combined([t] if held is None else [held, t])
        if held.num_rows >= max_keys:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


def _combine_with_ticks(batches, keys: tuple = PANE_KEYS):
    """``_combine_batches``, and one row with ``tick`` per window that the task sees."""
    import pyarrow as pa
    import pyarrow.compute as pc

    window, seen = list(PANE_KEYS[1:]), set()
    for b in _combine_batches(batches, keys=keys):
        t = pa.Table.from_batches([b])
        yield from t.append_column("tick", pa.array([False] * t.num_rows)).to_batches()
        new = [w for w in t.select(window).group_by(window).aggregate([]).to_pylist()
               if (w["interval_start_ms"], w["interval_end_ms"]) not in seen]
        seen.update((w["interval_start_ms"], w["interval_end_ms"]) for w in new)
        if new:
            zeros = pa.array([0] * len(new), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(new), pa.string()), *[pa.array([w[c] for w in new], pa.int64()) for c in window],
                 *[zeros] * (len(keys) - 3 + len(TOTALS)), pc.equal(zeros, 0)], names=[*keys, *TOTALS, "tick"])


SLOT_KEYS = (*PANE_KEYS, "slot")
PACKED = T.StructType([T.StructField(c, T.LongType()) for c in SLOT_KEYS[1:]] + PART.fields)


def _packed(batches, slots: int, ticks: bool):
    """Partial sums of a task, one packed row per window and slot; a tick goes to every slot, without drivers."""
    import numpy as np
    import pyarrow as pa

    to = list(SLOT_KEYS[1:])
    for b in _combine_with_ticks(batches, SLOT_KEYS) if ticks else _combine_batches(batches, keys=SLOT_KEYS):
        t = pa.Table.from_batches([b])
        if ticks and t["tick"][0].as_py():
            n = t.num_rows
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.repeat(t[c].to_numpy(), slots)) for c in to[:2]], pa.array(np.tile(np.arange(slots), n)),
                 pa.nulls(n * slots, pa.binary())], names=PACKED.names)
            continue
        t = t.sort_by([(c, "ascending") for c in to]).combine_chunks()
        at = np.stack([t[c].to_numpy() for c in to])
        first = np.flatnonzero(np.r_[True, (at[:, 1:] != at[:, :-1]).any(0)])
        parts = [pack(t.slice(a, z - a)) for a, z in zip(first, [*first[1:], t.num_rows])]
        yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in at], pa.array(parts, pa.binary())],
                                         names=PACKED.names)


def packed_slots(event_stats: DataFrame, interval: str, slots: int, ticks: bool = False) -> DataFrame:
    """The partial sums of an event stream, packed per (window, slot).

    Aggregated before the shuffle: the stateful operator gets one row per slot and
    task (or COMBINE_KEYS keys), so a driver holding a third of all events
    sends a few partial sums, not a third of the rows, to its task."""
    w = tumbling(interval)
    keyed = event_stats.select(
        "driver_id",
        F.unix_millis(w.start).alias("interval_start_ms"),
        F.unix_millis(w.end).alias("interval_end_ms"),
        F.expr(f"pmod(xxhash64(driver_id), {int(slots)})").alias("slot"),
        *TOTALS)
    return keyed.mapInArrow(lambda it: _packed(it, int(slots), ticks), PACKED)


def pickle_by_value(*modules: str) -> None:
    # A processor is also unpickled by a driver-side Python runner that does
    # not see addPyFile; it only needs pyspark, so ship its module by value.
    import sys

    from pyspark import cloudpickle

    for m in modules:
        cloudpickle.register_pickle_by_value(sys.modules[m])


def pane_deltas(event_stats: DataFrame, params: StatsParams, delay_seconds: float,
                poll_seconds: float | None = None, slots: int = SLOTS) -> DataFrame:
    """Delta rows of every fired pane (streaming input with a watermark).

    ``pane_opened_at`` and ``pane_fired_at`` are the same for all drivers of a
    pane; ``closing`` marks a pane that was fired because its window had closed.
    ``poll_seconds`` (default: a tenth of the delay, one second at least) is
    how often a pending pane looks whether its window has closed.  ``slots`` is
    how many keys a window's drivers are dealt to; it is fixed with the checkpoint."""
    poll = max(1.0, delay_seconds / 10) if poll_seconds is None else poll_seconds
    ship_package(event_stats.sparkSession)
    pickle_by_value(__name__)
    packed = packed_slots(event_stats, params.interval, slots, ticks=True)
    out = unpack_drivers(packed.groupBy(*SLOT_KEYS[1:]).transformWithState(
        PaneDeltas(int(delay_seconds * 1000), int(poll * 1000)), DELTA_OUT, "Append", "ProcessingTime"))
    return out.select(
        "driver_id",
        F.timestamp_millis("interval_start_ms").alias("interval_start"),
        F.timestamp_millis("interval_end_ms").alias("interval_end"),
        F.timestamp_millis("pane_opened_ms").alias("pane_opened_at"),
        F.timestamp_millis("pane_fired_ms").alias("pane_fired_at"),
        "closing",
        *TOTALS,
        average_rating(F.col("total_rating"), F.col("number_of_ratings")).alias("avg_rating"))


def sum_deltas(deltas: DataFrame) -> DataFrame:
    """Totals per (driver, window) from its deltas (invariant: = final result)."""
    g = deltas.groupBy("driver_id", "interval_start", "interval_end").agg(
        *[F.sum(c).alias(c) for c in TOTALS])
    return g.select("driver_id", "interval_start", "interval_end", "total_drop_offs",
                    "total_driver_cancels", "total_distance", "total_price", "total_tips",
                    average_rating(F.col("total_rating"), F.col("number_of_ratings")).alias("avg_rating"))
