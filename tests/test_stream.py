"""Streaming forms: J1 append (W4), late data (W3), update mode (W6), pane
deltas (W5) and progress reports (O1-O3), over parquet topic logs."""

import time

from conftest import GOLDEN, at, golden_frames, utc_rows
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams, run_dir
from fleetpulse.operators.events import widen
from fleetpulse.plans import live
from fleetpulse.sources import topics
from fleetpulse.streaming import panes, runner

P10S = StatsParams(interval_seconds=10)


def _encoded(spark, frames):
    return topics.encode_events(widen(frames), P10S)


def _arrive_at_event_time(rated, tipped, journeys):
    return (rated.withColumn("source_ts", rated.rated_at),
            tipped.withColumn("source_ts", tipped.tipped_at),
            journeys.withColumn("source_ts", journeys.ended_at))


def _rated(spark, rows):
    return spark.createDataFrame(rows, S.with_source_ts(S.RATED))


def test_live_job_gives_golden_rows_once_input_ends(spark):
    base = run_dir(spark, "test-live")
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    log = f"{base}/log"
    topics.write_topic_log(_encoded(spark, {"rated": r, "tipped": t, "journey": j}).coalesce(1), log)
    topics.write_topic_log(runner.end_of_input(spark, P10S).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
    q = runner.start_append(live.live_job(src, P10S), f"{base}/out", f"{base}/ckpt", state_partitions=4)
    runner.await_done(q, 300)
    out = topics.decode_stats(topics.read_topic_log(spark, f"{base}/out"), P10S).drop("source_ts")
    assert utc_rows(out) == GOLDEN
    # O2/O3: the last (no-data) batch closed all three windows past the watermark
    rep = runner.progress_report(q)
    totals = runner.Totals()
    totals.update(q)
    assert totals.counts["closed_windows"] == 3 and totals.counts["late_rows"] == 0
    assert totals.counts["payloads"] == 10 and totals.counts["malformed"] == 0
    assert rep["closed_windows"] == 3 and rep["state_rows"] >= 1   # the marker's window stays open
    assert rep["watermark"].startswith("8999-12-31T23:59:40")


def test_append_without_end_of_input_keeps_windows_open(spark):
    base = run_dir(spark, "test-live-open")
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    log = f"{base}/log"
    topics.write_topic_log(_encoded(spark, {"rated": r, "tipped": t, "journey": j}).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True)
    q = runner.start_append(live.live_job(src, P10S), f"{base}/out", f"{base}/ckpt", state_partitions=4)
    runner.await_done(q, 300)
    # watermark = 12 s - 20 s: no window has closed yet, nothing is final
    assert topics.read_topic_log(spark, f"{base}/out").count() == 0


def test_late_events_are_dropped_after_their_window_closed(spark):
    """W3 across a restart from the checkpoint: the first run closes [0, 10)
    (watermark 80 s); in the second run a rating for 6 s is late and dropped,
    one for 95 s lands in a still open window."""
    base = run_dir(spark, "test-late")
    log, out, ckpt = f"{base}/log", f"{base}/out", f"{base}/ckpt"
    first = _rated(spark, [("d1", "r", "j", 1, at(5), at(5)), ("d1", "r", "j", 5, at(100), at(100))])
    # arrives at 25 s: passes the 20 s skew check, but its window has closed
    second = _rated(spark, [("d1", "r", "j", 3, at(6), at(25)), ("d1", "r", "j", 3, at(95), at(101))])

    def run():
        src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
        q = runner.start_append(live.live_stats(src, P10S), out, ckpt, state_partitions=4)
        runner.await_done(q, 300)
        return q

    topics.write_topic_log(_encoded(spark, {"rated": first}).coalesce(1), log)
    run()
    topics.write_topic_log(_encoded(spark, {"rated": second}).coalesce(1), log)
    topics.write_topic_log(runner.end_of_input(spark, P10S).coalesce(1), log)
    q = run()
    got = sorted((r.interval_start, r.avg_rating) for r in spark.read.parquet(out).collect())
    assert [(s.replace(tzinfo=None).second + 60 * s.minute, a) for s, a in got] == \
        [(0, 1.0), (90, 3.0), (100, 5.0)]
    dropped = sum(sum(o.get("numRowsDroppedByWatermark", 0) for o in (p.get("stateOperators") or []))
                  for p in q.recentProgress)
    assert dropped >= 1


def test_update_mode_last_values_equal_final_totals(spark):
    base = run_dir(spark, "test-update")
    log = f"{base}/log"
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    topics.write_topic_log(_encoded(spark, {"rated": r}).coalesce(1), log)
    topics.write_topic_log(_encoded(spark, {"tipped": t, "journey": j}).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
    q = runner.start_update(live.live_stats(src, P10S), f"{base}/upd", f"{base}/ckpt", state_partitions=4)
    runner.await_done(q, 300)
    upd = spark.read.parquet(f"{base}/upd")
    # driver-1's first window was emitted in both batches (running totals)
    assert upd.filter("driver_id = 'driver-1'").count() >= 3
    final = runner.last_per_key(upd, ["driver_id", "interval_start", "interval_end"])
    assert utc_rows(final) == GOLDEN


def test_skew_and_decode_metrics_reach_progress(spark):
    base = run_dir(spark, "test-progress")
    log = f"{base}/log"
    rows = _rated(spark, [("d", "r", "j", 1, at(0), at(0)), ("d", "r", "j", 2, at(0), at(21))])
    raw = _encoded(spark, {"rated": rows}).unionByName(
        spark.createDataFrame([(b"\xff\xff", "input/driver_rated", at(0))], S.RAW_TOPIC))
    topics.write_topic_log(raw.coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True)
    q = runner.start_update(live.live_stats(src, P10S), f"{base}/upd", f"{base}/ckpt", state_partitions=4)
    runner.await_done(q, 300)
    observed = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")]
    assert observed, "no observed metrics in progress"
    m = observed[0]
    assert m["skew"]["seen"] == 2 and m["skew"]["dropped_for_skew"] == 1
    assert m["decode"]["payloads"] == 3 and m["decode"]["malformed"] == 1


def test_pane_deltas_fire_repeatedly_and_sum_to_totals(spark):
    base = run_dir(spark, "test-panes")
    log = f"{base}/log"
    p = StatsParams(interval_seconds=3600)
    first = _rated(spark, [("d1", "r", "j", 2, at(1), at(1)), ("d1", "r", "j", 4, at(2), at(2))])
    second = _rated(spark, [("d1", "r", "j", 5, at(3), at(3))])
    topics.write_topic_log(topics.encode_events(widen({"rated": first}), p).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
    q = runner.start_append(live.live_pane_deltas(src, p, delay_seconds=1), f"{base}/deltas",
                            f"{base}/ckpt", trigger={"processingTime": "300 milliseconds"},
                            state_partitions=2)

    def fired():
        try:
            return spark.read.parquet(f"{base}/deltas").count()
        except Exception:  # noqa: BLE001 - sink not written yet
            return 0

    deadline = time.time() + 120
    while fired() < 1 and time.time() < deadline:
        time.sleep(0.5)
    assert fired() == 1
    topics.write_topic_log(topics.encode_events(widen({"rated": second}), p).coalesce(1), log)
    while fired() < 2 and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    deltas = spark.read.parquet(f"{base}/deltas")
    rows = sorted((r.number_of_ratings, r.total_rating, r.avg_rating) for r in deltas.collect())
    assert rows == [(1, 5, 5.0), (2, 6, 3.0)]          # each pane holds only its own events
    total = panes.sum_deltas(deltas).collect()[0]
    assert abs(total.avg_rating - 11 / 3) < 1e-6


def test_live_command_line_once(spark):
    from fleetpulse.__main__ import main

    base = run_dir(spark, "test-cli-live")
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    log = f"{base}/log"
    topics.write_topic_log(_encoded(spark, {"rated": r, "tipped": t, "journey": j}).coalesce(1), log)
    topics.write_topic_log(runner.end_of_input(spark, P10S).coalesce(1), log)
    assert main(["live", "--source", log, "--sink", f"{base}/out", "--checkpoint", f"{base}/ckpt",
                 "--interval", "10", "--once", "--max-files-per-trigger", "1",
                 "--state-partitions", "2"]) == 0
    out = topics.decode_stats(topics.read_topic_log(spark, f"{base}/out"), P10S).drop("source_ts")
    assert utc_rows(out) == GOLDEN


def test_all_drivers_of_a_pane_fire_together(spark):
    """The window's first element of any driver starts the clock: drivers that come in a
    later micro-batch, in other slots, leave with the first one."""
    base = run_dir(spark, "test-pane-clock")
    log = f"{base}/log"
    p = StatsParams(interval_seconds=3600)
    first = _rated(spark, [("d0", "r", "j", 5, at(1), at(1))])
    second = _rated(spark, [(f"d{i}", "r", "j", 3, at(2), at(2)) for i in range(1, 12)])
    topics.write_topic_log(topics.encode_events(widen({"rated": first}), p).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
    q = runner.start_append(live.live_pane_deltas(src, p, delay_seconds=8, slots=4), f"{base}/deltas", f"{base}/ckpt",
                            trigger={"processingTime": "300 milliseconds"}, state_partitions=2)
    deadline = time.time() + 60
    while not (q.lastProgress and q.lastProgress["numInputRows"]) and time.time() < deadline:
        time.sleep(0.1)
    topics.write_topic_log(topics.encode_events(widen({"rated": second}), p).coalesce(1), log)
    runner.await_quiet(q, 12, 180)
    rows = spark.read.parquet(f"{base}/deltas").collect()
    assert sorted(r.driver_id for r in rows) == sorted(f"d{i}" for i in range(12))
    assert len({(r.pane_opened_at, r.pane_fired_at) for r in rows}) == 1 and not any(r.closing for r in rows)


def test_a_window_ticks_once_per_task_in_every_slot():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "driver_id": ["a", "b", None], "interval_start_ms": [0, 0, 10], "interval_end_ms": [10, 10, 20],
        **{c: [1, 2, 3] for c in panes.TOTALS}})
    out = pa.Table.from_batches(list(panes._combine_with_ticks([batch, batch]))).to_pylist()
    assert sorted((r["interval_start_ms"], r["total_rating"]) for r in out if not r["tick"]) == [(0, 2), (0, 4), (10, 6)]
    assert sorted((r["interval_start_ms"], r["driver_id"], r["total_rating"]) for r in out if r["tick"]) == \
        [(0, None, 0), (10, None, 0)]


def test_pane_deltas_drop_late_rows(spark):
    """W5 keeps allowed lateness 0: after the watermark passed [0, 10), a
    rating for 6 s is dropped; one for 95 s forms a pane of its own."""
    base = run_dir(spark, "test-panes-late")
    log, out, ckpt = f"{base}/log", f"{base}/deltas", f"{base}/ckpt"
    first = _rated(spark, [("d1", "r", "j", 1, at(5), at(5)), ("d1", "r", "j", 5, at(100), at(100))])
    second = _rated(spark, [("d1", "r", "j", 3, at(6), at(25)), ("d1", "r", "j", 4, at(95), at(101))])

    def run(n_rows):
        src = topics.read_topic_log(spark, log, stream=True, max_files_per_trigger=1)
        q = runner.start_append(live.live_pane_deltas(src, P10S, delay_seconds=0.5), out, ckpt,
                                trigger={"processingTime": "300 milliseconds"}, state_partitions=2)
        runner.await_quiet(q, n_rows, 180)

    topics.write_topic_log(_encoded(spark, {"rated": first}).coalesce(1), log)
    run(2)
    topics.write_topic_log(_encoded(spark, {"rated": second}).coalesce(1), log)
    run(2)
    got = sorted((r.interval_start.replace(tzinfo=None).second + 60 * r.interval_start.minute,
                  r.number_of_ratings, r.total_rating)
                 for r in spark.read.parquet(out).collect())
    assert got == [(0, 1, 1), (90, 1, 4), (100, 1, 5)]


def test_pane_input_is_combined_per_key_before_the_shuffle():
    import pyarrow as pa

    n = 3000   # one hot (driver, window) key and one cold one
    batch = pa.RecordBatch.from_pydict({
        "driver_id": ["hot"] * n + ["cold"], "interval_start_ms": [0] * (n + 1),
        "interval_end_ms": [10] * (n + 1),
        **{c: [1] * (n + 1) for c in panes.TOTALS}})
    out = pa.Table.from_batches(list(panes._combine_batches([batch]))).to_pylist()
    assert sorted((r["driver_id"], r["total_rating"]) for r in out) == [("cold", 1), ("hot", n)]
    # ... and over the batches of a task, whose fields Spark declares not null
    strict = batch.cast(pa.schema([f.with_nullable(f.name not in panes.TOTALS) for f in batch.schema]))
    out = pa.Table.from_batches(list(panes._combine_batches([strict, batch, strict]))).to_pylist()
    assert sorted((r["driver_id"], r["total_rating"]) for r in out) == [("cold", 3), ("hot", 3 * n)]
    assert len(list(panes._combine_batches([strict, strict], max_keys=1))) == 2


def test_backfill_by_slice_restarts_per_slice(spark):
    base = run_dir(spark, "test-backfill")
    log, out, ckpt = f"{base}/log", f"{base}/out", f"{base}/ckpt"
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    raw = _encoded(spark, {"rated": r, "tipped": t, "journey": j})

    def run_once():
        src = topics.read_topic_log(spark, log, stream=True)
        return runner.start_append(live.live_job(src, P10S), out, ckpt, state_partitions=2)

    # 5-second arrival slices: the golden events arrive at 0-2 s and at 12 s,
    # so two slice runs and one run for the end marker
    runs = runner.backfill_by_slice(raw, log, f"{base}/staging", 5, run_once,
                                    end_marker=runner.end_of_input(spark, P10S))
    assert runs == 3
    got = topics.decode_stats(topics.read_topic_log(spark, out), P10S).drop("source_ts")
    assert utc_rows(got) == GOLDEN


def test_closing_pane_does_not_wait_for_its_delay(spark):
    """A pane pending when the watermark passes its window fires then: the delay
    is ten minutes, the test ends in seconds."""
    base = run_dir(spark, "test-closing")
    log, out = f"{base}/log", f"{base}/deltas"
    rows = _rated(spark, [("d1", "r", "j", 4, at(5), at(5)), ("d1", "r", "j", 5, at(100), at(100))])
    topics.write_topic_log(_encoded(spark, {"rated": rows}).coalesce(1), log)
    src = topics.read_topic_log(spark, log, stream=True)
    q = runner.start_append(live.live_pane_deltas(src, P10S, delay_seconds=600, poll_seconds=0.5), out,
                            f"{base}/ckpt", trigger={"processingTime": "1 second"}, state_partitions=2)
    deadline, got = time.time() + 90, []
    while not got and time.time() < deadline:
        time.sleep(0.5)
        try:
            got = spark.read.parquet(out).collect()
        except Exception:  # noqa: BLE001 - sink not written yet
            pass
    runner.stop_idle(q)
    # [0, 10) closed at watermark 80 s; [100, 110) is still open and pending
    assert [(r.number_of_ratings, r.total_rating) for r in got] == [(1, 4)]


def test_instants_out_of_range_do_not_stop_the_stream(spark):
    """Payloads that parse but whose instants lie outside the Timestamp range are
    malformed; the good rows beside them are counted."""
    from fleetpulse.functions.codec import message_classes

    base = run_dir(spark, "test-range")
    bad = []
    for seconds, nanos in [(10**13, 0), (10**15, 0), (10**18, 0), (-10**18, 0), (253402300800, 0),
                           (0, -1), (0, 10**9)]:
        m = message_classes()["DriverRated"](driver_id="d", rider_id="r", journey_id="j", rating=1)
        m.rated_at.seconds, m.rated_at.nanos = seconds, nanos
        bad.append((m.SerializeToString(), "input/driver_rated", at(0)))
    good = _encoded(spark, {"rated": _rated(spark, [("d", "r", "j", 3, at(0), at(0))])})
    topics.write_topic_log(good.unionByName(spark.createDataFrame(bad, S.RAW_TOPIC)).coalesce(1), f"{base}/log")
    src = topics.read_topic_log(spark, f"{base}/log", stream=True)
    q = runner.start_update(live.live_stats(src, P10S), f"{base}/upd", f"{base}/ckpt", state_partitions=2)
    runner.await_done(q)
    totals = runner.Totals()
    totals.update(q)
    assert totals.counts["payloads"] == len(bad) + 1 and totals.counts["malformed"] == len(bad)
    assert [r.avg_rating for r in spark.read.parquet(f"{base}/upd").collect()] == [3.0]


def test_a_repeated_update_batch_overwrites_its_folder(spark):
    base = run_dir(spark, "test-update-again")
    r, _, _ = _arrive_at_event_time(*golden_frames(spark))
    topics.write_topic_log(_encoded(spark, {"rated": r}).coalesce(1), f"{base}/log")
    for ckpt in ("a", "b"):      # two checkpoints: batch 0 is written twice to one sink
        src = topics.read_topic_log(spark, f"{base}/log", stream=True)
        runner.await_done(runner.start_update(live.live_stats(src, P10S), f"{base}/upd", f"{base}/{ckpt}",
                                              state_partitions=2))
    upd = spark.read.parquet(f"{base}/upd")
    assert upd.filter("batch_id = 0").count() == 2


def test_backfill_refuses_a_log_that_has_ended(spark):
    import pytest

    base = run_dir(spark, "test-ended")
    topics.write_topic_log(runner.end_of_input(spark, P10S), f"{base}/log")
    raw = topics.read_topic_log(spark, f"{base}/log")
    with pytest.raises(ValueError, match="end-of-input"):
        runner.backfill_by_slice(raw, f"{base}/log", f"{base}/staging", 5, lambda: None)


def test_kafka_arguments():
    from fleetpulse.__main__ import _params, parser
    from fleetpulse.sources.topics import input_topics

    a = parser().parse_args(["live", "--kafka", "h:1", "--sink-kafka", "h:2", "--topic", "rated=my.rated"])
    p = _params(a)
    assert list(input_topics(p)) == ["my.rated", "input.driver_tipped", "input.journey_finished"]
    assert p.topics["stats"] == "output.driver_stats" and a.sink_kafka == "h:2" and a.sink is None
    b = parser().parse_args(["feed", "--source", "/x", "--sink", "/y"])
    assert _params(b).topics["rated"] == "input/driver_rated"


def test_kafka_reader_and_live_subscription(monkeypatch):
    """The options handed to the reader; no broker is started."""
    from types import SimpleNamespace

    from fleetpulse import __main__ as M

    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def load(self):
            return self

        def select(self, *cols):
            seen["columns"] = cols
            return self

    a = M.parser().parse_args(["live", "--kafka", "h:1", "--sink", "/o", "--max-offsets-per-trigger", "7"])
    p = M._params(a)
    M._source(SimpleNamespace(readStream=Reader()), a, p, list(topics.input_topics(p)))
    assert seen["format"] == "kafka" and seen["kafka.bootstrap.servers"] == "h:1"
    assert seen["subscribe"] == "input.driver_rated,input.driver_tipped,input.journey_finished"
    assert seen["maxOffsetsPerTrigger"] == 7 and seen["columns"] == ("value", "topic", "timestamp")


def _events(spark, seconds_late):
    """Ratings that arrive so many seconds after they were given."""
    rows = [(f"driver-{i}", "b", "c", 3, at(0), at(late)) for i, late in enumerate(seconds_late)]
    return _encoded(spark, {"rated": _rated(spark, rows)})


def _split(spark, log, sink, checkpoint):
    from fleetpulse.plans import stats

    es = stats.event_stats(topics.decode_events(topics.read_topic_log(spark, log, stream=True), P10S), P10S,
                           skew_check=False)
    runner.await_done(runner.start_skew_split(es, sink, checkpoint, P10S.skew_seconds))


def test_kept_and_dropped_events_are_the_input_even_when_a_batch_runs_again(spark):
    base = run_dir(spark, "test-split")
    topics.write_topic_log(_events(spark, [0, 20, 21, 300]).coalesce(1), f"{base}/log")
    for checkpoint in ("a", "b"):       # two checkpoints: batch 0 runs twice into one sink
        _split(spark, f"{base}/log", f"{base}/out", f"{base}/{checkpoint}")
    topics.write_topic_log(_events(spark, [5, 50]).coalesce(1), f"{base}/log")
    _split(spark, f"{base}/log", f"{base}/out", f"{base}/b")
    late = lambda side: sorted((r.source_ts - r.event_time).total_seconds()
                               for r in runner.skew_side(spark, f"{base}/out", side).collect())
    assert late(False) == [0, 5, 20] and late(True) == [21, 50, 300]
    plan = runner.skew_side(spark, f"{base}/out", True)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_open_windows_come_from_the_state_of_the_job(spark):
    base = run_dir(spark, "test-open")
    r, t, j = _arrive_at_event_time(*golden_frames(spark))
    topics.write_topic_log(_encoded(spark, {"rated": r, "tipped": t, "journey": j}).coalesce(1), f"{base}/log")
    late = [("driver-9", "b", "c", 3, at(31), at(31))]     # moves the watermark to 11 s: the first window closes
    for rows in (None, late):
        if rows:
            topics.write_topic_log(_encoded(spark, {"rated": _rated(spark, rows)}).coalesce(1), f"{base}/log")
        src = topics.read_topic_log(spark, f"{base}/log", stream=True)
        runner.await_done(runner.start_append(live.live_job(src, P10S), f"{base}/out", f"{base}/ckpt", state_partitions=2))
        got = sorted((r.interval_start.timestamp() - at(0).timestamp(), r.drivers, r.watermark.timestamp() - at(0).timestamp())
                     for r in runner.open_windows(spark, f"{base}/ckpt").collect())
        assert got == ([(0, 2, -8), (10, 1, -8)] if rows is None else [(10, 1, 11), (30, 1, 11)])


class _State:
    """A state variable that counts its calls."""
    def __init__(self, calls):
        self.calls, self.value = calls, None

    def get(self):
        self.calls.append("get")
        return iter(self.value or []) if isinstance(self.value, list) else self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    put = update

    def appendValue(self, value):
        self.calls.append("append")
        self.value = [*(self.value or []), value]

    def clear(self):
        self.value = None


def test_state_calls_count_slots_and_batches_not_drivers():
    from types import SimpleNamespace

    import pyarrow as pa
    from fleetpulse.streaming.firings import WatermarkFirings

    def part(drivers):
        return panes.pack(pa.table({"driver_id": pa.array(drivers, pa.string()),
                                    **{c: pa.array(range(len(drivers)), pa.int64()) for c in panes.TOTALS}}))

    many, calls = [None, "é", ""] + [f"d{i}" for i in range(3000)], []
    handle = SimpleNamespace(getValueState=lambda *a: _State(calls), getListState=lambda *a: _State(calls),
                             registerTimer=lambda at: calls.append("timer"))
    timers = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0, getCurrentProcessingTimeInMs=lambda: 5)
    due = SimpleNamespace(getExpiryTimeInMs=lambda: 10_000)
    for processor, batches in ((panes.PaneDeltas(1000, 100), 5), (WatermarkFirings(0), 5),
                               (panes.PaneDeltas(1000, 100), 2 * panes.MOST_PARTS)):
        calls.clear()
        processor.init(handle)
        for _ in range(batches):
            assert list(processor.handleInputRows((0, 600_000, 0), iter([{"drivers": part(many)}]), timers)) == []
        assert len(calls) <= 4 * batches and len(processor.drivers.value) <= panes.MOST_PARTS
        fired, = processor.handleExpiredTimer((0, 600_000, 0), timers, due)
        rows = panes.unpack([fired.drivers]).to_pylist()
        assert len(rows) == len(many)
        assert {r["driver_id"]: r["total_price"] for r in rows} == {d: i * batches for i, d in enumerate(many)}


def test_slots_get_one_packed_row_per_window():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "driver_id": ["a", "b", None, "a"], "interval_start_ms": [0, 0, 10, 0], "interval_end_ms": [10, 10, 20, 10],
        "slot": [1, 1, 0, 1], **{c: [1, 2, 3, 4] for c in panes.TOTALS}})
    rows = [r for b in panes._packed([batch, batch], 2, False) for r in b.to_pylist()]
    got = {(r["interval_start_ms"], r["slot"]): panes.unpack([r["drivers"]]).select(["driver_id", "total_tips"]).to_pylist()
           for r in rows}
    assert len(rows) == 2 and got[10, 0] == [{"driver_id": None, "total_tips": 6}]
    assert sorted(r["total_tips"] for r in got[0, 1]) == [4, 10]
    ticks = [r for b in panes._packed([batch], 2, True) for r in b.to_pylist() if r["drivers"] is None]
    assert sorted((r["interval_start_ms"], r["slot"]) for r in ticks) == [(0, 0), (0, 1), (10, 0), (10, 1)]
