"""Accumulating firings on the watermark trigger (W6) and the watermark that
an event dated ahead cannot move (T2)."""

from conftest import at
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams, run_dir
from fleetpulse.operators.events import widen
from fleetpulse.plans import live
from fleetpulse.sources import topics
from fleetpulse.streaming import runner

P10S = StatsParams(interval_seconds=10)


def _fire(spark, name, batches, **kw):
    """(driver, start second, firing, ratings, total) of the firings; one run per batch from one checkpoint."""
    base = run_dir(spark, name)
    log, out = f"{base}/log", f"{base}/firings"
    rows = [topics.encode_events(widen({"rated": spark.createDataFrame(b, S.with_source_ts(S.RATED))}), P10S)
            for b in batches]
    for raw in [*rows, runner.end_of_input(spark, P10S)]:
        topics.write_topic_log(raw.coalesce(1), log)
        src = topics.read_topic_log(spark, log, stream=True)
        runner.await_done(runner.start_append(live.live_firings(src, P10S, slots=4, **kw), out, f"{base}/ckpt",
                                              state_partitions=2), 120)
    got = spark.read.parquet(out).selectExpr("driver_id", "unix_seconds(interval_start) AS s", "firing",
                                             "number_of_ratings AS n", "total_rating AS t")
    base_s = int(at(0).timestamp())
    return sorted((r.driver_id, r.s - base_s, r.firing, r.n, r.t) for r in got.collect())


LATE = [[("d1", "r", "j", 1, at(5), at(5)), ("d9", "r", "j", 5, at(100), at(100))],
        [("d1", "r", "j", 3, at(6), at(25)), ("d2", "r", "j", 4, at(7), at(26))],
        [("d1", "r", "j", 2, at(8), at(27))]]


def test_late_rows_fire_again_with_accumulated_totals(spark):
    assert _fire(spark, "test-firings-late", LATE, lateness_seconds=120) == [
        ("d1", 0, "late", 2, 4), ("d1", 0, "late", 3, 6), ("d1", 0, "on_time", 1, 1),
        ("d2", 0, "late", 1, 4), ("d9", 100, "on_time", 1, 5)]


def test_without_lateness_a_window_fires_once(spark):
    assert _fire(spark, "test-firings-none", LATE) == [("d1", 0, "on_time", 1, 1), ("d9", 100, "on_time", 1, 5)]


def test_an_event_dated_ahead_makes_no_other_late(spark):
    batches = [[("d1", "r", "j", 5, at(5), at(5)), ("dx", "r", "j", 3, at(5000), at(6))],
               [("d1", "r", "j", 4, at(8), at(9))]]
    dated = ("dx", 5000, "on_time", 1, 3)
    assert _fire(spark, "test-firings-ahead", batches) == [("d1", 0, "on_time", 2, 9), dated]
    # A watermark that follows the event time loses the second rating.
    assert _fire(spark, "test-firings-unbounded", batches, ahead_seconds=10**6) == [("d1", 0, "on_time", 1, 5), dated]
