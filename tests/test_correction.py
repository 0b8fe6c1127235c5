"""J3 as a correction: live statistics plus the rebuilt days equal a full rebuild."""

import os
from datetime import timedelta

from conftest import T0
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams, run_dir
from fleetpulse.operators import aggregate
from fleetpulse.operators.events import widen
from fleetpulse.plans import correction, stats
from fleetpulse.sources import topics
from fleetpulse.streaming import runner

P = StatsParams(interval_seconds=600)


def files(path):
    path = path[len("file:"):] if path.startswith("file:") else path
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_live_plus_correction_is_a_full_rebuild_and_leaves_other_days_alone(spark):
    base = run_dir(spark, "test-correction")
    events = [(f"driver-{i % 3}", "r", "j", 1 + i % 5, T0 + timedelta(hours=7 * i), T0 + timedelta(hours=7 * i, seconds=late))
              for i, late in enumerate([0, 5, 20, 0, 21, 0, 0, 300, 0, 0, 0, 0])]      # days 1 and 2 lose an event
    rated = spark.createDataFrame(events, S.with_source_ts(S.RATED))
    topics.write_topic_log(topics.encode_events(widen({"rated": rated}), P), f"{base}/log")
    es = stats.event_stats(topics.decode_events(topics.read_topic_log(spark, f"{base}/log", stream=True), P), P,
                           skew_check=False)
    runner.await_done(runner.start_skew_split(es, f"{base}/events", f"{base}/ckpt", P.skew_seconds,
                                              day=correction.day_of_interval(P)))
    kept = runner.skew_side(spark, f"{base}/events", dropped=False)
    correction.write_stats(aggregate.driver_stats(kept, P.interval), f"{base}/stats")
    full = sorted(map(tuple, stats.driver_stats(widen({"rated": rated}), P, skew_check=False).collect()))
    live = sorted(map(tuple, correction.read_stats(spark, f"{base}/stats").collect()))
    assert len(live) == 10 and len(full) == 12
    before = files(f"{base}/stats")
    days = correction.correct(spark, f"{base}/events", f"{base}/stats", P)
    assert [str(d) for d in days] == ["2020-01-02", "2020-01-03"]
    assert sorted(map(tuple, correction.read_stats(spark, f"{base}/stats").collect())) == full
    after = files(f"{base}/stats")
    same = {f for f in before if after.get(f) == before[f]}
    assert same == {f for f in before if "day=2020-01-02" not in f and "day=2020-01-03" not in f} and same
    correction.correct(spark, f"{base}/events", f"{base}/stats", P)      # again: the same
    assert sorted(map(tuple, correction.read_stats(spark, f"{base}/stats").collect())) == full
    plan = spark.read.parquet(f"{base}/events").where(f"day IN ('{days[0]}')")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters" in plan and "day" in plan
