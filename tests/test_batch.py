"""Batch form of the job: golden rows of the reference and edge cases per operator."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import GOLDEN, at, golden_frames, utc_rows
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams
from fleetpulse.operators import skew, validate
from fleetpulse.operators.events import widen
from fleetpulse.plans.stats import driver_stats, driver_stats_typed

P10S = StatsParams(interval_seconds=10)


def _with_arrival(df, col):
    return df.withColumn("source_ts", F.col(col))


def test_golden_rows(spark):
    rated, tipped, journeys = golden_frames(spark)
    out = driver_stats_typed(_with_arrival(rated, "rated_at"), _with_arrival(tipped, "tipped_at"),
                             _with_arrival(journeys, "ended_at"), P10S)
    assert out.columns == list(S.STATS_COLUMNS)
    assert utc_rows(out) == GOLDEN


def test_golden_rows_without_arrival_time(spark):
    # The history job: no source timestamps, no skew filter.
    rated, tipped, journeys = golden_frames(spark)
    out = driver_stats_typed(rated, tipped, journeys, P10S, skew_check=False, validated=False)
    assert utc_rows(out) == GOLDEN


def test_result_types(spark):
    rated, tipped, journeys = golden_frames(spark)
    out = driver_stats_typed(rated, tipped, journeys, P10S, skew_check=False)
    assert out.schema == S.DRIVER_STATS or [f.dataType for f in out.schema] == \
        [f.dataType for f in S.DRIVER_STATS]


def _rated(spark, rows):
    return spark.createDataFrame(rows, S.with_source_ts(S.RATED))


def test_validation_reasons(spark):
    rated = _rated(spark, [
        ("d", "r", "j", 3, at(0), at(0)),
        ("d", "r", "j", 3, None, at(0)),
        ("", "r", "j", 3, at(0), at(0)),
        ("d", "r", "", 3, at(0), at(0)),
        (None, "r", "j", 3, at(0), at(0)),
    ])
    tipped = spark.createDataFrame([
        ("d", "r", "j", 5, None, at(0)),      # F2 is applied (the reference forgot)
        ("d", "r", "j", 5, at(0), at(0)),
    ], S.with_source_ts(S.TIPPED))
    journeys = spark.createDataFrame([
        ("", "r", "j", "DROP_OFF", at(-5), at(0), 1, 1, at(0)),   # blank driver is kept
        ("d", "r", "j", "DROP_OFF", None, at(0), 1, 1, at(0)),
        ("d", "r", "j", "DROP_OFF", at(-5), None, 1, 1, at(0)),
        ("d", "r", "", "DROP_OFF", at(-5), at(0), 1, 1, at(0)),
    ], S.with_source_ts(S.JOURNEY))
    wide = widen({"rated": rated, "tipped": tipped, "journey": journeys})
    reasons = sorted((r.kind, r.reject_reason) for r in validate.rejects(wide).collect())
    assert reasons == sorted([
        ("rated", "missing_rated_at"), ("rated", "empty_driver_id"),
        ("rated", "empty_journey_id"), ("rated", "empty_driver_id"),
        ("tipped", "missing_tipped_at"),
        ("journey", "missing_started_at"), ("journey", "missing_ended_at"),
        ("journey", "empty_journey_id"),
    ])
    assert validate.valid(wide).count() == 3


def test_skew_boundary_and_observation(spark):
    rated = _rated(spark, [
        ("d", "r", "j", 1, at(0), at(20)),          # exactly 20 s behind: kept
        ("d", "r", "j", 2, at(0), at(20.001)),      # 20.001 s behind: dropped
        ("d", "r", "j", 3, at(100), at(0)),         # future-dated: kept (no upper bound)
        ("d", "r", "j", 4, at(0), at(0)),
    ])
    obs = Observation("skew")
    out = driver_stats(widen({"rated": rated}), StatsParams(interval_seconds=1000), observation=obs)
    rows = out.collect()
    assert len(rows) == 1
    # kept ratings 1, 3, 4
    assert abs(rows[0].avg_rating - (1 + 3 + 4) / 3) < 1e-6
    assert obs.get == {"seen": 4, "dropped_for_skew": 1}
    dropped = skew.skew_dropped(
        widen({"rated": rated}).select("source_ts", F.col("rated_at").alias("event_time")), 20)
    assert dropped.count() == 1


def test_interval_boundary_is_left_closed(spark):
    rated = _rated(spark, [("d", "r", "j", 5, at(10), at(10)), ("d", "r", "j", 1, at(9.999), at(10))])
    out = utc_rows(driver_stats(widen({"rated": rated}), P10S).select(
        "interval_start", "interval_end", "avg_rating"))
    assert out == [(at(0), at(10), 1.0), (at(10), at(20), 5.0)]


def test_cancels_by_rider_or_admin_still_make_a_row(spark):
    journeys = spark.createDataFrame([
        ("d", "r", "j", "RIDER_CANCEL", at(-5), at(1), 7, 70, at(1)),
        ("d", "r", "j", "ADMIN_CANCEL", at(-5), at(2), 3, 30, at(2)),
        ("d", "r", "j", "UNRECOGNIZED", at(-5), at(3), 1, 1, at(3)),
    ], S.with_source_ts(S.JOURNEY))
    out = driver_stats(widen({"journey": journeys}), P10S).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.total_drop_offs, r.total_driver_cancels, r.total_distance, r.total_price,
            r.total_tips, r.avg_rating) == (0, 0, 11, 101, 0, 0.0)


def test_hot_driver_plan_is_partial_then_final(spark):
    # One driver holding most events: the plan must combine map-side.
    rated, tipped, journeys = golden_frames(spark)
    out = driver_stats_typed(rated, tipped, journeys, P10S, skew_check=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_typed_union_equals_single_scan(spark):
    from conftest import SF001
    from fleetpulse.sources.fixtures import fixture_events, fixture_typed

    p = StatsParams(interval_seconds=3600)
    t = fixture_typed(spark, SF001)
    typed = driver_stats_typed(t["rated"], t["tipped"], t["journey"], p)
    wide = driver_stats(fixture_events(spark, SF001), p)
    assert typed.count() > 0
    assert sorted(typed.collect()) == sorted(wide.collect())


def test_case_on_kind_folds_away_for_typed_inputs(spark):
    rated, tipped, journeys = golden_frames(spark)
    out = driver_stats_typed(rated, tipped, journeys, P10S, skew_check=False)
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in optimized
    assert "CASE WHEN (kind" not in optimized and "kind#" not in optimized
