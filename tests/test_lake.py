"""JSON lake round trip and the history rebuild."""

import json
import os

import pytest

from conftest import GOLDEN, golden_frames, utc_rows
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams, run_dir
from fleetpulse.plans import history
from fleetpulse.sources import lake


def _write_golden_lake(spark):
    root = run_dir(spark, "test-lake")
    for kind, df in zip(("rated", "tipped", "journey"), golden_frames(spark)):
        lake.write_lake(df, lake.lake_path(root, kind), kind)
    return root


def test_lake_records_are_camel_case_with_iso_instants(spark):
    root = _write_golden_lake(spark)
    d = lake.lake_path(root, "journey")
    lines = [ln for f in sorted(os.listdir(d)) if f.endswith(".json")
             for ln in open(os.path.join(d, f)).read().splitlines()]
    rec = json.loads(lines[0])
    assert set(rec) == {"driverId", "riderId", "journeyId", "finishReason", "startedAt",
                        "endedAt", "distance", "price"}
    assert rec["endedAt"].endswith("Z") and len(rec["endedAt"]) == len("2020-01-01T00:00:00.000Z")


def test_history_rebuild_gives_golden_rows(spark):
    root = _write_golden_lake(spark)
    out = history.rebuild_stats(spark, root, lake.lake_path(root, "stats"),
                                StatsParams(interval_seconds=10))
    assert utc_rows(out) == GOLDEN
    again = lake.read_lake(spark, lake.lake_path(root, "stats"), "stats")
    assert again.columns == list(S.STATS_COLUMNS)


def test_reading_accepts_offsets_and_no_millis(spark):
    root = run_dir(spark, "test-lake-text")
    d = lake.lake_path(root, "rated")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as fh:
        fh.write('{"driverId":"d","riderId":"r","journeyId":"j","rating":3,"ratedAt":"2020-01-01T01:00:05+01:00"}\n')
    row = lake.read_lake(spark, d, "rated").collect()[0]
    assert row.rated_at.isoformat().startswith("2020-01-01T00:00:05")


def test_malformed_lake_record_fails_the_job(spark):
    root = run_dir(spark, "test-lake-bad")
    d = lake.lake_path(root, "rated")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as fh:
        fh.write('{"driverId":"d","rating":"three","ratedAt":"2020-01-01T00:00:00.000Z"}\n')
    with pytest.raises(Exception):
        lake.read_lake(spark, d, "rated").collect()


def test_history_fails_on_a_record_without_instant(spark):
    root = _write_golden_lake(spark)
    d = lake.lake_path(root, "tipped")
    with open(os.path.join(d, "part-extra.json"), "w") as fh:
        fh.write('{"driverId":"d","riderId":"r","journeyId":"j","amount":3}\n')
    with pytest.raises(Exception, match="not complete and well-typed"):
        history.rebuild_stats(spark, root, None, StatsParams(interval_seconds=10)).collect()


def test_history_command_line(spark):
    from fleetpulse.__main__ import main

    root = _write_golden_lake(spark)
    assert main(["history", "--lake", root, "--interval", "10"]) == 0
    out = lake.read_lake(spark, lake.lake_path(root, "stats"), "stats")
    assert utc_rows(out) == GOLDEN


RECORDS = {
    "rated": {"driverId": "d", "riderId": "r", "journeyId": "j", "rating": 3,
              "ratedAt": "2020-01-01T00:00:05.000Z"},
    "tipped": {"driverId": "d", "riderId": "r", "journeyId": "j", "amount": 3,
               "tippedAt": "2020-01-01T00:00:05.000Z"},
    "journey": {"driverId": "d", "riderId": "r", "journeyId": "j", "finishReason": "DROP_OFF",
                "startedAt": "2020-01-01T00:00:00.000Z", "endedAt": "2020-01-01T00:00:05.000Z",
                "distance": 1, "price": 2},
}


def _lake_file(spark, kind, *records):
    d = lake.lake_path(run_dir(spark, "test-lake-one"), kind)
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in records)
    return d


@pytest.mark.parametrize("kind,name", [(k, n) for k, r in RECORDS.items() for n in r])
def test_every_field_is_required_and_typed(spark, kind, name):
    """One column is enough to read: a missing or wrong other field fails the job."""
    record = RECORDS[kind]
    wrong = {"x": 1} if isinstance(record[name], str) else "three"
    for bad in ({k: v for k, v in record.items() if k != name}, {**record, name: None}, {**record, name: wrong}):
        d = _lake_file(spark, kind, record, bad)
        with pytest.raises(Exception):
            lake.read_lake(spark, d, kind).select("journey_id").collect()


def test_instants_with_any_number_of_fraction_digits(spark):
    digits = ["", ".1", ".123", ".123456", ".123456789"]
    d = _lake_file(spark, "rated", *[
        {**RECORDS["rated"], "ratedAt": f"2020-01-01T00:00:05{x}Z", "rating": i} for i, x in enumerate(digits)])
    got = {r.rating: r.rated_at.microsecond for r in lake.read_lake(spark, d, "rated").collect()}
    assert got == {0: 0, 1: 100_000, 2: 123_000, 3: 123_000, 4: 123_000}


def test_an_instant_without_zone_or_time_fails(spark):
    for text in ("2020-01-01", "2020-01-01T00:00:05", "2020-01-01T25:00:05Z", ""):
        d = _lake_file(spark, "rated", {**RECORDS["rated"], "ratedAt": text})
        with pytest.raises(Exception):
            lake.read_lake(spark, d, "rated").collect()


def test_history_rerun_with_overwrite(spark):
    root = _write_golden_lake(spark)
    for mode in ("errorifexists", "overwrite"):
        out = history.rebuild_stats(spark, root, lake.lake_path(root, "stats"),
                                    StatsParams(interval_seconds=10), mode)
    assert utc_rows(out) == GOLDEN


def test_each_line_is_parsed_once(spark, tmp_path):
    """At most one from_json per read in the physical plan, whatever columns are used."""
    for kind in ("rated", "tipped", "journey"):
        path = str(tmp_path / kind)
        lake.write_lake(spark.createDataFrame([], lake.SCHEMA_OF[kind]), path, kind)
        df = lake.read_lake(spark, path, kind)
        for frame in (df, df.select("driver_id"), df.groupBy("driver_id").count()):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("from_json(") <= 1, plan
