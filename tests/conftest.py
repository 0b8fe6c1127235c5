import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

T0 = datetime(2020, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    from fleetpulse.config import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="fleetpulse-tests")
    yield s
    s.stop()


def golden_frames(spark):
    """The golden input of the specification (three typed streams)."""
    from fleetpulse import schemas as S

    rated = spark.createDataFrame([
        ("driver-1", "b", "c", 2, at(0)),
        ("driver-1", "b", "c", 4, at(1)),
        ("driver-2", "b", "c", 5, at(2)),
    ], S.RATED)
    tipped = spark.createDataFrame([
        ("driver-1", "b", "c", 2, at(0)),
        ("driver-1", "b", "c", 4, at(1)),
    ], S.TIPPED)
    journeys = spark.createDataFrame([
        ("driver-1", "b", "c", "DROP_OFF", at(-60), at(0), 1, 10),
        ("driver-1", "b", "c", "DROP_OFF", at(-60), at(2), 1, 10),
        ("driver-1", "b", "c", "DRIVER_CANCEL", at(-60), at(2), 1, 10),
        ("driver-1", "b", "c", "DROP_OFF", at(-60), at(12), 1, 10),
    ], S.JOURNEY)
    return rated, tipped, journeys


# The golden result rows.
GOLDEN = sorted([
    ("driver-1", at(0), at(10), 2, 1, 3, 30, 6, 3.0),
    ("driver-2", at(0), at(10), 0, 0, 0, 0, 0, 5.0),
    ("driver-1", at(10), at(20), 1, 0, 1, 10, 0, 0.0),
])


def utc_rows(df):
    """Collect rows with naive datetimes read as UTC made aware."""
    out = []
    for r in df.collect():
        out.append(tuple(v.replace(tzinfo=timezone.utc) if isinstance(v, datetime) and v.tzinfo is None
                         else v for v in r))
    return sorted(out)
