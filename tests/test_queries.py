"""Registered batch queries against their DuckDB oracle on the smallest data.

(The driver runs the same comparison at sf0.01 for every query, streaming
ones included; ``tools/oracle_check.py`` does it locally.)
"""

import pytest

from conftest import SF001
from fleetpulse.oracle import ORACLE_SQL
from fleetpulse.queries import QUERIES
from tools.oracle_check import duck, rows_of

STREAMING = {"stream_driver_stats", "stream_metrics", "stream_late_dropped", "stream_update_totals",
             "pane_deltas_total"}
BATCH = [n for n in QUERIES if n not in STREAMING]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    df = E.entry(spark)
    assert df.columns == ["driver_id", "interval_start", "interval_end", "total_drop_offs",
                          "total_driver_cancels", "total_distance", "total_price", "total_tips",
                          "avg_rating"]
    assert df.count() > 0


def test_skew_invariant_kept_plus_dropped_is_seen(spark):
    from pyspark.sql import Observation

    from fleetpulse.plans import stats as J
    from fleetpulse.queries import P10M, _wide

    obs = Observation("skew")
    J.driver_stats(_wide(spark, SF001), P10M, observation=obs).count()
    kept = QUERIES["skew_kept"](spark, SF001).count()
    dropped = QUERIES["skew_dropped"](spark, SF001).count()
    assert obs.get == {"seen": kept + dropped, "dropped_for_skew": dropped}


@pytest.mark.parametrize("name", sorted(STREAMING))
def test_stream_result_equals_batch_oracle(spark, con, name):
    """stream final = batch; running totals' last values = batch; sum of pane deltas = batch."""
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())
