"""Property: decode(encode(x)) = x for any valid event of any kind."""

from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from conftest import utc_rows
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams
from fleetpulse.operators.events import WIDE_FIELDS, widen
from fleetpulse.sources import topics

P = StatsParams()
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
ids = st.text(min_size=0, max_size=12)                      # any unicode, '' allowed
u32 = st.integers(min_value=0, max_value=2 ** 32 - 1)
# millisecond instants from 1900 to the end of 9999 (PySpark's own datetime
# conversion cannot collect year 0001 in every zone; the codec itself takes
# any protobuf Timestamp)
instants = st.one_of(st.none(), st.integers(min_value=-2208988800000, max_value=253402300799999)
                     .map(lambda ms: EPOCH + timedelta(milliseconds=ms)))
arrival = st.integers(min_value=0, max_value=4102444800000).map(lambda ms: EPOCH + timedelta(milliseconds=ms))
rated = st.tuples(ids, ids, ids, u32, instants, arrival)
tipped = st.tuples(ids, ids, ids, u32, instants, arrival)
journey = st.tuples(ids, ids, ids, st.sampled_from(S.FINISH_REASONS), instants, instants, u32, u32, arrival)


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(rated, max_size=6), st.lists(tipped, max_size=6), st.lists(journey, max_size=6))
def test_decode_encode_roundtrip(spark, r, t, j):
    frames = {
        "rated": spark.createDataFrame(r, S.with_source_ts(S.RATED)),
        "tipped": spark.createDataFrame(t, S.with_source_ts(S.TIPPED)),
        "journey": spark.createDataFrame(j, S.with_source_ts(S.JOURNEY)),
    }
    wide = widen(frames)
    back = topics.decode_events(topics.encode_events(wide, P), P)
    cols = ["kind", *WIDE_FIELDS, "source_ts"]
    assert utc_rows(back.select(*cols)) == utc_rows(wide.select(*cols))
