"""Protobuf wire codec, decode chosen by topic."""

import pytest
from pyspark.sql import functions as F

from conftest import at, utc_rows
from fleetpulse import schemas as S
from fleetpulse.config import StatsParams, TOPIC_JOURNEY, TOPIC_RATED, TOPIC_STATS, TOPIC_TIPPED
from fleetpulse.functions import codec
from fleetpulse.operators.events import widen
from fleetpulse.plans.feed import decoded_feed
from fleetpulse.sources import topics

P = StatsParams(interval_seconds=10)


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.RAW_TOPIC)


def _pb(kind, **fields):
    msg = codec.message_classes()[codec.MESSAGE_OF_KIND[kind]]()
    for k, v in fields.items():
        if isinstance(v, tuple):
            t = getattr(msg, k)
            t.seconds, t.nanos = v
        else:
            setattr(msg, k, v)
    return msg.SerializeToString()


def test_decode_by_topic_and_malformed(spark):
    rated = _pb("rated", driver_id="d1", rider_id="r", journey_id="j", rating=4,
                rated_at=(1577836800, 123456789))
    rows = [
        (rated, TOPIC_RATED, at(0)),
        (rated, TOPIC_TIPPED, at(0)),            # same bytes, tip topic: a tip
        (bytes.fromhex("ffff"), TOPIC_RATED, at(0)),
        (b"hello", TOPIC_JOURNEY, at(0)),
        (b"", TOPIC_RATED, at(0)),               # empty parses as all defaults
        (rated, "some/other/topic", at(0)),
    ]
    dec = topics.decode_events(_raw(spark, rows), P)
    out = sorted(dec.select("kind", "driver_id", "rating", "amount", "rated_at", "tipped_at")
                 .collect(), key=lambda r: (r.kind, r.driver_id))
    assert [(r.kind, r.driver_id) for r in out] == [("rated", ""), ("rated", "d1"), ("tipped", "d1")]
    good = out[1]
    assert good.rating == 4 and good.amount is None
    # nanos 123456789 -> .123 (milliseconds kept, rest dropped)
    assert good.rated_at.replace(tzinfo=None).isoformat() == "2020-01-01T00:00:00.123000"
    assert out[2].amount == 4 and out[2].tipped_at is not None
    empty = out[0]
    assert empty.rating == 0 and empty.rated_at is None   # then F1 rejects it


def test_malformed_count_is_observed(spark):
    from pyspark.sql import Observation

    rows = [(bytes.fromhex("ffff"), TOPIC_RATED, at(0)),
            (_pb("tipped", driver_id="d", journey_id="j", amount=1, tipped_at=(0, 0)), TOPIC_TIPPED, at(0))]
    obs = Observation("decode")
    n = topics.decode_events(_raw(spark, rows), P, observation=obs).count()
    assert n == 1
    assert obs.get == {"payloads": 2, "malformed": 1}


def test_enum_default_and_unknown(spark):
    j = dict(journey_id="j", driver_id="d", started_at=(10, 0), ended_at=(20, 0), distance=5, price=7)
    drop_off = _pb("journey", **j)                   # finish_reason absent = DROP_OFF (0)
    msg = codec.message_classes()["JourneyFinished"]()
    msg.ParseFromString(drop_off)
    msg.finish_reason = 7                             # unknown number
    unknown = msg.SerializeToString()
    dec = topics.decode_events(_raw(spark, [(drop_off, TOPIC_JOURNEY, at(0)),
                                            (unknown, TOPIC_JOURNEY, at(0))]), P)
    reasons = sorted(r.finish_reason for r in dec.collect())
    assert reasons == ["DROP_OFF", S.UNRECOGNIZED]


def test_encode_decode_roundtrip_all_kinds(spark):
    rated = spark.createDataFrame([("d", "r", "j", 5, at(1.5), at(2))], S.with_source_ts(S.RATED))
    tipped = spark.createDataFrame([("d", "r", "j", 250, at(3), at(3))], S.with_source_ts(S.TIPPED))
    journeys = spark.createDataFrame([
        ("d", "r", "j", "ADMIN_CANCEL", at(-5), at(4), 1000, 2000, at(4)),
        ("d", "r", "j", "DROP_OFF", None, at(4), 0, 0, at(4)),
    ], S.with_source_ts(S.JOURNEY))
    wide = widen({"rated": rated, "tipped": tipped, "journey": journeys})
    raw = topics.encode_events(wide, P)
    assert sorted(r.topic for r in raw.collect()) == sorted(
        [TOPIC_RATED, TOPIC_TIPPED, TOPIC_JOURNEY, TOPIC_JOURNEY])
    back = topics.decode_events(raw, P)
    cols = ["kind", "driver_id", "rider_id", "journey_id", "rating", "rated_at", "amount",
            "tipped_at", "finish_reason", "started_at", "ended_at", "distance", "price", "source_ts"]
    assert utc_rows(back.select(*cols)) == utc_rows(wide.select(*cols))


def test_pre_epoch_instant_roundtrip(spark):
    rated = spark.createDataFrame([("d", "r", "j", 1, at(-1577836800 - 0.25), at(0))],
                                  S.with_source_ts(S.RATED))
    back = topics.decode_events(topics.encode_events(widen({"rated": rated}), P), P)
    assert utc_rows(back.select("rated_at")) == utc_rows(rated.select("rated_at"))


def test_encode_rejects_unknown_reason_and_out_of_range(spark):
    bad_reason = spark.createDataFrame([("d", "r", "j", "LOST", at(0), at(1), 1, 1, at(1))],
                                       S.with_source_ts(S.JOURNEY))
    with pytest.raises(Exception, match="Unsupported finish reason"):
        topics.encode_events(widen({"journey": bad_reason}), P).collect()
    too_big = spark.createDataFrame([("d", "r", "j", 2 ** 32, at(0), at(0))], S.with_source_ts(S.TIPPED))
    with pytest.raises(Exception, match="uint32"):
        topics.encode_events(widen({"tipped": too_big}), P).collect()


def test_stats_encode_decode(spark):
    stats = spark.createDataFrame(
        [("d", at(0), at(10), 2, 1, 3, 30, 6, 3.0), ("e", at(0), at(10), 0, 0, 0, 0, 0, 2 / 3)],
        S.DRIVER_STATS)
    raw = topics.encode_stats(stats, P)
    assert {r.topic for r in raw.collect()} == {TOPIC_STATS}
    # the row timestamp of a result is the end of its interval
    assert {r.timestamp.replace(tzinfo=None).isoformat() for r in raw.collect()} == {"2020-01-01T00:00:10"}
    back = topics.decode_stats(raw, P).drop("source_ts")
    assert utc_rows(back) == utc_rows(stats)


def test_feed_shows_a_rating_as_a_rating(spark):
    rated = _pb("rated", driver_id="d1", journey_id="j", rating=4, rated_at=(0, 0))
    tipped = _pb("tipped", driver_id="d2", journey_id="j", amount=4, tipped_at=(0, 0))
    feed = decoded_feed(_raw(spark, [(rated, TOPIC_RATED, at(0)), (tipped, TOPIC_TIPPED, at(0)),
                                     (b"\xff", TOPIC_STATS, at(0))]), P)
    rows = sorted(feed.collect(), key=lambda r: r.driver_id)
    assert [(r.driver_id, r.event_type) for r in rows] == [("d1", "DriverRated"), ("d2", "DriverTipped")]
    assert '"rating":4' in rows[0].payload and '"rated_at":"1970-01-01T00:00:00.000Z"' in rows[0].payload
    assert feed.filter(F.col("topic") == TOPIC_STATS).count() == 0
