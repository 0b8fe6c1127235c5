"""Fixed schemas of the three input events, the common shape and the result.

All proto3 ``uint32`` fields are ``bigint`` here (sums never wrap); proto3
strings are never null (missing = ''); protobuf Timestamps are instants with
millisecond precision (null = not set).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, TS, F32 = T.StringType(), T.LongType(), T.TimestampType(), T.FloatType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Typed events -------------------------------------------------------------
RATED = _struct(("driver_id", S), ("rider_id", S), ("journey_id", S),
                ("rating", L), ("rated_at", TS))
TIPPED = _struct(("driver_id", S), ("rider_id", S), ("journey_id", S),
                 ("amount", L), ("tipped_at", TS))
JOURNEY = _struct(("driver_id", S), ("rider_id", S), ("journey_id", S),
                  ("finish_reason", S), ("started_at", TS), ("ended_at", TS),
                  ("distance", L), ("price", L))

# Column that gives each event type its event time (journeys: ended_at).
EVENT_TIME_COLUMN = {"rated": "rated_at", "tipped": "tipped_at", "journey": "ended_at"}
TYPED_SCHEMA = {"rated": RATED, "tipped": TIPPED, "journey": JOURNEY}

# Arrival time of an event at the source (the broker / Kafka row timestamp).
SOURCE_TS = "source_ts"

# The seven running totals, in the order of the result message.
TOTALS = ("total_drop_offs", "total_driver_cancels", "total_distance",
          "total_price", "total_tips", "number_of_ratings", "total_rating")

# Result: one row per driver and interval.
DRIVER_STATS = _struct(("driver_id", S), ("interval_start", TS), ("interval_end", TS),
                       ("total_drop_offs", L), ("total_driver_cancels", L),
                       ("total_distance", L), ("total_price", L), ("total_tips", L),
                       ("avg_rating", F32))
STATS_COLUMNS = tuple(f.name for f in DRIVER_STATS.fields)

# Raw topic row: the shape of a Kafka source row, reduced to what is used.
RAW_TOPIC = _struct(("value", T.BinaryType()), ("topic", S), ("timestamp", TS))

# Finish reasons: fixed values of the journey enum, by wire number.
FINISH_REASONS = ("DROP_OFF", "RIDER_CANCEL", "DRIVER_CANCEL", "ADMIN_CANCEL")
UNRECOGNIZED = "UNRECOGNIZED"

# JSON lake field names (camelCase, as the lake writer of the reference names
# them); instants are ISO-8601 strings in UTC with milliseconds.
LAKE_NAMES = {
    "driver_id": "driverId", "rider_id": "riderId", "journey_id": "journeyId",
    "rating": "rating", "rated_at": "ratedAt", "amount": "amount",
    "tipped_at": "tippedAt", "finish_reason": "finishReason",
    "started_at": "startedAt", "ended_at": "endedAt", "distance": "distance",
    "price": "price", "interval_start": "intervalStart",
    "interval_end": "intervalEnd", "total_drop_offs": "totalDropOffs",
    "total_driver_cancels": "totalDriverCancels", "total_distance": "totalDistance",
    "total_price": "totalPrice", "total_tips": "totalTips", "avg_rating": "avgRating",
}

def lake_schema(schema: T.StructType) -> T.StructType:
    """The camelCase JSON-lake form of a typed schema."""
    return T.StructType([T.StructField(LAKE_NAMES[f.name], f.dataType, True)
                         for f in schema.fields])


def with_source_ts(schema: T.StructType) -> T.StructType:
    """A copy of ``schema`` with the arrival-time column appended."""
    return T.StructType(list(schema.fields) + [T.StructField(SOURCE_TS, TS, True)])
