"""DuckDB oracle SQL for the registered queries.

The fixture mapping and every rule are written again in plain SQL over the
pre-registered ``events`` view; results must equal the Spark queries on row
count, column names and values.  Timestamps are naive UTC (TIMESTAMP).
"""

from __future__ import annotations

# The fixture mapping (sources/fixtures.py) and validation, as CTEs.
FIXTURE = """
ev AS (
  SELECT event_id, user_id, event_type, "value" AS v, props,
         epoch_us(ts) // 1000 AS ms
  FROM events
  WHERE event_type IN ('view', 'purchase', 'signup', 'error', 'click')
),
fx AS (
  SELECT event_id, event_type,
    CASE event_type WHEN 'view' THEN 'rated' WHEN 'purchase' THEN 'tipped'
         ELSE 'journey' END AS kind,
    CASE WHEN event_id % 50 = 0 THEN '' ELSE 'driver-' || CAST(user_id AS VARCHAR) END AS driver_id,
    'rider-' || CAST(event_id % 97 AS VARCHAR) AS rider_id,
    CASE WHEN event_id % 53 = 0 THEN '' ELSE 'journey-' || CAST(event_id AS VARCHAR) END AS journey_id,
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE make_timestamp(ms * 1000) END AS et,
    make_timestamp((ms + (event_id % 40) * 1000) * 1000) AS source_ts,
    CAST(round(v * 100) AS BIGINT) AS cents,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM ev
),
wide AS (
  SELECT event_id, kind, driver_id, rider_id, journey_id,
    CASE WHEN kind = 'rated' THEN CAST(1 + event_id % 5 AS BIGINT) END AS rating,
    CASE WHEN kind = 'rated' THEN et END AS rated_at,
    CASE WHEN kind = 'tipped' THEN cents END AS amount,
    CASE WHEN kind = 'tipped' THEN et END AS tipped_at,
    CASE event_type WHEN 'signup' THEN 'DROP_OFF' WHEN 'error' THEN 'DRIVER_CANCEL'
         WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'RIDER_CANCEL' ELSE 'ADMIN_CANCEL' END
    END AS finish_reason,
    CASE WHEN kind = 'journey' THEN et - INTERVAL 30 MINUTE END AS started_at,
    CASE WHEN kind = 'journey' THEN et END AS ended_at,
    CASE WHEN kind = 'journey' THEN k END AS distance,
    CASE WHEN kind = 'journey' THEN cents END AS price,
    source_ts
  FROM fx
),
checked AS (
  SELECT *,
    CASE kind
      WHEN 'rated' THEN CASE WHEN rated_at IS NULL THEN 'missing_rated_at'
                             WHEN driver_id = '' THEN 'empty_driver_id'
                             WHEN journey_id = '' THEN 'empty_journey_id' END
      WHEN 'tipped' THEN CASE WHEN tipped_at IS NULL THEN 'missing_tipped_at'
                              WHEN driver_id = '' THEN 'empty_driver_id'
                              WHEN journey_id = '' THEN 'empty_journey_id' END
      ELSE CASE WHEN started_at IS NULL THEN 'missing_started_at'
                WHEN ended_at IS NULL THEN 'missing_ended_at'
                WHEN journey_id = '' THEN 'empty_journey_id' END
    END AS reject_reason
  FROM wide
),
valid AS (SELECT * FROM checked WHERE reject_reason IS NULL),
es AS (
  SELECT event_id, kind, source_ts, driver_id,
    CASE kind WHEN 'rated' THEN rated_at WHEN 'tipped' THEN tipped_at ELSE ended_at END AS event_time,
    CAST(CASE WHEN kind = 'journey' AND finish_reason = 'DROP_OFF' THEN 1 ELSE 0 END AS BIGINT) AS total_drop_offs,
    CAST(CASE WHEN kind = 'journey' AND finish_reason = 'DRIVER_CANCEL' THEN 1 ELSE 0 END AS BIGINT) AS total_driver_cancels,
    CASE WHEN kind = 'journey' THEN coalesce(distance, 0) ELSE 0 END AS total_distance,
    CASE WHEN kind = 'journey' THEN coalesce(price, 0) ELSE 0 END AS total_price,
    CASE WHEN kind = 'tipped' THEN coalesce(amount, 0) ELSE 0 END AS total_tips,
    CAST(CASE WHEN kind = 'rated' THEN 1 ELSE 0 END AS BIGINT) AS number_of_ratings,
    CASE WHEN kind = 'rated' THEN coalesce(rating, 0) ELSE 0 END AS total_rating
  FROM valid
),
kept AS (SELECT * FROM es WHERE event_time >= source_ts - INTERVAL 20 SECOND)
"""


def _with(body: str) -> str:
    return "WITH " + FIXTURE.strip() + "\n" + body


def _start(interval_s: int, col: str = "event_time") -> str:
    us = interval_s * 1_000_000
    return f"make_timestamp(epoch_us({col}) // {us} * {us})"


def _end(interval_s: int, col: str = "event_time") -> str:
    us = interval_s * 1_000_000
    return f"make_timestamp(epoch_us({col}) // {us} * {us} + {us})"


def _stats(source: str, interval_s: int) -> str:
    return f"""
SELECT driver_id,
  {_start(interval_s)} AS interval_start,
  {_end(interval_s)} AS interval_end,
  CAST(sum(total_drop_offs) AS BIGINT) AS total_drop_offs,
  CAST(sum(total_driver_cancels) AS BIGINT) AS total_driver_cancels,
  CAST(sum(total_distance) AS BIGINT) AS total_distance,
  CAST(sum(total_price) AS BIGINT) AS total_price,
  CAST(sum(total_tips) AS BIGINT) AS total_tips,
  CAST(CASE WHEN sum(number_of_ratings) > 0
            THEN CAST(sum(total_rating) AS DOUBLE) / CAST(sum(number_of_ratings) AS DOUBLE)
            ELSE 0 END AS REAL) AS avg_rating
FROM {source}
GROUP BY 1, 2, 3
"""


def _totals(kind: str, interval_s: int, names: list) -> str:
    cols = ",\n  ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)
    return _with(f"""
SELECT driver_id,
  {_start(interval_s)} AS interval_start,
  {_end(interval_s)} AS interval_end,
  {cols}
FROM kept WHERE kind = '{kind}'
GROUP BY 1, 2, 3
""")


_RATED_COLS = "event_id, driver_id, rider_id, journey_id, rating, rated_at"
_TIPPED_COLS = "event_id, driver_id, rider_id, journey_id, amount, tipped_at"
_JOURNEY_COLS = ("event_id, driver_id, rider_id, journey_id, finish_reason, started_at, "
                 "ended_at, distance, price")

def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')"


_FEED = f"""
, stats AS ({_stats("kept", 600)}),
feed AS (
  SELECT
    CASE kind WHEN 'rated' THEN 'input/driver_rated' WHEN 'tipped' THEN 'input/driver_tipped'
              ELSE 'input/journey_finished' END AS topic,
    CASE kind WHEN 'rated' THEN 'DriverRated' WHEN 'tipped' THEN 'DriverTipped'
              ELSE 'JourneyFinished' END AS event_type,
    driver_id,
    CASE kind WHEN 'rated' THEN rated_at WHEN 'tipped' THEN tipped_at ELSE ended_at END AS event_time,
    CAST(CASE kind
      WHEN 'rated' THEN json_object('driver_id', driver_id, 'rider_id', rider_id,
        'journey_id', journey_id, 'rated_at', {_ts("rated_at")}, 'rating', rating)
      WHEN 'tipped' THEN json_object('driver_id', driver_id, 'rider_id', rider_id,
        'journey_id', journey_id, 'tipped_at', {_ts("tipped_at")}, 'amount', amount)
      ELSE json_object('journey_id', journey_id, 'driver_id', driver_id, 'rider_id', rider_id,
        'finish_reason', finish_reason, 'started_at', {_ts("started_at")},
        'ended_at', {_ts("ended_at")}, 'distance', distance, 'price', price)
    END AS VARCHAR) AS payload
  FROM wide
  UNION ALL
  SELECT 'output/driver_stats', 'DriverStats', driver_id, interval_start,
    CAST(json_object('driver_id', driver_id, 'interval_start', {_ts("interval_start")},
      'interval_end', {_ts("interval_end")}, 'total_drop_offs', total_drop_offs,
      'total_driver_cancels', total_driver_cancels, 'total_distance', total_distance,
      'total_price', total_price, 'total_tips', total_tips,
      'avg_rating', CAST(avg_rating AS DOUBLE)) AS VARCHAR)
  FROM stats
)
SELECT * FROM feed
"""

ORACLE_SQL = {
    "driver_stats_10m": _with(_stats("kept", 600)),
    "driver_stats_1d": _with(_stats("kept", 86400)),
    "driver_stats_typed_10m": _with(_stats("kept", 600)),
    "rated_valid": _with(f"SELECT source_ts, {_RATED_COLS} FROM valid WHERE kind = 'rated'"),
    "tipped_valid": _with(f"SELECT source_ts, {_TIPPED_COLS} FROM valid WHERE kind = 'tipped'"),
    "journey_valid": _with(f"SELECT source_ts, {_JOURNEY_COLS} FROM valid WHERE kind = 'journey'"),
    "rejects_by_reason": _with("""
SELECT kind, reject_reason, count(*) AS n_rejected
FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1, 2
"""),
    "event_stats_union": _with("SELECT * FROM es"),
    "skew_kept": _with("SELECT event_id, kind, driver_id, event_time, source_ts FROM kept"),
    "skew_dropped": _with("""
SELECT event_id, kind, driver_id, event_time, source_ts FROM es
WHERE NOT (event_time >= source_ts - INTERVAL 20 SECOND)
"""),
    "window_assign": _with(f"""
SELECT event_id, event_time, {_start(600)} AS interval_start, {_end(600)} AS interval_end
FROM kept
"""),
    "window_event_counts": _with(f"""
SELECT {_start(600)} AS interval_start, {_end(600)} AS interval_end,
  count(*) AS n_events, count(DISTINCT driver_id) AS n_drivers
FROM kept GROUP BY 1, 2
"""),
    "journey_counters": _totals("journey", 86400, ["total_drop_offs", "total_driver_cancels",
                                                   "total_distance", "total_price"]),
    "rating_average": _with(f"""
SELECT driver_id, {_start(86400)} AS interval_start,
  CAST(sum(number_of_ratings) AS BIGINT) AS number_of_ratings,
  CAST(sum(total_rating) AS BIGINT) AS total_rating,
  CAST(CASE WHEN sum(number_of_ratings) > 0
            THEN CAST(sum(total_rating) AS DOUBLE) / CAST(sum(number_of_ratings) AS DOUBLE)
            ELSE 0 END AS REAL) AS avg_rating
FROM kept GROUP BY 1, 2
"""),
    "tip_totals": _totals("tipped", 86400, ["total_tips"]),
    "decode_rated": _with(f"SELECT source_ts, {_RATED_COLS} FROM wide "
                          "WHERE kind = 'rated'"),
    "decode_tipped": _with(f"SELECT source_ts, {_TIPPED_COLS} FROM wide "
                           "WHERE kind = 'tipped'"),
    "decode_journey": _with(f"SELECT source_ts, {_JOURNEY_COLS} FROM wide "
                            "WHERE kind = 'journey'"),
    "stats_codec_roundtrip": _with(_stats("kept", 600)),
    "json_lake_roundtrip": _with("""
SELECT kind, driver_id, rider_id, journey_id, rating, rated_at, amount, tipped_at,
  finish_reason, started_at, ended_at, distance, price
FROM valid
"""),
    "history_driver_stats": _with(_stats("es", 600)),
    # The corrupt payloads of the encoded log are extra rows: no event is lost.
    "stream_driver_stats": _with(_stats("kept", 600)),
    "stream_update_totals": _with(_stats("kept", 600)),
    # The end-of-input marker is one payload more, and one event seen.
    "stream_metrics": _with(f"""
SELECT (SELECT count(*) + count(*) FILTER (event_id % 40 = 0) + 1 FROM wide) AS payloads,
  (SELECT count(*) FROM wide WHERE event_id % 40 = 0) AS malformed,
  (SELECT count(*) + 1 FROM es) AS seen,
  (SELECT count(*) FROM es WHERE NOT (event_time >= source_ts - INTERVAL 20 SECOND)) AS dropped_for_skew,
  CAST(0 AS BIGINT) AS late_rows,
  (SELECT count(*) FROM (SELECT DISTINCT driver_id, {_start(600)} AS s FROM kept)) AS closed_windows
"""),
    "stream_firings": _with(f"SELECT *, 'on_time' AS firing FROM ({_stats('kept', 600)})"),
    # The events dated ahead count in their own windows; all others count as if they were not there.
    "stream_future_dated": _with(f"""
, shifted AS (SELECT * REPLACE (CASE WHEN event_id % 50 = 7 THEN event_time + INTERVAL 1 DAY ELSE event_time END
  AS event_time) FROM es),
passed AS (SELECT * FROM shifted WHERE event_time >= source_ts - INTERVAL 20 SECOND)
SELECT *, 'on_time' AS firing FROM ({_stats('passed', 600)})
"""),
    # A window is open until the watermark (20 s behind the latest kept event) reaches its end.
    "stream_open_windows": _with(f"""
, mark AS (SELECT max(event_time) - INTERVAL 20 SECOND AS watermark FROM kept)
SELECT {_start(600)} AS interval_start, {_end(600)} AS interval_end, count(DISTINCT driver_id) AS drivers, watermark
FROM kept, mark WHERE {_end(600)} > watermark GROUP BY 1, 2, 4
"""),
    "stream_skew_dropped": _with("""
SELECT kind, source_ts, driver_id, event_time, total_drop_offs, total_driver_cancels, total_distance, total_price,
  total_tips, number_of_ratings, total_rating
FROM es WHERE NOT (event_time >= source_ts - INTERVAL 20 SECOND)
"""),
    # Every event counts in the end, as in the history job.
    "corrected_driver_stats": _with(_stats("es", 600)),
    # Late events count only in windows the first run left open.
    "stream_late_dropped": _with(f"""
, mark AS (SELECT max(event_time) - INTERVAL 20 SECOND AS w FROM kept WHERE event_id % 10 <> 3),
counted AS (SELECT kept.* FROM kept, mark WHERE event_id % 10 <> 3 OR {_end(600)} > w)
{_stats("counted", 600)}
"""),
    "pane_deltas_total": _with(_stats("kept", 600)),
    "decoded_feed": "WITH " + FIXTURE.strip() + _FEED,
}
