"""The test mapping of the driver's ``events`` table onto the three event types.

One scan of ``events.parquet`` gives the wide frame (see operators.events);
``event_id`` is carried so that checks can address rows.  The mapping is
deterministic and mirrored in the DuckDB oracle (``__spark_entry__``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.events import narrow

# Fixed values of the mapping -------------------------------------------------
# events.event_type -> kind; journeys take their finish reason from the type,
# clicks alternate rider / admin cancel on the parity of event_id.
KIND_OF_TYPE = {"view": "rated", "purchase": "tipped", "signup": "journey",
                "error": "journey", "click": "journey"}
REASON_OF_TYPE = {"signup": "DROP_OFF", "error": "DRIVER_CANCEL"}
CLICK_REASON_EVEN, CLICK_REASON_ODD = "RIDER_CANCEL", "ADMIN_CANCEL"
# Defects planted for the validation and skew paths (moduli of event_id).
NULL_TIME_MOD = 61          # event time missing
EMPTY_DRIVER_MOD = 50       # driver_id ''
EMPTY_JOURNEY_MOD = 53      # journey_id ''
RIDER_MOD = 97              # rider-<event_id mod 97>
ARRIVAL_DELAY_MOD = 40      # arrival = event time + (event_id mod 40) s
RATING_MOD = 5              # rating = 1 + event_id mod 5
JOURNEY_MINUTES = 30        # started_at = ended_at - 30 min
PROPS_K_PATTERN = r'"k"\s*:\s*(-?\d+)'   # distance = props.k
PROPS_K_SQL = PROPS_K_PATTERN.replace("\\", "\\\\")   # as a SQL string literal


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def fixture_events(spark: SparkSession, sf_dir: str, kinds: tuple | None = None) -> DataFrame:
    """The wide event frame of the fixture, with ``event_id`` and ``source_ts``.

    ``kinds`` restricts it to some event kinds; the restriction is stated on
    ``event_type`` so that it reaches the parquet scan (a filter on the
    derived ``kind`` cannot be pushed through its CASE).

    One scan, two projections, all SQL expressions (one JVM call each).
    The session zone is UTC (``prepare_session``), so ``ts`` (wall clock)
    casts to the instant it names.
    """
    kind = "CASE event_type " + " ".join(
        f"WHEN '{t}' THEN '{k}'" for t, k in KIND_OF_TYPE.items() if k != "journey") + \
        " ELSE 'journey' END"
    reason = (f"CASE event_type WHEN 'signup' THEN '{REASON_OF_TYPE['signup']}' "
              f"WHEN 'error' THEN '{REASON_OF_TYPE['error']}' "
              f"WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN '{CLICK_REASON_EVEN}' "
              f"ELSE '{CLICK_REASON_ODD}' END END")
    types = ", ".join(f"'{t}'" for t, k in KIND_OF_TYPE.items() if kinds is None or k in kinds)
    base = (spark.read.parquet(events_path(sf_dir))
            .select("event_id", "ts", "user_id", "event_type", "value", "props")
            .filter(f"event_type IN ({types})")
            .selectExpr(
                "event_id",
                f"{kind} AS kind",
                f"CASE WHEN event_id % {EMPTY_DRIVER_MOD} = 0 THEN '' "
                "ELSE concat('driver-', CAST(user_id AS STRING)) END AS driver_id",
                f"concat('rider-', CAST(event_id % {RIDER_MOD} AS STRING)) AS rider_id",
                f"CASE WHEN event_id % {EMPTY_JOURNEY_MOD} = 0 THEN '' "
                "ELSE concat('journey-', CAST(event_id AS STRING)) END AS journey_id",
                f"CASE WHEN event_id % {NULL_TIME_MOD} = 0 THEN NULL "
                "ELSE timestamp_millis(unix_millis(CAST(ts AS TIMESTAMP))) END AS _event_time",
                f"timestamp_millis(unix_millis(CAST(ts AS TIMESTAMP)) "
                f"+ (event_id % {ARRIVAL_DELAY_MOD}) * 1000) AS source_ts",
                "CAST(round(value * 100) AS BIGINT) AS _cents",
                # props is the fixed one-key object {"k": <int>}; a key-anchored
                # regex reads it ~60x faster than a JSON parse per row.
                f"try_cast(regexp_extract(props, '{PROPS_K_SQL}', 1) AS BIGINT) AS _k",
                f"{reason} AS _reason",
            ))
    return base.selectExpr(
        "event_id", "kind", "driver_id", "rider_id", "journey_id",
        f"CASE WHEN kind = 'rated' THEN CAST(1 + event_id % {RATING_MOD} AS BIGINT) END AS rating",
        "CASE WHEN kind = 'rated' THEN _event_time END AS rated_at",
        "CASE WHEN kind = 'tipped' THEN _cents END AS amount",
        "CASE WHEN kind = 'tipped' THEN _event_time END AS tipped_at",
        "CASE WHEN kind = 'journey' THEN _reason END AS finish_reason",
        f"CASE WHEN kind = 'journey' THEN timestampadd(MINUTE, {-JOURNEY_MINUTES}, _event_time) "
        "END AS started_at",
        "CASE WHEN kind = 'journey' THEN _event_time END AS ended_at",
        "CASE WHEN kind = 'journey' THEN _k END AS distance",
        "CASE WHEN kind = 'journey' THEN _cents END AS price",
        "source_ts",
    )


def fixture_typed(spark: SparkSession, sf_dir: str, keep: tuple = ("event_id",)) -> dict:
    """The three typed tables ({kind: df}) of the fixture."""
    wide = fixture_events(spark, sf_dir)
    return {k: narrow(wide, k, keep=keep) for k in ("rated", "tipped", "journey")}
