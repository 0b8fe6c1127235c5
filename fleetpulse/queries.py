"""Registered queries: one per operator group of the blueprint.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` table of that folder.  Instants are returned as UTC wall-clock
``timestamp_ntz`` (``for_check``) to compare with DuckDB ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import StatsParams, prepare_session, run_dir
from .operators import aggregate, skew, validate
from .functions import codec
from .operators.events import narrow, per_kind_sql, widen
from .plans import correction, feed, history, live, stats
from .sources import lake, topic_source, topics
from .sources.fixtures import fixture_events, fixture_typed
from .streaming import runner

P10M = StatsParams(interval_seconds=600)
P1D = StatsParams(interval_seconds=86400)


def for_check(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall-clock timestamp_ntz, other columns unchanged."""
    cols = [f"CAST(`{f.name}` AS TIMESTAMP_NTZ) AS `{f.name}`"
            if isinstance(f.dataType, T.TimestampType) else f"`{f.name}`"
            for f in df.schema.fields]
    return df.selectExpr(*cols)


def _wide(spark: SparkSession, sf_dir: str, kinds: tuple | None = None) -> DataFrame:
    prepare_session(spark)
    return fixture_events(spark, sf_dir, kinds)


# -- J2 -----------------------------------------------------------------------

def driver_stats_10m(spark, sf_dir):
    """J2 with F1-F4, P1-P5, U1, W1-W2, A1-A4; 10-minute intervals."""
    return for_check(stats.driver_stats(_wide(spark, sf_dir), P10M))


def driver_stats_1d(spark, sf_dir):
    """Same job, 1-day intervals (several events per key)."""
    return for_check(stats.driver_stats(_wide(spark, sf_dir), P1D))


def driver_stats_typed_10m(spark, sf_dir):
    """J2 through its three-input entry point: typed tables, one result."""
    prepare_session(spark)
    t = fixture_typed(spark, sf_dir)
    return for_check(stats.driver_stats_typed(t["rated"], t["tipped"], t["journey"], P10M))


# -- F1-F3 --------------------------------------------------------------------

def _valid_kind(kind):
    def q(spark, sf_dir):
        wide = validate.valid(_wide(spark, sf_dir, kinds=(kind,)))
        return for_check(narrow(wide, kind, keep=("event_id",)))
    q.__name__ = f"{kind}_valid"
    return q


rated_valid = _valid_kind("rated")
tipped_valid = _valid_kind("tipped")
journey_valid = _valid_kind("journey")


def rejects_by_reason(spark, sf_dir):
    """Rejects of F1-F3 per kind and first failing check."""
    return validate.rejects_by_reason(_wide(spark, sf_dir))


# -- P1-P4, U1 ----------------------------------------------------------------

def event_stats_union(spark, sf_dir):
    """Validated events in the common shape: three typed tables in one bag."""
    prepare_session(spark)
    wide = widen(fixture_typed(spark, sf_dir), keep=("event_id",))
    es = stats.event_stats(wide, skew_check=False, keep=("event_id",))
    return for_check(es)


# -- F4, T1 -------------------------------------------------------------------

def skew_kept(spark, sf_dir):
    es = stats.event_stats(_wide(spark, sf_dir), P10M, keep=("event_id",))
    return for_check(es.select("event_id", "kind", "driver_id", "event_time", "source_ts"))


def skew_dropped(spark, sf_dir):
    es = stats.event_stats(_wide(spark, sf_dir), P10M, skew_check=False, keep=("event_id",))
    out = skew.skew_dropped(es, P10M.skew_seconds)
    return for_check(out.select("event_id", "kind", "driver_id", "event_time", "source_ts"))


# -- W1, W2, W7, A1 -----------------------------------------------------------

def window_assign(spark, sf_dir):
    """Interval of every kept event (10 minutes)."""
    es = stats.event_stats(_wide(spark, sf_dir), P10M, keep=("event_id",))
    w = aggregate.tumbling(P10M.interval)
    out = es.select("event_id", "event_time", w.alias("window")).select(
        "event_id", "event_time",
        F.col("window.start").alias("interval_start"),
        F.col("window.end").alias("interval_end"))
    return for_check(out)


def window_event_counts(spark, sf_dir):
    """Events and drivers per 10-minute interval (the reference's A1 grouping)."""
    es = stats.event_stats(_wide(spark, sf_dir), P10M)
    out = (es.groupBy(aggregate.tumbling(P10M.interval).alias("window"))
           .agg(F.count(F.lit(1)).alias("n_events"),
                F.count_distinct("driver_id").alias("n_drivers"))
           .select(F.col("window.start").alias("interval_start"),
                   F.col("window.end").alias("interval_end"), "n_events", "n_drivers"))
    return for_check(out)


# -- A3a-A3e, A4 ----------------------------------------------------------------

def _totals_of(spark, sf_dir, kind, names):
    wide = _wide(spark, sf_dir, kinds=(kind,))
    es = stats.event_stats(wide, P1D)
    t = aggregate.window_totals(es, P1D.interval)
    return t.select("driver_id", F.col("window.start").alias("interval_start"),
                    F.col("window.end").alias("interval_end"), *names)


def journey_counters(spark, sf_dir):
    """Journeys only: counters, distance and price for every finish reason."""
    return for_check(_totals_of(spark, sf_dir, "journey",
                                ["total_drop_offs", "total_driver_cancels",
                                 "total_distance", "total_price"]))


def rating_average(spark, sf_dir):
    """Ratings per driver and day; drivers without ratings get 0 (all kinds)."""
    es = stats.event_stats(_wide(spark, sf_dir), P1D)
    t = aggregate.window_totals(es, P1D.interval)
    out = t.select("driver_id", F.col("window.start").alias("interval_start"),
                   "number_of_ratings", "total_rating",
                   aggregate.average_rating(F.col("total_rating"),
                                            F.col("number_of_ratings")).alias("avg_rating"))
    return for_check(out)


def tip_totals(spark, sf_dir):
    return for_check(_totals_of(spark, sf_dir, "tipped", ["total_tips"]))


# -- D1-D5, E1-E4 ------------------------------------------------------------

# Fault injection: beside every 40th event an extra payload arrives on the same
# topic that is not a valid message: two 0xFF bytes (no protobuf message), or
# a message whose instants lie far outside the Timestamp range.
CORRUPT_MOD = 40
CORRUPT_BYTES_HEX = "FFFF"
BAD_SECONDS = 10**15


def _bad_instant_hex(kind: str) -> str:
    """A payload of the kind that parses, with instants out of range."""
    msg = codec.message_classes()[codec.MESSAGE_OF_KIND[kind]]()
    for name, _, ftype in codec.WIRE[codec.MESSAGE_OF_KIND[kind]]:
        if ftype == "ts":
            getattr(msg, name).seconds = BAD_SECONDS
        elif ftype == "str":
            setattr(msg, name, "x")
    return msg.SerializeToString().hex()


def encoded_fixture(spark, sf_dir, params=P10M, kinds=None):
    """The fixture as raw topic rows (E2), and the planted corrupt payloads."""
    wide = _wide(spark, sf_dir, kinds)
    raw = topics.encode_events(wide, params, keep=("event_id",))
    topic = per_kind_sql({k: f"'{params.topics[k]}'" for k in topics.INPUT_KINDS})
    bad = per_kind_sql({k: f"unhex('{_bad_instant_hex(k)}')" for k in topics.INPUT_KINDS})
    planted = wide.where(f"event_id % {CORRUPT_MOD} = 0").selectExpr(
        f"CASE WHEN event_id % {2 * CORRUPT_MOD} = 0 THEN unhex('{CORRUPT_BYTES_HEX}') ELSE {bad} END AS value",
        f"{topic} AS topic", "source_ts AS timestamp", "event_id")
    return raw.unionByName(planted)


def _decode_kind(kind):
    def q(spark, sf_dir):
        raw = encoded_fixture(spark, sf_dir, kinds=(kind,))
        wide = topics.decode_events(raw, P10M, keep=("event_id",))
        return for_check(narrow(wide, kind, keep=("event_id",)))
    q.__name__ = f"decode_{kind}"
    return q


decode_rated = _decode_kind("rated")
decode_tipped = _decode_kind("tipped")
decode_journey = _decode_kind("journey")


def stats_codec_roundtrip(spark, sf_dir):
    """Result rows -> output-topic payloads (E1, E3) -> decoded again."""
    st = stats.driver_stats(_wide(spark, sf_dir), P10M)
    raw = topics.encode_stats(st, P10M)
    back = topics.decode_stats(raw, P10M)
    return for_check(back.drop("source_ts"))


# -- S3, S4, J3 ----------------------------------------------------------------

def fixture_lake(spark, sf_dir) -> str:
    """Write the valid fixture events to a fresh JSON lake (S4); its root."""
    root = run_dir(spark, "lake")
    for kind in ("rated", "tipped", "journey"):
        wide = validate.valid(_wide(spark, sf_dir, kinds=(kind,)))
        lake.write_lake(narrow(wide, kind), lake.lake_path(root, kind), kind)
    return root


def json_lake_roundtrip(spark, sf_dir):
    """Typed events written to the lake and read back (S4 then S3)."""
    root = fixture_lake(spark, sf_dir)
    return for_check(history.read_history(spark, root).drop("source_ts"))


def history_driver_stats(spark, sf_dir):
    """Lake -> stats (no validation, no skew filter) -> stats lake -> read."""
    root = fixture_lake(spark, sf_dir)
    out = history.rebuild_stats(spark, root, lake.lake_path(root, "stats"), P10M)
    return for_check(out)


# -- S1, S2, T2, W3-W4, W6, J1 ------------------------------------------------

# Arrival slices of the replay: one run per week of arrivals.
ARRIVAL_SLICE_SECONDS = 7 * 86400


def _state_partitions(spark) -> int:
    return spark.sparkContext.defaultParallelism


#: One query runs through the whole log; its source ends a batch with every slice.
RUN_ON = {"processingTime": "0 seconds"}


def _replay(spark, sf_dir, base, start, marker: bool, encoded=None) -> None:
    """The encoded fixture (with corrupt payloads) through ``start(source)``: one
    query over a sliced log, one micro-batch per arrival slice."""
    encoded = encoded_fixture(spark, sf_dir).drop("event_id") if encoded is None else encoded
    if not topic_source.openable(base):
        _replay_by_runs(spark, encoded, base, start, marker)
        return
    log = f"{base}/topic-log"
    topic_source.write_slices(encoded, log, ARRIVAL_SLICE_SECONDS)
    if marker:
        topic_source.write_slices(runner.end_of_input(spark, P10M), log, ARRIVAL_SLICE_SECONDS)
    topic_source.close_log(log)
    runner.finish(start(topic_source.read_slices(spark, log, f"{base}/positions"), RUN_ON))
    runner.remove_folder(spark, log)


def _replay_by_runs(spark, encoded, base, start, marker: bool) -> None:
    """The same where only Spark can open the store: one availableNow run per
    arrival slice from one checkpoint."""
    def run_once():
        return start(topics.read_topic_log(spark, f"{base}/topic-log", stream=True))

    runner.backfill_by_slice(encoded, f"{base}/topic-log", f"{base}/staging", ARRIVAL_SLICE_SECONDS, run_once,
                             end_marker=runner.end_of_input(spark, P10M) if marker else None)
    runner.remove_folder(spark, f"{base}/topic-log")


def _start_live(spark, base, job=live.live_job):
    def start(src, trigger=None):
        if topic_source.openable(base):
            return runner.start_append(job(src, P10M), None, f"{base}/checkpoint", fmt=topic_source.FORMAT,
                                       options={"path": f"{base}/out", "txn": "live"}, trigger=trigger,
                                       state_partitions=_state_partitions(spark))
        return runner.start_append(job(src, P10M), f"{base}/out", f"{base}/checkpoint", trigger=trigger,
                                   state_partitions=_state_partitions(spark))
    return start


def stream_driver_stats(spark, sf_dir):
    """J1 end to end: payload log -> streaming job (append) -> payload sink -> decoded."""
    base = run_dir(spark, "live")
    _replay(spark, sf_dir, base, _start_live(spark, base), marker=True)
    return for_check(topics.decode_stats(_live_rows(spark, base), P10M).drop("source_ts"))


def _live_rows(spark, base):
    """What the live job's sink holds."""
    read = topic_source.read_committed if topic_source.openable(base) else topics.read_topic_log
    return read(spark, f"{base}/out")


def stream_metrics(spark, sf_dir):
    """O1-O3: the totals the live job reports over all its micro-batches."""
    base, totals, started = run_dir(spark, "metrics"), runner.Totals(), []
    live_start = _start_live(spark, base)

    def start(src, trigger=None):
        if started:
            totals.update(started[-1])
        started.append(live_start(src, trigger))
        return started[-1]

    _replay(spark, sf_dir, base, start, marker=True)
    totals.update(started[-1])
    names = ("payloads", "malformed", "seen", "dropped_for_skew", "late_rows", "closed_windows")
    row = tuple(int(totals.counts[n]) for n in names)
    return spark.createDataFrame([row], ", ".join(f"{n} long" for n in names))


def stream_update_totals(spark, sf_dir):
    """Running totals in update mode; the last emission per key."""
    base, run = run_dir(spark, "update"), []

    def start(src, trigger=None):
        # Batch ids go on across the runs of one checkpoint.
        run.append(runner.start_update(live.live_stats(src, P10M), f"{base}/updates", f"{base}/checkpoint",
                                       trigger=trigger, state_partitions=_state_partitions(spark)))
        return run[-1]

    _replay(spark, sf_dir, base, start, marker=False)
    upd = spark.read.parquet(f"{base}/updates")
    return for_check(runner.last_per_key(upd, ["driver_id", "interval_start", "interval_end"]))


#: A replay has thousands of windows open at once, which spread the work by themselves.
REPLAY_SLOTS = 2


def _fired(spark, sf_dir, base, encoded=None):
    """All firings of the watermark trigger over a replay, marker excluded."""
    def start(src, trigger=None):
        return runner.start_append(live.live_firings(src, P10M, slots=REPLAY_SLOTS), f"{base}/firings",
                                   f"{base}/checkpoint", trigger=trigger, state_partitions=_state_partitions(spark))

    _replay(spark, sf_dir, base, start, marker=True, encoded=encoded)
    names = ("driver_id", "interval_start", "interval_end", "firing", "total_drop_offs", "total_driver_cancels",
             "total_distance", "total_price", "total_tips", "avg_rating")
    return for_check(spark.read.parquet(f"{base}/firings").select(*names))


def stream_firings(spark, sf_dir):
    """Every firing of the watermark trigger with its kind; without late events one per key, on time."""
    return _fired(spark, sf_dir, run_dir(spark, "firings"))


AHEAD_MOD, AHEAD_REST, AHEAD_DAYS = 50, 7, 1   # events whose clock runs ahead


def stream_future_dated(spark, sf_dir):
    """Every fiftieth event is dated a day ahead; no other event is late for it."""
    ahead = f"event_id % {AHEAD_MOD} = {AHEAD_REST}"
    wide = _wide(spark, sf_dir)
    for c in ("rated_at", "tipped_at", "ended_at"):
        wide = wide.withColumn(c, F.expr(f"IF({ahead}, {c} + INTERVAL {AHEAD_DAYS} DAYS, {c})"))
    return _fired(spark, sf_dir, run_dir(spark, "future"), topics.encode_events(wide, P10M))


def stream_open_windows(spark, sf_dir):
    """O2: windows the live job still holds open after the whole log, by its state store."""
    base = run_dir(spark, "open-windows")
    _replay(spark, sf_dir, base, _start_live(spark, base), marker=False)
    return for_check(runner.open_windows(spark, f"{base}/checkpoint"))


def stream_skew_dropped(spark, sf_dir):
    """O1: the events that the live job's skew filter drops, as rows of a side output."""
    base = run_dir(spark, "skew-split")

    def start(src, trigger=None):
        es = stats.event_stats(topics.decode_events(src, P10M, skip=live.UNUSED), P10M, skew_check=False)
        return runner.start_skew_split(es, f"{base}/events", f"{base}/checkpoint", P10M.skew_seconds, trigger=trigger)

    _replay(spark, sf_dir, base, start, marker=False)
    return for_check(runner.skew_side(spark, f"{base}/events", dropped=True))


def corrected_driver_stats(spark, sf_dir):
    """The live job's statistics, with the days that lost events rebuilt from all events."""
    base = run_dir(spark, "correction")

    def start(src, trigger=None):
        es = stats.event_stats(topics.decode_events(src, P10M, skip=live.UNUSED), P10M, skew_check=False)
        return runner.start_skew_split(es, f"{base}/events", f"{base}/checkpoint", P10M.skew_seconds,
                                       trigger=trigger, day=correction.day_of_interval(P10M))

    _replay(spark, sf_dir, base, start, marker=False)
    kept = runner.skew_side(spark, f"{base}/events", dropped=False)
    correction.write_stats(aggregate.driver_stats(kept, P10M.interval), f"{base}/stats")
    correction.correct(spark, f"{base}/events", f"{base}/stats", P10M)
    return for_check(correction.read_stats(spark, f"{base}/stats"))


# -- W3 ------------------------------------------------------------------------

LATE_MOD, LATE_REST = 10, 3   # events that arrive only after all others


def stream_late_dropped(spark, sf_dir):
    """Every tenth event comes in a second run from the same checkpoint.  Its
    window has closed by then unless the watermark of the first run is before
    the window's end; closed windows do not change."""
    base = run_dir(spark, "late")
    wide = _wide(spark, sf_dir)
    late = F.col("event_id") % LATE_MOD == LATE_REST
    log = f"{base}/topic-log"
    for part, marker in ((wide.where(~late), False), (wide.where(late), True)):
        topics.write_topic_log(topics.encode_events(part, P10M), log)
        runner.await_done(_start_live(spark, base)(topics.read_topic_log(spark, log, stream=True)))
        if marker:
            topics.write_topic_log(runner.end_of_input(spark, P10M), log)
            runner.await_done(_start_live(spark, base)(topics.read_topic_log(spark, log, stream=True)))
    runner.remove_folder(spark, log)
    return for_check(topics.decode_stats(_live_rows(spark, base), P10M).drop("source_ts"))


# -- W5 ------------------------------------------------------------------------

PANE_DELAY_SECONDS = 2       # short pane delay for a finite replay
PANE_TRIGGER = "2 seconds"


def pane_deltas_total(spark, sf_dir):
    """Pane deltas of the live trigger, summed per key (= final totals).

    The query keeps running while its timers fire, so the log (written at its
    natural parallelism) is read by one processing-time query until every
    row is read and no pane is pending."""
    from .streaming import panes

    base = run_dir(spark, "panes")
    log = f"{base}/topic-log"
    topics.write_topic_log(encoded_fixture(spark, sf_dir), log)
    n_rows = topics.read_topic_log(spark, log).count()   # parquet footers
    deltas = live.live_pane_deltas(topics.read_topic_log(spark, log, stream=True), P10M, PANE_DELAY_SECONDS,
                                   slots=REPLAY_SLOTS)
    q = runner.start_append(deltas, f"{base}/deltas", f"{base}/checkpoint",
                            trigger={"processingTime": PANE_TRIGGER},
                            state_partitions=_state_partitions(spark))
    runner.await_quiet(q, n_rows)
    runner.remove_folder(spark, log)
    return for_check(panes.sum_deltas(spark.read.parquet(f"{base}/deltas")))


# -- J4 ------------------------------------------------------------------------

def decoded_feed(spark, sf_dir):
    """The input topics and the output topic in one log, decoded by topic."""
    events_raw = encoded_fixture(spark, sf_dir).drop("event_id")
    stats_raw = topics.encode_stats(stats.driver_stats(_wide(spark, sf_dir), P10M), P10M)
    return for_check(feed.decoded_feed(events_raw.unionByName(stats_raw), P10M))


QUERIES = {
    "driver_stats_10m": driver_stats_10m,
    "driver_stats_1d": driver_stats_1d,
    "driver_stats_typed_10m": driver_stats_typed_10m,
    "rated_valid": rated_valid,
    "tipped_valid": tipped_valid,
    "journey_valid": journey_valid,
    "rejects_by_reason": rejects_by_reason,
    "event_stats_union": event_stats_union,
    "skew_kept": skew_kept,
    "skew_dropped": skew_dropped,
    "window_assign": window_assign,
    "window_event_counts": window_event_counts,
    "journey_counters": journey_counters,
    "rating_average": rating_average,
    "tip_totals": tip_totals,
    "decode_rated": decode_rated,
    "decode_tipped": decode_tipped,
    "decode_journey": decode_journey,
    "stats_codec_roundtrip": stats_codec_roundtrip,
    "json_lake_roundtrip": json_lake_roundtrip,
    "history_driver_stats": history_driver_stats,
    "stream_driver_stats": stream_driver_stats,
    "stream_metrics": stream_metrics,
    "stream_late_dropped": stream_late_dropped,
    "stream_firings": stream_firings,
    "stream_future_dated": stream_future_dated,
    "stream_open_windows": stream_open_windows,
    "stream_skew_dropped": stream_skew_dropped,
    "corrected_driver_stats": corrected_driver_stats,
    "stream_update_totals": stream_update_totals,
    "pane_deltas_total": pane_deltas_total,
    "decoded_feed": decoded_feed,
}
