"""Running the streaming jobs: sinks, finite replays and progress reports.

* ``start_append`` / ``start_update``: the two result modes.  Append emits one
  final row per (window, driver) once the watermark passes the window end
  (W4, late rows dropped: W3).  Update re-emits a key's running totals in
  every micro-batch that changes it (W6); the parquet sink takes append only,
  so update mode goes through ``foreachBatch`` and keeps the batch id, and
  ``last_per_key`` reads the final value back.
* ``finish``: ends a query over a finite sliced log (``topic_source``), which
  replays arrivals in order by itself.
* ``backfill_by_slice``: the same for stores that only Spark can open; replays a batch of raw rows in arrival order, one
  ``availableNow`` run per arrival slice from the same checkpoint.
* ``end_of_input``: a marker that moves the watermark past every real window
  (the reference's test does the same by advancing its watermark to
  infinity).  Its own window never closes, so it never reaches the output.  A
  checkpoint that has seen it is finished: all later input would be late.
* ``start_skew_split``: events kept and dropped by the skew filter, side by side (O1).
* ``open_windows``: the windows a job holds open, from its state store (O2).
* ``Totals`` / ``watch``: skew drops, malformed payloads, late rows and closed
  windows summed over all micro-batches, and the watermark (O1-O3).

Every checkpoint and sink lives in the shared folder (config.run_dir).
"""

from __future__ import annotations

import contextlib
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import StatsParams
from ..sources import topic_source

# Fixed values of the end-of-input marker.
END_OF_INPUT_AT = datetime(9000, 1, 1, tzinfo=timezone.utc)
MARKER_ID = "__end_of_input__"


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Temporarily set SQL settings (a streaming query captures them at start)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _state_conf(spark: SparkSession, state_partitions: int | None) -> dict:
    # The number of state-store partitions is fixed at a query's first start
    # (kept in its checkpoint); size it to the cluster, not to a batch job.
    return {} if not state_partitions else {"spark.sql.shuffle.partitions": int(state_partitions)}


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_append(df: DataFrame, sink: str | None, checkpoint: str, *, fmt: str = "parquet",
                 trigger: dict | None = None, state_partitions: int | None = None,
                 options: dict | None = None) -> StreamingQuery:
    """Final results only (append mode), checkpointed.

    A file sink takes the ``sink`` path.  For Kafka (S2 on a broker), pass
    ``fmt="kafka"``, ``sink=None`` and ``options={"kafka.bootstrap.servers":
    ...}``: the encoded rows already carry Kafka's ``value`` and ``topic``
    columns (needs the spark-sql-kafka package).  For a log with committed
    epochs, pass ``fmt=topic_source.FORMAT`` and ``options={"path": ..., "txn": ...}``."""
    spark = df.sparkSession
    if fmt == "kafka":
        df = df.select("value", "topic")
    elif fmt == topic_source.FORMAT:
        topic_source.register(spark)
        df = df.select("value", "topic", "timestamp")
    with session_conf(spark, _state_conf(spark, state_partitions)):
        w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w = _trigger(w, trigger)
        return w.start(sink) if sink else w.start()


def start_update(df: DataFrame, sink: str, checkpoint: str, *, trigger: dict | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Running totals (update mode): every changed key per micro-batch, in a
    ``batch_id=`` folder of its own.  A re-run batch overwrites its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    spark = df.sparkSession
    with session_conf(spark, _state_conf(spark, state_partitions)):
        w = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write))
        return _trigger(w, trigger).start()


def start_skew_split(events: DataFrame, sink: str, checkpoint: str, skew_seconds: int, *,
                     trigger: dict | None = None, day=None) -> StreamingQuery:
    """O1 as rows: events of one stream, kept and dropped by the skew filter, in one pass.

    Each micro-batch is one job that writes both sides, as the partitions ``dropped=false``
    and ``dropped=true`` of a folder of its own, ``batch_id=<n>``.  A batch that is run again
    overwrites its folder, so every event is on exactly one side exactly once;
    readers of one side prune the other by its folder (``skew_side``).  With
    ``day`` (a column of the events) each side is laid out by day as well, for ``plans.correction``."""
    from ..operators.skew import within_skew_sql

    by = ["dropped"] if day is None else ["dropped", "day"]
    if day is not None:
        events = events.withColumn("day", day)
    marked = events.withColumn("dropped", F.expr(f"NOT coalesce({within_skew_sql(skew_seconds)}, false)"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*by).parquet(f"{sink}/batch_id={batch_id}")

    w = marked.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(w, trigger).start()


def skew_side(spark: SparkSession, sink: str, dropped: bool) -> DataFrame:
    """One side of ``start_skew_split``'s output."""
    return spark.read.parquet(sink).where(F.col("dropped") == F.lit(str(dropped).lower())).drop(
        "dropped", "batch_id", "day")


def checkpoint_watermark(spark: SparkSession, checkpoint: str) -> DataFrame:
    """watermark: where the last planned micro-batch stands, from the query's offset log."""
    lines = spark.read.text(f"{checkpoint}/offsets")
    ms = F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    return lines.select(F.timestamp_millis(F.max(ms)).alias("watermark"))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """O2 from a job's state: interval_start, interval_end, drivers, watermark of the open windows.

    Reads the state store of the last committed micro-batch (Spark's state
    data source), whether the job runs or not; a window is there from its
    first kept event until the watermark has passed its end.  ``drivers`` counts its
    (window, driver) rows, one per driver with a kept event.
    """
    state = spark.read.format("statestore").load(checkpoint)
    window = next(f"key.`{f.name}`" for f in state.schema["key"].dataType.fields if "window" in f.name)
    open_ = (state.select(F.col(f"{window}.start").alias("interval_start"), F.col(f"{window}.end").alias("interval_end"))
             .groupBy("interval_start", "interval_end").agg(F.count(F.lit(1)).alias("drivers")))
    return open_.withColumn("watermark", checkpoint_watermark(spark, checkpoint).scalar())


def last_per_key(updates: DataFrame, keys: list) -> DataFrame:
    """Latest emission of every key of an update-mode log (max ``batch_id``).

    A key has one row per batch, so the columns' maxima by batch belong to
    the same row; fixed-width columns keep the aggregation hash-based."""
    vals = [c for c in updates.columns if c not in keys and c != "batch_id"]
    return updates.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in vals])


def await_done(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for a finite (availableNow) run; raise its error.  Without a
    ``timeout_s`` it waits as long as the run takes."""
    finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination() or True)
    if not finished:
        stop_idle(q)
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def finish(q: StreamingQuery) -> None:
    """Let a running query read all that its source offers now, batch after batch, then stop it."""
    q.processAllAvailable()
    stop_idle(q)
    if q.exception() is not None:
        raise q.exception()


def stop_idle(q: StreamingQuery, poll_s: float = 0.02, tries: int = 500) -> None:
    """Stop a query between two triggers, so that no batch is cut off."""
    for _ in range(tries):
        if not q.isActive or not q.status["isTriggerActive"]:
            break
        time.sleep(poll_s)
    q.stop()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's FileSystem (any store)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def backfill_by_slice(raw: DataFrame, log: str, staging: str, slice_seconds: int,
                      run_once, end_marker: DataFrame | None = None,
                      after_slice: int | None = None) -> int:
    """Replay raw topic rows slice by slice, at any scale.

    Each arrival slice is appended to the log at its natural parallelism
    (any number of files), then ``run_once()`` starts the job with an
    ``availableNow`` trigger from the same checkpoint and waits for it, so
    every run sees only arrivals later than the previous run's.  Ordering
    comes from the runs, not from file timestamps, and every slice
    boundary is a restart from the checkpoint.  Returns the number of runs.

    ``end_marker`` (``end_of_input``) is appended before one last run.  It ends
    the checkpoint: the watermark is then past every real window and any
    later row would be late, so a log that holds the marker is refused.

    A backfill that failed is resumed with ``after_slice``, the last slice
    number that was done (slice = epoch seconds div ``slice_seconds``); the
    staged copy is written anew, and removed at the end.
    """
    spark = raw.sparkSession
    if _ended(spark, log):
        raise ValueError(f"{log} holds the end-of-input marker; start a new log and checkpoint")
    sl = F.floor(F.unix_seconds("timestamp") / F.lit(int(slice_seconds))).cast("long")
    (raw.select("value", "topic", "timestamp", sl.alias("slice"))
     .write.mode("overwrite").partitionBy("slice").parquet(staging))
    staged = _read_staged(spark, staging)
    runs = 0
    # One number per slice comes to the driver.
    for s in sorted(r[0] for r in staged.select("slice").distinct().collect()):
        if after_slice is not None and s <= after_slice:
            continue
        staged.filter(F.col("slice") == s).select("value", "topic", "timestamp") \
            .write.mode("append").parquet(log)
        await_done(run_once())
        runs += 1
    if end_marker is not None:
        end_marker.select("value", "topic", "timestamp").write.mode("append").parquet(log)
        await_done(run_once())
        runs += 1
    if not runs:
        # No input: still create the (empty) log, so a stream can start on it.
        raw.select("value", "topic", "timestamp").limit(0).write.mode("append").parquet(log)
    remove_folder(spark, staging)
    return runs


def _ended(spark: SparkSession, log: str) -> bool:
    from ..schemas import RAW_TOPIC

    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(log)
    if not p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p):
        return False
    return not (spark.read.schema(RAW_TOPIC).parquet(log)
                .filter(F.col("timestamp") >= F.lit(END_OF_INPUT_AT)).isEmpty())


def _read_staged(spark: SparkSession, staging: str) -> DataFrame:
    """The staged log with a fixed schema (works for an empty staging too)."""
    from pyspark.sql import types as T

    from ..schemas import RAW_TOPIC

    schema = T.StructType(list(RAW_TOPIC.fields) + [T.StructField("slice", T.LongType())])
    return spark.read.schema(schema).parquet(staging)


def end_of_input(spark: SparkSession, params: StatsParams = StatsParams()) -> DataFrame:
    """The end-of-input marker as one raw topic row: a valid rating far in the
    future.  A single control record, so it is serialized right here with
    the codec's message classes instead of starting a Python worker."""
    from ..functions.codec import message_classes
    from ..schemas import RAW_TOPIC

    msg = message_classes()["DriverRated"]()
    msg.driver_id = msg.rider_id = msg.journey_id = MARKER_ID
    msg.rated_at.seconds = int(END_OF_INPUT_AT.timestamp())
    msg.rated_at.nanos = 0
    return spark.createDataFrame(
        [(msg.SerializeToString(), params.topics["rated"], END_OF_INPUT_AT)], RAW_TOPIC)


def progress_report(q: StreamingQuery) -> dict:
    """O1-O3 from the last progress: watermark, state rows, late rows, metrics."""
    p = q.lastProgress or {}
    ops = p.get("stateOperators") or []
    return {
        "batch_id": p.get("batchId"),
        "watermark": (p.get("eventTime") or {}).get("watermark"),
        "input_rows": p.get("numInputRows"),
        "state_rows": sum(o.get("numRowsTotal", 0) for o in ops),
        "rows_dropped_by_watermark": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
        # O3: (window, driver) states evicted in this batch because the
        # watermark passed the window end - in append mode, the rows emitted.
        "closed_windows": sum(o.get("numRowsRemoved", 0) for o in ops),
        "observed": {k: dict(v.asDict()) if hasattr(v, "asDict") else v
                     for k, v in (p.get("observedMetrics") or {}).items()},
    }


class Totals:
    """O1-O3 over all micro-batches of a query (and of later runs of it).

    ``update`` takes the batches finished since the last call from the
    query's recent progress, so call it at least once per hundred batches.
    ``late_rows`` counts the rows that reach the state operator: partial
    sums per key and task, not single events.
    """

    FIELDS = ("payloads", "malformed", "seen", "dropped_for_skew", "late_rows", "closed_windows",
              "input_rows", "batches")

    def __init__(self) -> None:
        self.counts = dict.fromkeys(self.FIELDS, 0)
        self.watermark = None
        self._done: set = set()

    def update(self, q: StreamingQuery) -> bool:
        """Add what is new; whether anything was."""
        before = self.counts["batches"]
        for p in q.recentProgress:
            key = (p["runId"], p["batchId"])
            if key in self._done or "addBatch" not in p["durationMs"]:
                continue  # counted, or a trigger that found nothing to do
            self._done.add(key)
            c = self.counts
            c["batches"] += 1
            c["input_rows"] += p["numInputRows"]
            for o in p["stateOperators"] or []:
                c["late_rows"] += o["numRowsDroppedByWatermark"]
                c["closed_windows"] += o["numRowsRemoved"]
            for m in (p["observedMetrics"] or {}).values():
                for k, v in (m.asDict() if hasattr(m, "asDict") else dict(m)).items():
                    if k in c:
                        c[k] += v or 0
            self.watermark = (p["eventTime"] or {}).get("watermark") or self.watermark
        return self.counts["batches"] > before

    def report(self) -> str:
        return " ".join(f"{k}={v}" for k, v in self.counts.items()) + f" watermark={self.watermark}"


def watch(q: StreamingQuery, totals: Totals | None = None, report=print, poll_s: float = 1.0) -> Totals:
    """Wait for the query and report its totals whenever a batch has ended."""
    totals = totals or Totals()
    while True:
        ended = q.awaitTermination(poll_s)
        if totals.update(q) and report is not None:
            report(totals.report())
        if ended:
            if q.exception() is not None:
                raise q.exception()
            return totals


def await_quiet(q: StreamingQuery, total_input_rows: int, timeout_s: float | None = None,
                poll_s: float = 0.2) -> dict:
    """Wait until a processing-time query has read ``total_input_rows`` rows
    and its state is empty (every pane fired), then stop it between triggers.
    Returns the last progress report.  Polls progress only; no data reaches
    the driver.  Without ``timeout_s`` it waits as long as the query lives."""
    totals = Totals()
    deadline = time.time() + timeout_s if timeout_s else None
    while deadline is None or time.time() < deadline:
        if q.exception() is not None:
            raise q.exception()
        if not q.isActive:
            raise RuntimeError(f"query {q.id} was stopped with input or state left")
        totals.update(q)
        last = q.lastProgress
        if last is not None and totals.counts["input_rows"] >= total_input_rows:
            rep = progress_report(q)
            if last.get("numInputRows", 0) == 0 and rep["state_rows"] == 0:
                stop_idle(q)
                return rep
        time.sleep(poll_s)
    stop_idle(q)
    raise TimeoutError(f"query {q.id} still had input or state after {timeout_s}s")
