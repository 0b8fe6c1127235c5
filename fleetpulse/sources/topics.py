"""Topic logs of raw payloads, the shape of a Kafka source row.

A topic log is ``(value binary, topic string, timestamp timestamp)``: one
row per message, the broker's arrival time in ``timestamp``.  Here the log
lives as parquet files in a shared folder (the image has no Kafka jar);
with ``spark-sql-kafka`` on the classpath, ``read_kafka`` gives the same rows
and everything downstream is unchanged.  Several topics share one log (one
Kafka subscription), and decoding picks the message by topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import StatsParams
from ..functions import codec
from ..operators.events import WIDE_FIELDS
from ..schemas import RAW_TOPIC, SOURCE_TS

INPUT_KINDS = ("rated", "tipped", "journey")


def input_topics(params: StatsParams) -> dict:
    """{topic: kind} of the three input topics (the journey input is the
    journey topic; the reference wired the output topic there by mistake)."""
    return {params.topics[k]: k for k in INPUT_KINDS}


def output_topics(params: StatsParams) -> dict:
    return {params.topics["stats"]: "stats"}


def read_topic_log(spark: SparkSession, path: str, *, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over a parquet topic log (batch, or a file stream)."""
    if not stream:
        return spark.read.schema(RAW_TOPIC).parquet(path)
    r = spark.readStream.schema(RAW_TOPIC).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def read_kafka(spark: SparkSession, servers: str, topics: list, *, stream: bool = True,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1 over Kafka (needs the spark-sql-kafka package on the classpath).

    One subscription for all topics; ``max_offsets_per_trigger`` bounds a
    micro-batch (spread over the topic partitions)."""
    r = spark.readStream if stream else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)))
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return r.load().select("value", "topic", "timestamp")


def write_topic_log(raw: DataFrame, path: str, mode: str = "append") -> None:
    """S2 for a batch of encoded rows."""
    raw.select("value", "topic", "timestamp").write.mode(mode).parquet(path)


def decode_events(raw: DataFrame, params: StatsParams = StatsParams(), keep: tuple = (),
                  observation: Observation | str | None = None, skip: tuple = ()) -> DataFrame:
    """Raw rows of the input topics -> the wide event frame.

    Malformed payloads are dropped (the reference drops them silently); with
    ``observation`` the number of rows read and dropped is reported.  Fields
    named in ``skip`` are left out of the frame.
    """
    dec = codec.decode(raw, input_topics(params), keep=keep, skip=skip)
    if observation is not None:
        dec = dec.observe(observation, F.count(F.lit(1)).alias("payloads"),
                          F.count_if(~F.col("decode_ok")).alias("malformed"))
    fields = [f for f in WIDE_FIELDS if f not in skip]
    return dec.filter(F.col("decode_ok")).select(*keep, "kind", *fields, SOURCE_TS)


def decode_stats(raw: DataFrame, params: StatsParams = StatsParams(), keep: tuple = ()) -> DataFrame:
    """Decode the output topic back into result rows."""
    from ..schemas import STATS_COLUMNS

    dec = codec.decode(raw, output_topics(params), keep=keep)
    return dec.filter(F.col("decode_ok")).select(*keep, *STATS_COLUMNS, SOURCE_TS)


def encode_events(wide: DataFrame, params: StatsParams = StatsParams(), keep: tuple = ()) -> DataFrame:
    """The wide event frame -> raw rows on the input topics (arrival = source_ts)."""
    topic_of_kind = {k: params.topics[k] for k in INPUT_KINDS}
    return codec.encode(wide, topic_of_kind, keep=keep)


def encode_stats(stats: DataFrame, params: StatsParams = StatsParams(), keep: tuple = ()) -> DataFrame:
    """Result rows -> raw rows on the output topic.  The row timestamp is
    the end of the interval (the result's event time, W7)."""
    return codec.encode(stats, {"stats": params.topics["stats"]}, kind="stats",
                        arrival="interval_end", keep=keep)
