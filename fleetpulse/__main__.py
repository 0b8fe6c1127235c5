"""Command-line jobs (the reference's live job, history rebuild and tail tool).

    python -m fleetpulse live    --source DIR | --kafka HOSTS  --sink DIR | --sink-kafka HOSTS
                                 --checkpoint DIR [--mode final|running|panes|firings] [--interval 600]
                                 [--trigger "1 minute"] [--topic rated=NAME ...]
    python -m fleetpulse history --lake ROOT [--out DIR] [--interval 600]
    python -m fleetpulse feed    --source DIR | --kafka HOSTS  --sink DIR --checkpoint DIR

The live job reads the three input topics, the feed those and the output topic.
On Kafka a topic's default name has dots for the slashes Kafka forbids.

Under spark-submit the session comes from the submitter's settings; the
shared folder for state defaults to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from .config import StatsParams, build_session, run_dir


def topic_names(a) -> dict:
    """Topic of each kind: the defaults (dots for slashes on Kafka), then ``--topic``."""
    names = dict(StatsParams().topics)
    if getattr(a, "kafka", None) or getattr(a, "sink_kafka", None):
        names = {k: v.replace("/", ".") for k, v in names.items()}
    for pair in getattr(a, "topic", None) or []:
        kind, eq, name = pair.partition("=")
        if not eq or kind not in names or not name:
            raise SystemExit(f"--topic takes KIND=NAME with KIND one of {', '.join(names)}: {pair}")
        names[kind] = name
    return names


def _params(a) -> StatsParams:
    return StatsParams(interval_seconds=a.interval, skew_seconds=a.skew, watermark_seconds=a.skew,
                       topics=topic_names(a))


def _source(spark, a, params, names):
    from .sources import topics

    if a.kafka:
        return topics.read_kafka(spark, a.kafka, names, stream=True,
                                 max_offsets_per_trigger=a.max_offsets_per_trigger)
    return topics.read_topic_log(spark, a.source, stream=True,
                                 max_files_per_trigger=a.max_files_per_trigger)


def _trigger(a) -> dict:
    return {"availableNow": True} if a.once else {"processingTime": a.trigger}


def cmd_live(spark, a) -> int:
    from .plans import live
    from .sources import topics
    from .streaming import runner

    params = _params(a)
    src = _source(spark, a, params, list(topics.input_topics(params)))
    checkpoint = a.checkpoint or run_dir(spark, "live-checkpoint")
    if a.mode == "final":       # J1: final rows, encoded, to the output topic (log)
        kafka = {"fmt": "kafka", "options": {"kafka.bootstrap.servers": a.sink_kafka}} if a.sink_kafka else {}
        q = runner.start_append(live.live_job(src, params), a.sink, checkpoint,
                                trigger=_trigger(a), state_partitions=a.state_partitions, **kafka)
    elif a.sink_kafka:
        raise SystemExit("--sink-kafka takes the encoded rows of --mode final")
    elif a.mode == "running":   # W6: running totals per micro-batch
        q = runner.start_update(live.live_stats(src, params), a.sink, checkpoint,
                                trigger=_trigger(a), state_partitions=a.state_partitions)
    elif a.mode == "firings":   # W6: on-time and late firings of the watermark trigger
        q = runner.start_append(live.live_firings(src, params, a.lateness, a.ahead), a.sink, checkpoint,
                                trigger=_trigger(a), state_partitions=a.state_partitions)
    else:                       # W5: the reference's repeated, discarding panes
        q = runner.start_append(live.live_pane_deltas(src, params, a.pane_delay), a.sink,
                                checkpoint, trigger={"processingTime": a.trigger},
                                state_partitions=a.state_partitions)
    runner.watch(q)             # O1-O3: totals after every batch
    return 0


def cmd_history(spark, a) -> int:
    from .plans import history
    from .sources import lake

    out = a.out or lake.lake_path(a.lake, "stats")
    history.rebuild_stats(spark, a.lake, out, _params(a), mode="overwrite" if a.overwrite else "errorifexists")
    return 0


def cmd_feed(spark, a) -> int:
    from .plans import feed
    from .streaming import runner

    params = _params(a)
    src = _source(spark, a, params, list(params.topics.values()))
    checkpoint = a.checkpoint or run_dir(spark, "feed-checkpoint")
    q = runner.start_append(feed.decoded_feed(src, params), a.sink, checkpoint, trigger=_trigger(a))
    runner.watch(q)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fleetpulse")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--interval", type=int, default=600, help="aggregation interval, seconds")
        sp.add_argument("--skew", type=int, default=20, help="allowed skew = watermark delay, seconds")

    def streaming(sp, kafka_sink=False):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--source", help="topic log folder (parquet value/topic/timestamp)")
        g.add_argument("--kafka", help="Kafka bootstrap servers (needs spark-sql-kafka)")
        out = sp.add_mutually_exclusive_group(required=True)
        out.add_argument("--sink", help="folder of the results")
        if kafka_sink:
            out.add_argument("--sink-kafka", help="Kafka bootstrap servers; the output topic names the sink")
        sp.add_argument("--topic", action="append", metavar="KIND=NAME",
                        help="topic of a kind: rated, tipped, journey, stats")
        sp.add_argument("--max-offsets-per-trigger", type=int)
        sp.add_argument("--checkpoint")
        sp.add_argument("--trigger", default="1 minute")
        sp.add_argument("--once", action="store_true", help="process what is there, then stop")
        sp.add_argument("--max-files-per-trigger", type=int)
        sp.add_argument("--state-partitions", type=int)

    live_p = sub.add_parser("live", help="J1 live job")
    common(live_p)
    streaming(live_p, kafka_sink=True)
    live_p.add_argument("--mode", choices=["final", "running", "panes", "firings"], default="final")
    live_p.add_argument("--pane-delay", type=float, default=None,
                        help="panes: processing-time delay after a pane's first event (default: interval)")
    live_p.add_argument("--lateness", type=int, default=0, help="firings: seconds that late events still count")
    live_p.add_argument("--ahead", type=int, default=0,
                        help="firings: seconds past its arrival that an event may move the watermark")

    hist_p = sub.add_parser("history", help="J3 rebuild from the JSON lake")
    common(hist_p)
    hist_p.add_argument("--lake", required=True)
    hist_p.add_argument("--out")
    hist_p.add_argument("--overwrite", action="store_true", help="replace an earlier run's results")

    feed_p = sub.add_parser("feed", help="J4 decoded feed of the topics")
    common(feed_p)
    streaming(feed_p)
    return p


def main(argv=None) -> int:
    a = parser().parse_args(argv)
    spark = build_session()
    return {"live": cmd_live, "history": cmd_history, "feed": cmd_feed}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
