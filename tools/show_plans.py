"""Print the physical plans of the main jobs (the source of PLANS.md).

    python tools/show_plans.py [sf_dir]

Batch and history plans come from ``explain()``; the live and pane plans
from a short streaming run over the whole encoded fixture of the smallest table.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv) -> int:
    from fleetpulse import queries as Q
    from fleetpulse.config import build_session, run_dir
    from fleetpulse.plans import history, live
    from fleetpulse.sources import topics
    from fleetpulse.streaming import runner

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=16)

    print("## J2 batch job (driver_stats_10m)")
    Q.driver_stats_10m(spark, sf).explain()

    print("## J3 history job")
    root = Q.fixture_lake(spark, sf)
    history.history_stats(history.read_history(spark, root), Q.P10M).explain()

    base = run_dir(spark, "plans")
    log = f"{base}/log"
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    topics.write_topic_log(Q.encoded_fixture(spark, small).drop("event_id"), log)

    print("## J1 live job (append)")
    src = topics.read_topic_log(spark, log, stream=True)
    q = runner.start_append(live.live_job(src, Q.P10M), f"{base}/out", f"{base}/ck",
                            state_partitions=8)
    runner.await_done(q)
    q.explain()

    print("## W5 pane deltas")
    src = topics.read_topic_log(spark, log, stream=True)
    q2 = runner.start_append(live.live_pane_deltas(src, Q.P10M, 1), f"{base}/out2",
                             f"{base}/ck2", trigger={"processingTime": "1 second"},
                             state_partitions=8)
    deadline = time.time() + 120
    while q2.lastProgress is None and time.time() < deadline:
        time.sleep(0.5)
    q2.explain()
    runner.stop_idle(q2)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
