"""Job parameters, session settings and the shared working folder.

Everything time-related in this package is an instant (Spark ``timestamp``)
computed without reading the session time zone; the session zone is pinned to
UTC anyway so that printed values and JSON text read the same everywhere.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Topic names of the three inputs and of the output.
TOPIC_RATED = "input/driver_rated"
TOPIC_TIPPED = "input/driver_tipped"
TOPIC_JOURNEY = "input/journey_finished"
TOPIC_STATS = "output/driver_stats"
# Default aggregation interval of the live and history jobs (seconds).
DEFAULT_INTERVAL_SECONDS = 600
# Permitted backward skew between arrival time and event time (seconds).
ALLOWED_SKEW_SECONDS = 20


@dataclass(frozen=True)
class StatsParams:
    """Arguments of every job (live, history, feed)."""

    interval_seconds: int = DEFAULT_INTERVAL_SECONDS
    skew_seconds: int = ALLOWED_SKEW_SECONDS
    # Watermark delay equals the skew: an event that passed the skew filter is
    # then never late (see README, "Late data").
    watermark_seconds: int = ALLOWED_SKEW_SECONDS
    topics: dict = field(
        default_factory=lambda: {
            "rated": TOPIC_RATED,
            "tipped": TOPIC_TIPPED,
            "journey": TOPIC_JOURNEY,
            "stats": TOPIC_STATS,
        }
    )

    @property
    def interval(self) -> str:
        return f"{int(self.interval_seconds)} seconds"

    @property
    def watermark(self) -> str:
        return f"{int(self.watermark_seconds)} seconds"


# Settings this package relies on.  Applied by ``prepare_session``; cluster
# submitters may set them in spark-defaults instead.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # generated stage past that runs interpreted (measured: 2x slower on the
    # fixture plan).  Split generated code finer, and past 8000 bytes fall
    # back from whole-stage codegen rather than run un-JITted code.
    "spark.sql.codegen.methodSplitThreshold": "256",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Arrow batches for the protobuf codec (mapInArrow).
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stateful pane deltas (transformWithState) need the RocksDB store; the
    # windowed aggregations work with it too and keep state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit a small changelog per micro-batch instead of uploading a RocksDB
    # snapshot of every state partition (measured: -18% on the replayed stream).
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on every executor's Python workers.

    The Arrow codec and the stateful processor run in Python workers, which
    import this package by name.  The package is zipped (content-addressed)
    into the shared folder and added with ``addPyFile``, once per
    SparkContext; a cluster that already ships it with ``--py-files`` pays
    one small upload more.
    """
    sc = spark.sparkContext
    data, digest = _package_zip()
    key = (sc.applicationId, digest)
    if key in _SHIPPED:
        return
    target = f"{shared_dir(spark)}/fleetpulse/pyfiles/fleetpulse-{digest}.zip"
    local = target[len("file:"):] if target.startswith("file:") else target
    if "://" in local:
        # A cluster file system: write through Hadoop's FileSystem API.
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(path):
            out = fs.create(path, True)
            out.write(bytearray(data))
            out.close()
    else:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        if not os.path.exists(local):
            tmp = f"{local}.{uuid.uuid4().hex}.part"
            with open(tmp, "wb") as fh:
                fh.write(data)
            os.replace(tmp, local)
    sc.addPyFile(target)
    _SHIPPED.add(key)


@functools.lru_cache(maxsize=1)
def _package_zip() -> tuple:
    """The package's .py files as a deterministic zip, and its digest."""
    import hashlib
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    files = []
    for root, _, names in os.walk(pkg_dir):
        for n in sorted(names):
            if n.endswith(".py"):
                full = os.path.join(root, n)
                files.append((os.path.relpath(full, os.path.dirname(pkg_dir)), full))
    files.sort()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for arc, full in files:
            info = zipfile.ZipInfo(arc, date_time=(2020, 1, 1, 0, 0, 0))
            with open(full, "rb") as fh:
                z.writestr(info, fh.read())
    data = buf.getvalue()
    return data, hashlib.sha256(data).hexdigest()[:16]


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply SESSION_CONF to a running session and ship this package to the
    executors through the shared folder.  Where the session names no
    checkpoint folder (a ``local[...]`` master only), ``shared_dir`` sets
    ``spark.checkpoint.dir`` and the context's checkpoint folder too."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "fleetpulse") -> SparkSession:
    """Session for tests, the bench and command-line runs.

    The master is taken from the argument, then ``FLEETPULSE_MASTER``, then
    whatever spark-submit configured; only a plain ``python`` run with none
    of these gets ``local[*]``.
    """
    from pyspark import SparkConf

    master = master or os.environ.get("FLEETPULSE_MASTER")
    if not master and not SparkConf().contains("spark.master"):
        master = "local[*]"
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("FLEETPULSE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir).
    When neither is set, a local folder is made and registered, but only
    under a ``local[...]`` master, where driver and executors are one
    process; on a cluster executors would not see it, so this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share "
                               f"(master {master} has no default)")
        d = tempfile.mkdtemp(prefix="fleetpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    return f"{shared_dir(spark)}/fleetpulse/{name}-{uuid.uuid4().hex[:12]}"
