"""S1 / S2 as a Python data source: a topic log with offsets and epochs.

A *sliced log* is a folder of arrival slices, ``slice=<n>/*.parquet``, each
holding the payloads that arrived in one span of time (``write_slices``).
Slices are numbered by arrival time, so their numbers are the log's offsets:

* the **reader** plans micro-batches of whole slices in arrival order, at most
  ``slices_per_batch`` at a time.  The newest slice is open and is not read
  before a later one exists or the log is closed (``close_log``).  Spark asks a Python
  source only for its latest offset, without saying where the query stands,
  so the reader keeps the last offset it has offered in ``positions`` (a folder of the
  query, beside its checkpoint), written before Spark sees it.  After a
  restart it goes on from there: never behind the query, at most one batch ahead of it.
* the **writer** is transactional.  Tasks write files under names of their own
  and report them; the driver commits an epoch by writing one manifest
  (``_epochs/<txn>-<epoch>.json``) that names its files.  Only files that a manifest
  names belong to the log (``read_committed``).  An epoch that is run again
  after its manifest was written changes nothing, and one that failed before
  leaves files that nobody names.

Files are opened by pyarrow: local paths and the stores pyarrow knows.  Where
only Spark can open the store, ``topics.read_topic_log`` and Spark's file sink do the same
work without offsets and epochs.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition,
                                    WriterCommitMessage)

from ..config import ship_package
from ..schemas import RAW_TOPIC

FORMAT = "sliced_topic_log"
CLOSED = "_closed"
EPOCHS = "_epochs"
#: Rows of an Arrow batch handed to Spark, and of a file's row group.
BATCH_ROWS = 10_000
#: Bytes of a column that a reader asks the store for at a time.
READ_BUFFER = 1 << 20


def filesystem(path: str):
    """(file system, path on it) by pyarrow."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def openable(path: str) -> bool:
    """Whether pyarrow can open this store."""
    try:
        filesystem(path)
    except (ValueError, OSError, ImportError):
        return False
    return True


def _names(at, folder: str) -> list[str]:
    from pyarrow import fs

    return [i.base_name for i in at.get_file_info(fs.FileSelector(folder, allow_not_found=True))]


def _replace(at, path: str, text: str) -> None:
    """Write a small file so that a reader sees all of it or nothing."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with at.open_output_stream(part) as out:
        out.write(text.encode())
    at.move(part, path)


def sealed_slices(path: str) -> list[int]:
    """Numbers of the slices that will not change any more, in arrival order."""
    at, folder = filesystem(path)
    names = _names(at, folder)
    found = sorted(int(n[len("slice="):]) for n in names if n.startswith("slice="))
    return found if CLOSED in names else found[:-1]


class SliceFile(InputPartition):
    """Some row groups of one file."""

    def __init__(self, path: str, groups: tuple[int, int]):
        super().__init__((path, groups))


class SliceReader(DataSourceStreamReader):
    GROUPS_PER_TASK = 8

    def __init__(self, path: str, positions: str, slices_per_batch: int):
        self.path, self.positions, self.most = path, positions, slices_per_batch

    def initialOffset(self) -> dict:
        return {"slice": -(1 << 62)}

    def _position(self) -> int:
        at, folder = filesystem(self.positions)
        name = f"{folder}/position"
        if "position" not in _names(at, folder):
            return self.initialOffset()["slice"]
        with at.open_input_stream(name) as f:
            return json.loads(f.read())["slice"]

    def latestOffset(self) -> dict:
        """The slice up to which the next batch may read."""
        position = self._position()
        later = [s for s in sealed_slices(self.path) if s > position]
        if not later:
            return {"slice": position}
        offered = later[:self.most][-1]
        at, folder = filesystem(self.positions)
        at.create_dir(folder, recursive=True)
        _replace(at, f"{folder}/position", json.dumps({"slice": offered}))
        return {"slice": offered}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        import pyarrow.parquet as pq

        at, folder = filesystem(self.path)
        out = []
        for s in sealed_slices(self.path):
            if start["slice"] < s <= end["slice"]:
                for name in sorted(_names(at, f"{folder}/slice={s}")):
                    if name.endswith(".parquet"):
                        file = f"{folder}/slice={s}/{name}"
                        with at.open_input_file(file) as f:
                            groups = pq.ParquetFile(f).num_row_groups
                        out += [SliceFile(f"{self.path}/slice={s}/{name}", (g, min(groups, g + self.GROUPS_PER_TASK)))
                                for g in range(0, groups, self.GROUPS_PER_TASK)]
        return out

    def read(self, partition: InputPartition):
        import pyarrow as pa
        import pyarrow.parquet as pq

        schema = pa.schema([("value", pa.binary()), ("topic", pa.string()), ("timestamp", pa.timestamp("us", "UTC"))])
        path, (first, end) = partition.value
        at, file = filesystem(path)
        with at.open_input_file(file) as f:
            # Pages come through a buffer: a reader holds pages and one batch, not whole row groups.
            parquet = pq.ParquetFile(f, coerce_int96_timestamp_unit="us", buffer_size=READ_BUFFER)
            for b in parquet.iter_batches(BATCH_ROWS, row_groups=range(first, end), columns=schema.names,
                                          use_threads=False):
                yield pa.RecordBatch.from_arrays([_as(b.column(c.name), c.type) for c in schema], schema=schema)


def _as(column, kind):
    import pyarrow as pa

    if pa.types.is_timestamp(column.type) and column.type.tz is None:
        column = column.cast(pa.timestamp(column.type.unit)).view(pa.timestamp(column.type.unit, "UTC"))
    return column.cast(kind)


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    rows: int = 0


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, txn: str):
        self.path, self.txn = path, txn

    def write(self, iterator) -> WrittenFiles:
        import pyarrow.parquet as pq

        at, folder = filesystem(self.path)
        name, writer, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        for b in iterator:
            if b.num_rows:
                if writer is None:
                    at.create_dir(folder, recursive=True)
                    stream = at.open_output_stream(f"{folder}/{name}")
                    writer = pq.ParquetWriter(stream, b.schema)
                writer.write_batch(b)
                rows += b.num_rows
        if writer is None:
            return WrittenFiles()
        writer.close()
        stream.close()
        return WrittenFiles([name], rows)

    def _manifest(self, epoch: int) -> str:
        return f"{self.txn}-{epoch:012d}.json"

    def commit(self, messages, batchId: int) -> None:
        at, folder = filesystem(self.path)
        name = self._manifest(batchId)
        if name in _names(at, f"{folder}/{EPOCHS}"):
            self.abort(messages, batchId)  # committed before: the files of this run are surplus
            return
        at.create_dir(f"{folder}/{EPOCHS}", recursive=True)
        done = [m for m in messages if m is not None]
        _replace(at, f"{folder}/{EPOCHS}/{name}", json.dumps(
            {"txn": self.txn, "epoch": batchId, "rows": sum(m.rows for m in done),
             "files": [f for m in done for f in m.files]}))

    def abort(self, messages, batchId: int) -> None:
        at, folder = filesystem(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                at.delete_file(f"{folder}/{f}")


class TopicLog(DataSource):
    """Options: ``path``; reading: ``positions``, ``slices_per_batch`` (1); writing: ``txn`` (name of the query)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return RAW_TOPIC

    def streamReader(self, schema) -> SliceReader:
        return SliceReader(self.options["path"], self.options["positions"],
                           int(self.options.get("slices_per_batch", 1)))

    def streamWriter(self, schema, overwrite: bool) -> EpochWriter:
        return EpochWriter(self.options["path"], self.options.get("txn", "main"))


def register(spark: SparkSession) -> None:
    """Make the format known to the session (and the module to every Python process of it)."""
    import sys

    from pyspark import cloudpickle

    ship_package(spark)
    # Offsets and commits run in processes of the driver that do not see addPyFile.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicLog)


def slice_of(seconds: int):
    return F.floor(F.unix_seconds("timestamp") / F.lit(int(seconds))).cast("long")


def write_slices(raw: DataFrame, path: str, slice_seconds: int, mode: str = "append") -> None:
    """Append raw topic rows to a sliced log, by arrival time.

    Rows are spread by (slice, hash), so a slice that holds most of the rows
    is still written by many tasks."""
    spread = F.pmod(F.xxhash64("value", "timestamp"), F.lit(8))
    (raw.select("value", "topic", "timestamp", slice_of(slice_seconds).alias("slice"))
     .repartition("slice", spread).write.mode(mode).partitionBy("slice").parquet(path))


def close_log(path: str) -> None:
    """No more slices will come: the newest one may be read."""
    at, folder = filesystem(path)
    at.create_dir(folder, recursive=True)
    _replace(at, f"{folder}/{CLOSED}", "")


def read_slices(spark: SparkSession, path: str, positions: str, slices_per_batch: int = 1) -> DataFrame:
    """A sliced log as a stream, whole slices in arrival order."""
    register(spark)
    return (spark.readStream.format(FORMAT).option("path", path).option("positions", positions)
            .option("slices_per_batch", slices_per_batch).load())


def committed_files(spark: SparkSession, path: str) -> list[str]:
    """The files that manifests name: one short list, like any table's file index."""
    at, folder = filesystem(path)
    out = []
    for name in sorted(_names(at, f"{folder}/{EPOCHS}")):
        if name.endswith(".json"):
            with at.open_input_stream(f"{folder}/{EPOCHS}/{name}") as f:
                out += json.loads(f.read())["files"]
    return out


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed epochs of a log that ``EpochWriter`` wrote."""
    files = [f"{path}/{f}" for f in committed_files(spark, path)]
    if not files:
        return spark.createDataFrame([], RAW_TOPIC)
    return spark.read.schema(RAW_TOPIC).parquet(*files)
