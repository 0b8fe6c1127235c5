"""The sliced topic log as a source with offsets and a sink with epochs."""

import os

import pyarrow as pa
import pytest

from conftest import at
from fleetpulse import schemas as S
from fleetpulse.config import run_dir
from fleetpulse.sources import topic_source as ts
from fleetpulse.streaming import runner


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def rows(spark, seconds):
    return spark.createDataFrame([(f"p{s}".encode(), "t", at(s)) for s in seconds], S.RAW_TOPIC)


def reader(base, most=1):
    return ts.SliceReader(f"{base}/log", f"{base}/positions", most)


def test_slices_are_offered_in_order_and_the_newest_one_stays_open(spark):
    base = local(run_dir(spark, "test-slices"))
    ts.write_slices(rows(spark, [0, 1, 25, 12, 13]), f"{base}/log", 10)
    first, second, third = (int(at(s).timestamp()) // 10 for s in (0, 10, 20))
    assert ts.sealed_slices(f"{base}/log") == [first, second]
    r = reader(base)
    begin = r.initialOffset()
    assert r.latestOffset() == {"slice": first}
    assert reader(base).latestOffset() == {"slice": second}          # a restarted reader goes on
    assert reader(base).latestOffset() == {"slice": second}          # the third slice may still grow
    ts.write_slices(rows(spark, [27]), f"{base}/log", 10)
    ts.close_log(f"{base}/log")
    assert reader(base).latestOffset() == {"slice": third}
    got = [v for p in r.partitions(begin, {"slice": third}) for b in r.read(p) for v in b.column(0).to_pylist()]
    assert sorted(got) == [b"p0", b"p1", b"p12", b"p13", b"p25", b"p27"]
    assert r.partitions({"slice": third}, {"slice": third}) == []
    batch = next(r.read(r.partitions(begin, {"slice": first})[0]))
    assert batch.column(2).to_pylist()[0].timestamp() in (at(0).timestamp(), at(1).timestamp())


def test_admission_takes_so_many_slices(spark):
    base = local(run_dir(spark, "test-admission"))
    ts.write_slices(rows(spark, range(0, 50, 10)), f"{base}/log", 10)
    ts.close_log(f"{base}/log")
    r, seen = reader(base, most=2), []
    for _ in range(4):
        seen.append(r.latestOffset()["slice"])
    zero = int(at(0).timestamp()) // 10
    assert seen == [zero + 1, zero + 3, zero + 4, zero + 4]


def batches(spark, base, log=None):
    """Run the log through a foreachBatch query; the payloads of each micro-batch."""
    got = {}

    def keep(df, batch_id):
        got[batch_id] = sorted(r.value.decode() for r in df.collect())

    src = ts.read_slices(spark, log or f"{base}/log", f"{base}/positions")
    q = (src.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/ckpt")
         .trigger(processingTime="0 seconds").start())
    runner.finish(q)
    return got


def test_one_query_replays_the_log_in_arrival_order_and_restarts(spark):
    base = local(run_dir(spark, "test-replay"))
    ts.write_slices(rows(spark, [31, 2, 12, 1]), f"{base}/log", 10)
    assert list(batches(spark, base).values()) == [["p1", "p2"], ["p12"]]   # the newest slice is open
    ts.write_slices(rows(spark, [33, 41]), f"{base}/log", 10)
    assert list(batches(spark, base).values()) == [["p31", "p33"]]
    ts.close_log(f"{base}/log")
    assert list(batches(spark, base).values()) == [["p41"]]
    assert list(batches(spark, base).values()) == []


def test_an_empty_closed_log_gives_nothing(spark):
    base = local(run_dir(spark, "test-empty-log"))
    ts.close_log(f"{base}/log")
    assert not any(batches(spark, base).values())
    assert ts.read_committed(spark, f"{base}/out").count() == 0


BATCH = pa.RecordBatch.from_arrays(
    [pa.array([b"a", b"b"]), pa.array(["t", "t"]), pa.array([at(0), at(1)], pa.timestamp("us", "UTC"))],
    ["value", "topic", "timestamp"])


def payloads(spark, path):
    return sorted(bytes(r.value) for r in ts.read_committed(spark, path).collect())


def test_an_epoch_counts_once_however_often_it_runs(spark):
    path = local(run_dir(spark, "test-epochs")) + "/out"
    w = ts.EpochWriter(path, "live")
    w.write(iter([BATCH]))                      # the task ended, the driver died before its commit
    assert payloads(spark, path) == []
    first = [w.write(iter([BATCH])), w.write(iter([])), None]
    w.commit(first, 0)
    assert payloads(spark, path) == [b"a", b"b"]
    again = [w.write(iter([BATCH]))]            # committed, but Spark did not learn of it: run again
    w.commit(again, 0)
    assert payloads(spark, path) == [b"a", b"b"]
    assert not set(again[0].files) & set(os.listdir(path))
    gone = [w.write(iter([BATCH]))]
    w.abort(gone, 1)
    assert payloads(spark, path) == [b"a", b"b"] and not set(gone[0].files) & set(os.listdir(path))
    ts.EpochWriter(path, "other").commit([w.write(iter([BATCH]))], 0)   # another query's epoch 0
    assert payloads(spark, path) == [b"a", b"a", b"b", b"b"]


@pytest.mark.parametrize("lost", [1, 2])
def test_a_batch_that_is_run_again_leaves_each_payload_once(spark, lost):
    """The last ``lost`` entries of Spark's commit log are gone: those batches ran, Spark runs the last again."""
    base = local(run_dir(spark, "test-rerun"))
    ts.write_slices(rows(spark, [1, 11, 12]), f"{base}/log", 10)
    ts.close_log(f"{base}/log")

    def run():
        src = ts.read_slices(spark, f"{base}/log", f"{base}/positions")
        runner.finish(runner.start_append(src, None, f"{base}/ckpt", fmt=ts.FORMAT, trigger={"processingTime": "0 seconds"},
                                          options={"path": f"{base}/out", "txn": "copy"}))

    run()
    want = [b"p1", b"p11", b"p12"]
    assert payloads(spark, f"{base}/out") == want
    commits = f"{base}/ckpt/commits"
    for n in sorted((f for f in os.listdir(commits) if f.isdigit()), key=int)[-lost:]:
        os.remove(f"{commits}/{n}")
        if os.path.exists(f"{commits}/.{n}.crc"):
            os.remove(f"{commits}/.{n}.crc")
    if lost == 2:  # Spark checks that its two logs fit: the last batch was not planned yet
        offsets = f"{base}/ckpt/offsets"
        n = max((f for f in os.listdir(offsets) if f.isdigit()), key=int)
        os.remove(f"{offsets}/{n}")
        if os.path.exists(f"{offsets}/.{n}.crc"):
            os.remove(f"{offsets}/.{n}.crc")
    run()
    assert payloads(spark, f"{base}/out") == want


def test_a_reader_holds_pages_not_whole_row_groups(tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from fleetpulse.sources import topic_source

    n = 200_000     # one row group of 40 MB
    table = pa.table({"value": pa.array([os.urandom(200) for _ in range(n)], pa.binary()), "topic": ["t"] * n,
                      "timestamp": pa.array([0] * n, pa.timestamp("us", "UTC"))})
    pq.write_table(table, tmp_path / "a.parquet", row_group_size=n, use_dictionary=False)
    reader, rows, before, most = topic_source.SliceReader(str(tmp_path), "", 1), 0, pa.total_allocated_bytes(), 0
    for b in reader.read(topic_source.SliceFile(str(tmp_path / "a.parquet"), (0, 1))):
        rows += b.num_rows
        most = max(most, pa.total_allocated_bytes() - before)
    assert rows == n and most < 12 << 20
