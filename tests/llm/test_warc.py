"""WARC writer and salvage reader: round trip, damage, edges."""

import base64
import gzip
import hashlib

import pyarrow as pa
import pytest

from conftest import SF001
from fleetpulse.llm import queries, warc
from fleetpulse.llm.common import Scratch, table


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parts(compress):
    pages = [(i, f"http://x/{i}", f"<p>page {i} WARC/1.1\r\n \x1f\x8b\x08 text</p>".encode() * (i + 1)) for i in range(6)]
    return [warc.record(i, u, p, hashlib.sha1(p).digest(), compress=compress) for i, u, p in pages]


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_recovers_what_follows_damage(compress):
    records = parts(compress)
    whole = b"".join(records)
    assert [r["id"] for _, _, r, _ in warc.salvage(whole)] == list(range(6))
    starts = [sum(map(len, records[:i])) for i in range(7)]
    flipped = bytearray(whole)
    for p in range(starts[2] + 30, starts[2] + 60):
        flipped[p] ^= 0xFF
    cases = {
        "flipped bytes": bytes(flipped), "cut head": whole[40:], "junk between": whole[:starts[3]] + b"junk" * 9 + whole[starts[3]:],
        "cut tail": whole[:-30]}
    lost = {"flipped bytes": {2}, "cut head": {0}, "junk between": set(), "cut tail": {5}}
    for name, data in cases.items():
        got = list(warc.salvage(data))
        assert {r["id"] for _, _, r, _ in got if r} == set(range(6)) - lost[name], name
        gaps = [(a, b, why) for a, b, r, why in got if r is None]
        assert gaps and all(why and b > a for a, b, why in gaps), name
        at = 0
        for a, b, _, _ in got:  # records and gaps cover the archive in order
            assert a == at
            at = b
        assert not data[at:].strip(b"\r\n")


def test_a_wrong_digest_is_quarantined():
    good = warc.record(1, None, b"abc", hashlib.sha1(b"abc").digest(), compress=False)
    bad = good.replace(b32(b"abc").encode(), b32(b"abd").encode())
    got = list(warc.salvage(bad + good))
    assert [(r and r["id"], why) for _, _, r, why in got] == [(None, "payload digest differs"), (1, None)]


@pytest.mark.parametrize("compress", [True, False])
def test_headers_may_have_any_length(compress):
    urls = ["http://x/" + "long path " * 9000, "http://x/WARC/1.1", "http://x/1"]
    records = [warc.record(i, u, b"abc", hashlib.sha1(b"abc").digest(), compress=compress) for i, u in enumerate(urls)]
    got = list(warc.salvage(b"".join(records)))
    assert [(r and r["url"], why) for _, _, r, why in got] == [(u.replace(" ", "%20"), None) for u in urls]
    if not compress:  # headers cut before their blank line end at the next version line
        got = list(warc.salvage(records[0][:90_000] + b"\r\n" + records[2]))
        assert [(r and r["id"], why) for _, _, r, why in got] == [(None, "headers do not end"), (2, None)]


def test_a_gap_is_logged_or_fails_the_job(spark):
    table(spark, SF001, "pages")
    folder = Scratch(spark, "test-warc").path("damaged")
    records = parts(False)
    data = b"".join(records[:2]) + b"junk" + b"".join(records[2:])
    spark.createDataFrame([(data,)], "value binary").selectExpr(
        "CAST(value AS STRING) AS value").write.text(folder)
    read = warc.read(spark, folder)
    assert sorted(r.id for r in read.where("gap IS NULL").collect()) == list(range(6))
    at = len(b"".join(records[:2]))
    assert [(r.start, r.end, r.reason) for r in warc.gaps(read).collect()] == [(at, at + 4, "no version line")]
    for run in (lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match=f"unreadable bytes {at} to {at + 4} of .*no version line"):
            run(warc.whole(read))


def test_zero_bytes_between_and_behind_records():
    records = parts(True)
    data = records[0] + b"\0" * 500 + records[1] + b"\0" * 10**6
    got = list(warc.salvage(memoryview(data)))
    assert [r["id"] for _, _, r, _ in got if r] == [0, 1]
    assert [(a, b) for a, b, r, _ in got if not r] == [(len(records[0]), len(records[0]) + 500)]
    assert list(warc.salvage(pa.py_buffer(data))) == got
    assert list(warc.salvage(b"")) == list(warc.salvage(pa.py_buffer(b""))) == []


def test_members_are_plain_gzip():
    assert b"WARC-Type: response" in gzip.decompress(b"".join(parts(True)))


def test_round_trip_and_edges(spark):
    table(spark, SF001, "pages")
    rows = [(1, "http://a b", "same"), (2, "u", "same"), (3, None, None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"),
            (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (7, "u", "long" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS id")
    for compress in (True, False):
        for min_bytes, same in ((0, "revisit"), (5, "response")):
            folder = Scratch(spark, "test-warc").path("a")
            warc.write(df, folder, compress=compress, min_bytes=min_bytes)
            got = warc.read(spark, folder).collect()
            assert not [r for r in got if r.gap] and len(got) == len(rows)
            kinds = sorted((r.id or 0, r.record_type, r.refers_to) for r in got)
            assert kinds[0] == (0, same, 2 if same == "revisit" else None)
            assert kinds[1] == (1, same, 2 if same == "revisit" else None)
            assert [k[1] for k in kinds if k[0] == 5] == ["response"] * 2
            for r in got:
                text = next(h for i, _, h in rows if i == r.id) or ""
                assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), b32(text.encode()))
    folder = Scratch(spark, "test-warc").path("none")
    warc.write(df.limit(0), folder)
    assert warc.read(spark, folder).collect() == []


def test_every_page_comes_back(spark):
    pages = table(spark, SF001, "pages")
    got = queries.op2_warc_salvage(spark, SF001)
    assert got.count() == pages.count() and got.where("record_type IS NULL").count() == 0
