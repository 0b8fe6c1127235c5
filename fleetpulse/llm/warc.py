"""WARC archives: writer, and a reader that salvages damaged files (operator 2).

Writing.  One record per page.  Of pages with equal payloads (SHA-1) the one
with the largest id is stored as ``response``; the others are ``revisit``
records that name it and carry no payload.  Records are gzip members (or
plain), packed into archives of about ``ARCHIVE_BYTES``, each a file of its own
in a folder Spark commits, so a lost executor leaves no half archive.

Reading.  Every record is checked: the gzip member ends well, the version
line, headers and Content-Length hold, the block is followed by two line
ends, the payload has its digest.  After a failed check the reader searches
for the next byte position that opens a valid gzip member or version line,
goes on there, and reports the bytes between as a quarantined gap.  ``whole``
makes a gap an error, for archives that must have none.  An archive is read by
one task, without a copy of its bytes in Python; Spark's binary source refuses files of 2 GB or more.

Defined cases: null html is an empty payload; equal empty payloads are
duplicates like others (``min_bytes`` 0); rows with equal id and payload are
responses all, as the same page; a null id is written as an empty id, reads
back null, and counts as smaller than any other; an empty table writes no
archive and reads back empty.  Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BINARY, LONG, STRING, field, map_arrow

ARCHIVE_BYTES = 8 << 20
EPOCH = "1970-01-01T00:00:00Z"  # archives of the same pages are the same bytes
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_OPEN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_HEAD_END = re.compile(rb"\r\n\r\n|\r\nWARC/1\.[01]\r\n")  # a blank line, or the next record without one
_MORE = re.compile(rb"[^\r\n\0]")
_STEP = 1 << 16


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to=None,
           revisit: bool = False, compress: bool = True) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, with the length of
    the payload it stands for, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)),
            ("WARC-Date", EPOCH), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
            ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}")]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", name(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    out = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    if compress:
        c = zlib.compressobj(4, zlib.DEFLATED, 31)
        out = c.compress(out) + c.flush()
    return out


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          min_bytes: int = 0, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` as archives into ``folder``.

    The winners of equal payloads come from one aggregation of (digest, id).
    Pages meet their winner in one join on the digest; a payload that a
    third of all pages share is a skewed key there, which AQE splits.
    """
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html"), F.sha1(body).alias("digest"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    winners = (rows.where(size >= min_bytes).groupBy("digest")
               .agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(winners, "digest", "left").select("id", "url", "html", "digest", "winner")

    def run(batches):
        held, size = [], 0
        for b in batches:
            for i, u, h, d, w in zip(*[c.to_pylist() for c in b.columns], strict=True):
                revisit = w is not None and i != w
                r = record(i, u, (h or "").encode(), bytes.fromhex(d), w, revisit, compress)
                held.append(r)
                size += len(r)
                if size >= archive_bytes:
                    yield [pa.array([b"".join(held)], pa.binary())]
                    held, size = [], 0
        if held:
            yield [pa.array([b"".join(held)], pa.binary())]

    archives = map_arrow(joined, joined.columns, [field("archive", BINARY)], run)
    # The text sink writes a value's bytes and a line end: the last byte of a
    # plain archive, and padding after the last member of a compressed one.
    value = F.col("archive") if compress else F.substring("archive", F.lit(1), F.octet_length("archive") - 1)
    (archives.select(value.cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).mode("overwrite").text(folder))


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """The gzip member that starts at ``at``: its content and its end."""
    z = zlib.decompressobj(31)
    out, pos = [], at
    while not z.eof:
        part = data[pos:pos + _STEP]
        if not len(part):
            raise ValueError("member cut short")
        out.append(z.decompress(part))
        pos += len(part)
    return b"".join(out), pos - len(z.unused_data)


def _parse(data, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record whose version line is at ``at``."""
    m = _VERSION.match(data, at)
    if not m:
        raise ValueError("no version line")
    end = _HEAD_END.search(data, m.end())
    if not end or end[0] != b"\r\n\r\n":
        raise ValueError("headers do not end")
    head = {}
    for line in bytes(data[m.end():end.start()]).split(b"\r\n"):
        k, colon, v = line.partition(b":")
        if not colon:
            raise ValueError("header without a colon")
        head[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d+", head.get("content-length", "")):
        raise ValueError("no Content-Length")
    start = end.end()
    stop = start + int(head["content-length"])
    if stop + 4 > len(data) or bytes(data[stop:stop + 4]) != b"\r\n\r\n":
        raise ValueError("block does not end where Content-Length says")
    return head, bytes(data[start:stop]), stop + 4


def _record(head: dict, block: bytes) -> dict:
    """A checked record; raises when its digests or its HTTP header do not hold."""
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if name not in head:
            raise ValueError(f"no {name} header")
    kind, want = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
    if (whole := head.get("warc-block-digest", "").removeprefix("sha1:")) and whole != base32(hashlib.sha1(block).digest()):
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        payload = block if kind not in ("response", "revisit") else b""
    size = len(payload)
    if kind == "revisit":
        m = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size = int(m[1]) if m else None
    elif want and want != base32(hashlib.sha1(payload).digest()):
        raise ValueError("payload digest differs")
    ident = lambda v: (lambda m: int(m[1]) if m else None)(re.fullmatch(r"<urn:page:(-?\d+)>", v or ""))
    return {"type": kind, "id": ident(head.get("warc-record-id")), "refers_to": ident(head.get("warc-refers-to")),
            "url": head.get("warc-target-uri"), "digest": want or None, "size": size,
            "payload": payload if kind != "revisit" else None}


def salvage(data) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) of each good record, (start, end, None, reason)
    of each gap, in order; together they cover the archive (any bytes-like object),
    trailing line ends aside."""
    if not len(data):
        return
    view, at, n = memoryview(data).cast("B"), 0, len(data)  # Arrow buffers have signed items
    bad_from, reason = None, None
    while at < n:
        if not _MORE.search(view, at):
            break
        try:
            if view[at:at + 3] == b"\x1f\x8b\x08":
                content, end = _member(view, at)
                head, block, inner = _parse(content, 0)
                if inner != len(content):
                    raise ValueError("bytes after the record in its member")
            else:
                head, block, end = _parse(view, at)
            found = _record(head, block)
        except (ValueError, zlib.error) as e:
            if bad_from is None:
                bad_from, reason = at, str(e)
            nxt = _OPEN.search(view, at + 1)
            at = nxt.start() if nxt else n
            continue
        if bad_from is not None:
            yield bad_from, at, None, reason
            bad_from = None
        yield at, end, found, None
        at = end
    if bad_from is not None:
        yield bad_from, at, None, reason


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """archive, start, end and either a record (id, record_type, refers_to, url,
    payload_digest, payload_bytes, payload) or a gap (``gap`` says why)."""
    files = spark.read.format("binaryFile").load(folder)

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []

                def flush(rows=rows, name=name):
                    out = [pa.array([name] * len(rows), pa.string())]
                    for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                                           pa.string(), pa.int64(), pa.binary(), pa.string())):
                        out.append(pa.array([r[k] for r in rows], t))
                    rows.clear()
                    return out

                held = 0
                for start, end, r, gap in salvage(data.as_buffer()):
                    r = r or {}
                    body = r.get("payload") if payloads else None
                    rows.append((start, end, r.get("id"), r.get("type"), r.get("refers_to"), r.get("url"),
                                 r.get("digest"), r.get("size"), body, gap))
                    held += len(body or b"")
                    if held > ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield flush()
                        held = 0
                if rows:
                    yield flush()

    return map_arrow(files, ["path", "content"], [
        field("archive", STRING), field("start", LONG), field("end", LONG), field("id", LONG),
        field("record_type", STRING), field("refers_to", LONG), field("url", STRING),
        field("payload_digest", STRING), field("payload_bytes", LONG), field("payload", BINARY),
        field("gap", STRING)], run)


def whole(records: DataFrame) -> DataFrame:
    """The rows of archives that must be readable throughout: a gap fails the job, with its place and reason."""
    return records.where("""CASE WHEN gap IS NULL THEN true ELSE CAST(raise_error(concat(
        'unreadable bytes ', start, ' to ', end, ' of ', archive, ': ', gap)) AS BOOLEAN) END""")


def gaps(records: DataFrame) -> DataFrame:
    """The quarantine log: byte ranges that held no valid record, and why."""
    return records.where("gap IS NOT NULL").select("archive", "start", "end", F.col("gap").alias("reason"))
