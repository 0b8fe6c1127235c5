"""The columnar codec equals the protobuf runtime on any bytes, and on any rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from fleetpulse.functions import codec, wire

TOPIC_KIND = {"r": "rated", "t": "tipped", "j": "journey", "s": "stats"}
TYPES = {codec._out(name, t): t for k in TOPIC_KIND.values() for name, _, t in codec.WIRE[codec.MESSAGE_OF_KIND[k]]}
COLUMNS = list(TYPES)


def varint(v):
    out = b""
    while v > 127:
        out, v = out + bytes([v & 127 | 128]), v >> 7
    return out + bytes([v])


class Fuzz(random.Random):
    """Payloads that are nearly messages."""

    def overlong(self, e, most):
        return e[:-1] + bytes([e[-1] | 128]) + b"\x80" * self.randrange(most) + bytes([self.choice([0, 1, 2, 127])])

    def number(self):
        v = self.choice([self.randrange(300), self.getrandbits(self.choice([32, 35, 63, 64])), 2**64 - self.randrange(1, 9)])
        return self.overlong(varint(v), 9) if self.random() < 0.1 else varint(v)

    def text(self):
        return self.choice([b"", b"abc", b"driver-%d" % self.randrange(99), "naïve 你好🙂".encode(), b"\xff\xfe",
                            b"\xed\xa0\x80", b"\xc0\x80", b"\xc3", self.randbytes(self.randrange(5))])

    def instant(self):
        return b"".join(self.choice([
            lambda: b"\x08" + (varint(self.randrange(2**31)) if self.random() < 0.7 else self.number()),
            lambda: b"\x10" + (varint(self.randrange(10**9)) if self.random() < 0.7 else self.number()),
            lambda: self.field(3)])() for _ in range(self.randrange(4)))

    def field(self, depth=0):
        f = self.choice([1, 2, 9, 10, 15, 16, 100, 2**28, 0]) if self.random() < 0.2 else self.randrange(1, 10)
        w = self.choice([0, 1, 2, 3, 4, 5, 6, 7]) if self.random() < 0.2 else self.choice([0, 2, 2, 5])
        tag = varint(f << 3 | w)
        if self.random() < 0.02:
            tag = self.overlong(tag, 5)
        if w == 0:
            return tag + self.number()
        if w == 1:
            return tag + bytes(8)
        if w == 5:
            return tag + np.float32(self.choice([0.0, -0.0, 1.5, 3e38, math.nan])).tobytes()
        if w == 2:
            body = self.choice([self.text, self.text, self.instant])() if depth < 3 else b"x"
            size = varint(len(body))
            if self.random() < 0.04:
                size = self.choice([varint(len(body) + 1), varint(2**31), varint(2**35), self.overlong(size, 6)])
            return tag + size + body
        if w == 3:
            return tag + (self.field(depth + 1) if depth < 3 else b"") + (
                varint(f << 3 | 4) if self.random() < 0.8 else b"")
        return tag

    def message(self, kind):
        m = codec.message_classes()[codec.MESSAGE_OF_KIND[kind]]()
        for name, _, t in codec.WIRE[codec.MESSAGE_OF_KIND[kind]]:
            if t == "ts":
                ts = getattr(m, name)
                ts.seconds, ts.nanos = self.choice([0, 1577836800, -5, 253402300799, 253402300800]), \
                    self.choice([0, 123456789, 999999999, -1])
            elif self.random() < 0.8:
                setattr(m, name, {"str": self.choice(["", "a", "naïve 🙂", "x" * self.randrange(300)]),
                                  "u32": self.choice([0, 1, 128, 2**32 - 1]), "enum": self.choice([0, 3, 7, -1]),
                                  "f32": 1.25}[t])
        return m.SerializeToString()

    def row(self):
        topic = self.choice([*TOPIC_KIND, *TOPIC_KIND, "other", None])
        good = self.message(TOPIC_KIND.get(topic, "rated"))
        broken = bytearray(good)
        for _ in range(self.randrange(1, 4)):
            if broken:
                broken[self.randrange(len(broken))] = self.randrange(256)
        return topic, self.choice([good, bytes(broken), good[:self.randrange(len(good) + 1)], None,
                                   *[b"".join(self.field() for _ in range(self.randrange(6))) for _ in range(4)],
                                   self.randbytes(self.randrange(20))])


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_decode_equals_the_runtime_on_fuzzed_bytes(seed):
    fuzz = Fuzz(seed)
    rows = [fuzz.row() for _ in range(6000)]
    values, topics = pa.array([p for _, p in rows], pa.binary()), pa.array([t for t, _ in rows], pa.string())
    seen = 0
    for part in (slice(0, 6000), slice(41, 900), slice(7, 7)):
        some = rows[part]
        got = codec.decode_columns(values[part], topics[part], TOPIC_KIND, COLUMNS)
        for a in got:
            a.validate(full=True)
        kinds, ok, *columns = [a.to_pylist() for a in got]
        for i, (topic, payload) in enumerate(some):
            kind = TOPIC_KIND.get(topic)
            want = codec._by_runtime(kind, payload, COLUMNS) if kind and payload is not None else None
            assert ok[i] == (want is not None), (topic, payload)
            assert kinds[i] == (kind if ok[i] else None)
            for c, column in zip(COLUMNS, columns):
                assert same(column[i], (want or {}).get(c)), (topic, payload, c)
        seen += sum(ok)
    assert seen > 1000


def random_rows(fuzz, n):
    make = {"str": lambda: fuzz.choice([None, "", "driver-%d" % fuzz.randrange(9999), "naïve 🙂", "x" * fuzz.randrange(300)]),
            "u32": lambda: fuzz.choice([None, 0, 1, 127, 128, 2**32 - 1]),
            "enum": lambda: fuzz.choice([None, *codec.FINISH_REASONS]),
            "f32": lambda: fuzz.choice([None, 0.0, -0.0, 1.25]),
            "ts": lambda: fuzz.choice([None, 0, -1, -1500, 1577836800123, 253402300799999, -62135596800000])}
    arrow = {"str": pa.string(), "u32": pa.int64(), "enum": pa.string(), "f32": pa.float32(), "ts": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array([fuzz.choice(["rated", "tipped", "journey"]) for _ in range(n)], pa.string()),
         *[pa.array([make[t]() for _ in range(n)], arrow[t]) for t in TYPES.values()]], ["kind", *TYPES])


def by_runtime(batch, fixed):
    columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
    for i in range(batch.num_rows):
        kind = fixed or columns["kind"][i]
        msg = codec.message_classes()[codec.MESSAGE_OF_KIND[kind]]()
        for name, _, t in codec.WIRE[codec.MESSAGE_OF_KIND[kind]]:
            v = columns[codec._out(name, t)][i]
            if v is not None and t == "ts":
                ts = getattr(msg, name)
                ts.seconds, ts.nanos = v // 1000, v % 1000 * 1_000_000
                ts.SetInParent()
            elif v is not None:
                setattr(msg, name, codec.FINISH_REASONS.index(v) if t == "enum" else v)
        yield msg.SerializeToString()


@pytest.mark.parametrize("fixed", [None, "stats"])
def test_encode_equals_the_runtime(fixed):
    batch = random_rows(Fuzz(9), 5000)
    topic_of_kind = {k: t for t, k in TOPIC_KIND.items()}
    for part in (batch, batch.slice(11, 777), batch.slice(0, 0)):
        value, topic = codec.encode_columns(part, fixed, topic_of_kind)
        value.validate(full=True)
        assert value.to_pylist() == list(by_runtime(part, fixed))
        assert topic.to_pylist() == [topic_of_kind[fixed or k] for k in part.column("kind").to_pylist()]


def test_encode_refuses_unknown_kinds():
    batch = random_rows(Fuzz(1), 3).set_column(0, "kind", pa.array(["rated", "??", None]))
    with pytest.raises(ValueError, match="unknown kind"):
        codec.encode_columns(batch, None, {})


def test_varints_of_every_length():
    numbers = [0, 1, 127, 128, *[2**k - 1 for k in range(8, 65, 7)], *[2**k for k in range(7, 64, 7)], 2**64 - 1]
    raw = np.frombuffer(b"".join(map(varint, numbers)), np.uint8)
    ends = np.cumsum([len(varint(n)) for n in numbers])
    v = np.array(numbers, np.uint64)
    assert wire.varint_sizes(v).tolist() == [len(varint(n)) for n in numbers]
    starts = ends - wire.varint_sizes(v)
    value, size = wire.varints(raw, starts, ends, wire.LONGEST_VARINT)
    assert (value == v).all() and (starts + size == ends).all()
    _, short = wire.varints(raw, starts, ends - 1, wire.LONGEST_VARINT)
    assert not short.any()
