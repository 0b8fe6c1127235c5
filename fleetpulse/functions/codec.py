"""Protobuf wire codec for the topics (D1-D5, E1-E4), as Arrow batch passes.

No protobuf jar is on the classpath, so ``from_protobuf`` is not available.
The bytes of a whole Arrow batch are parsed and written column by column
(``wire``: numpy, in lockstep over the payloads) inside ``mapInArrow``: one
Arrow batch in, one Arrow batch out, no shuffle, run where the rows are.  The
Python side only turns bytes into ints and strings; instants, checks and
everything else stay JVM expressions.  The messages are described here
(``WIRE``); the protobuf runtime, built from the same description, reads the
rare payload with groups and is what the tests compare with.

Decode is chosen by topic, never by trial (a rating and a tip have the same
wire layout).  A payload that does not parse yields ``decode_ok = false``;
callers count and drop it.  So does a payload with an instant outside the
Timestamp range (years 1 to 9999, nanos 0 to 999,999,999): it has no instant
that could place it, and must not stop a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..config import ship_package
from ..schemas import FINISH_REASONS, SOURCE_TS, UNRECOGNIZED

# ---------------------------------------------------------------------------
# Wire layout of the four messages (field name, number, type).
# Types: str = string, u32 = uint32, ts = google.protobuf.Timestamp,
# enum = FinishReason, f32 = float.
# ---------------------------------------------------------------------------
WIRE = {
    "DriverRated": (("driver_id", 1, "str"), ("rider_id", 2, "str"), ("journey_id", 3, "str"),
                    ("rated_at", 4, "ts"), ("rating", 5, "u32")),
    "DriverTipped": (("driver_id", 1, "str"), ("rider_id", 2, "str"), ("journey_id", 3, "str"),
                     ("tipped_at", 4, "ts"), ("amount", 5, "u32")),
    "JourneyFinished": (("journey_id", 1, "str"), ("driver_id", 2, "str"), ("rider_id", 3, "str"),
                        ("finish_reason", 4, "enum"), ("started_at", 5, "ts"),
                        ("ended_at", 6, "ts"), ("distance", 7, "u32"), ("price", 8, "u32")),
    "DriverStats": (("driver_id", 1, "str"), ("interval_start", 2, "ts"),
                    ("interval_end", 3, "ts"), ("total_drop_offs", 4, "u32"),
                    ("total_driver_cancels", 5, "u32"), ("total_distance", 6, "u32"),
                    ("total_price", 7, "u32"), ("total_tips", 8, "u32"), ("avg_rating", 9, "f32")),
}
# FinishReason numbers are the positions in schemas.FINISH_REASONS
# (DROP_OFF 0, RIDER_CANCEL 1, DRIVER_CANCEL 2, ADMIN_CANCEL 3).
MESSAGE_OF_KIND = {"rated": "DriverRated", "tipped": "DriverTipped",
                   "journey": "JourneyFinished", "stats": "DriverStats"}
UINT32_MAX = 4294967295
# Range of google.protobuf.Timestamp: 0001-01-01T00:00:00Z to 9999-12-31T23:59:59.999999999Z.
MIN_SECONDS, MAX_SECONDS = -62135596800, 253402300799
MAX_NANOS = 999999999
_PACKAGE = "fleetpulse.wire"

_CLASSES = None


def message_classes() -> dict:
    """Message classes, built once per Python process (they do not pickle)."""
    global _CLASSES
    if _CLASSES is None:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory, timestamp_pb2

        FD = descriptor_pb2.FieldDescriptorProto
        kinds = {"str": FD.TYPE_STRING, "u32": FD.TYPE_UINT32, "ts": FD.TYPE_MESSAGE,
                 "enum": FD.TYPE_ENUM, "f32": FD.TYPE_FLOAT}
        fdp = descriptor_pb2.FileDescriptorProto(
            name="fleetpulse/wire.proto", package=_PACKAGE, syntax="proto3",
            dependency=["google/protobuf/timestamp.proto"])
        enum = fdp.enum_type.add(name="FinishReason")
        for number, name in enumerate(FINISH_REASONS):
            enum.value.add(name=name, number=number)
        for msg, fields in WIRE.items():
            m = fdp.message_type.add(name=msg)
            for name, number, kind in fields:
                f = m.field.add(name=name, number=number, type=kinds[kind], label=FD.LABEL_OPTIONAL)
                if kind == "ts":
                    f.type_name = ".google.protobuf.Timestamp"
                elif kind == "enum":
                    f.type_name = f".{_PACKAGE}.FinishReason"
        pool = descriptor_pool.DescriptorPool()
        pool.AddSerializedFile(timestamp_pb2.DESCRIPTOR.serialized_pb)
        pool.Add(fdp)
        _CLASSES = {msg: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{_PACKAGE}.{msg}"))
                    for msg in WIRE}
    return _CLASSES


# ---------------------------------------------------------------------------
# Decode
# ---------------------------------------------------------------------------

def _field_types() -> dict:
    """Output column and Spark type of every wire field (timestamps as epoch ms)."""
    out = {}
    for fields in WIRE.values():
        for name, _, kind in fields:
            if kind == "ts":
                out[name + "_ms"] = T.LongType()
            elif kind in ("str", "enum"):
                out[name] = T.StringType()
            elif kind == "u32":
                out[name] = T.LongType()
            else:
                out[name] = T.FloatType()
    return out


ARROW_TYPE = {"str": "string", "u32": "int64", "f32": "float", "ts": "int64", "enum": "string"}


def _out(name: str, kind: str) -> str:
    return name + "_ms" if kind == "ts" else name


def _by_runtime(kind: str, payload: bytes, columns: list) -> dict | None:
    """One payload through the protobuf runtime: the wanted columns, None if it is refused.

    Only payloads with groups come here, which no message of ours has.
    """
    from google.protobuf.message import DecodeError

    msg = message_classes()[MESSAGE_OF_KIND[kind]]()
    try:
        msg.ParseFromString(payload)
    except (DecodeError, ValueError, RuntimeError):
        return None
    out = {}
    for name, _, ftype in WIRE[MESSAGE_OF_KIND[kind]]:
        v = getattr(msg, name)
        if ftype == "ts":
            if not msg.HasField(name):
                v = None
            elif not (MIN_SECONDS <= v.seconds <= MAX_SECONDS and 0 <= v.nanos <= MAX_NANOS):
                return None
            else:
                v = v.seconds * 1000 + v.nanos // 1_000_000
        elif ftype == "enum":
            v = FINISH_REASONS[v] if 0 <= v < len(FINISH_REASONS) else UNRECOGNIZED
        if _out(name, ftype) in columns:
            out[_out(name, ftype)] = v
    return out


def decode_columns(values, topics, topic_kind: dict, columns: list):
    """kind, decode_ok and ``columns`` of a batch of payloads, as Arrow arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from . import wire

    n = len(values)
    raw, start, end, valid = wire.flat(values)
    names, kinds = list(topic_kind), sorted(set(topic_kind.values()))
    where = pc.fill_null(pc.index_in(topics, value_set=pa.array(names, topics.type)), -1).to_numpy(zero_copy_only=False)
    kind_of = np.array([*(kinds.index(topic_kind[t]) for t in names), -1])[where]
    ok, by_runtime = np.zeros(n, bool), {}
    ftypes = {_out(f, t): t for k in kinds for f, _, t in WIRE[MESSAGE_OF_KIND[k]]}
    has = {c: np.zeros(n, bool) for c in columns}
    first = {c: start.copy() for c in columns if ftypes[c] == "str"}
    size = {c: np.zeros(n, np.int64) for c in first}
    number = {c: np.zeros(n, np.float32 if ftypes[c] == "f32" else np.int64) for c in columns if c not in first}
    for k, kind in enumerate(kinds):
        rows = np.flatnonzero(valid & (kind_of == k))
        layout = WIRE[MESSAGE_OF_KIND[kind]]
        got = wire.parse(raw, start[rows], end[rows], {num: t for _, num, t in layout})
        good = got.ok & ~got.groups
        instants = {}
        for _, num, t in layout:
            if t == "ts":
                # Milliseconds, sub-millisecond digits dropped; nanos is an int32.
                s, ns = got.values[num].view(np.int64), got.nanos[num].astype(np.uint32).view(np.int32).astype(np.int64)
                good &= ~got.has[num] | ((s >= MIN_SECONDS) & (s <= MAX_SECONDS) & (ns >= 0) & (ns <= MAX_NANOS))
                instants[num] = s, ns
        for r in np.flatnonzero(got.groups & got.ok).tolist():
            by_runtime[int(rows[r])] = _by_runtime(kind, raw[start[rows[r]]:end[rows[r]]].tobytes(), columns)
        at = rows[good]
        ok[at] = True
        for f, num, t in layout:
            c = _out(f, t)
            if c not in has:
                continue
            has[c][at] = got.has[num][good] if t == "ts" else True
            if t == "str":
                first[c][at], size[c][at] = got.starts[num][good], got.sizes[num][good]
            elif t == "ts":
                s, ns = (x[good] for x in instants[num])
                number[c][at] = np.where(got.has[num][good], s, 0) * 1000 + ns // 1_000_000
            elif t == "f32":
                number[c][at] = got.values[num][good].astype(np.uint32).view(np.float32)
            else:
                number[c][at] = got.values[num][good] & np.uint64(UINT32_MAX)
    reasons = pa.array([*FINISH_REASONS, UNRECOGNIZED], pa.string())
    arrays = {}
    for c in columns:
        if c in first:
            arrays[c] = wire.cut(raw, first[c], size[c], has[c], pa.string())
        elif ftypes[c] == "enum":
            arrays[c] = reasons.take(pa.array(np.minimum(number[c], len(FINISH_REASONS)), mask=~has[c]))
        else:
            arrays[c] = pa.array(number[c], ARROW_TYPE[ftypes[c]], mask=~has[c])
    kind_column = pa.array(kinds, pa.string()).take(pa.array(np.maximum(kind_of, 0), mask=~ok)) if kinds else None
    arrays = {"kind": kind_column, "decode_ok": pa.array(ok), **arrays}
    refused = {r for r, got in by_runtime.items() if got is None}
    rest = sorted(set(by_runtime) - refused)
    if rest:
        mask = np.zeros(n, bool)
        mask[rest] = True
        extra = {c: [by_runtime[r].get(c) for r in rest] for c in columns}
        extra |= {"kind": [kinds[kind_of[r]] for r in rest], "decode_ok": [True] * len(rest)}
        arrays = {c: pc.replace_with_mask(a, pa.array(mask), pa.array(extra[c], a.type)) for c, a in arrays.items()}
    return list(arrays.values())


def _decode_batches(batches, topic_kind, columns, keep):
    import pyarrow as pa

    for batch in batches:
        arrays = decode_columns(batch.column("value"), batch.column("topic"), topic_kind, columns)
        arrays += [batch.column(k) for k in keep]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "decode_ok", *columns, *keep])


def decode(raw: DataFrame, topic_kind: dict, keep: tuple = (), skip: tuple = ()) -> DataFrame:
    """Decode ``(value, topic, timestamp, *keep)`` rows by topic.

    ``topic_kind`` maps topic names to 'rated' / 'tipped' / 'journey' /
    'stats'.  Returns ``kind``, ``decode_ok``, the fields of those messages
    (timestamps as instants, null when not set), ``source_ts`` (the row's
    arrival time) and the ``keep`` columns.  Rows of other topics or with
    malformed payloads come back with ``decode_ok = false``.  ``topic`` is
    always carried through.  ``skip`` names fields the caller does not need;
    they are parsed but never leave Python.
    """
    ship_package(raw.sparkSession)
    kinds = set(topic_kind.values())
    types = _field_types()
    columns = []
    for k in ("rated", "tipped", "journey", "stats"):
        if k in kinds:
            for name, _, ftype in WIRE[MESSAGE_OF_KIND[k]]:
                c = name + "_ms" if ftype == "ts" else name
                if c not in columns and name not in skip:
                    columns.append(c)
    keep = tuple(k for k in keep if k != "topic")
    keep_all = ("topic", "__arrival_us", *keep)
    src = raw.selectExpr("value", "topic", "unix_micros(timestamp) AS __arrival_us",
                         *[f"`{k}`" for k in keep])
    schema = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("decode_ok", T.BooleanType())]
        + [T.StructField(c, types[c]) for c in columns]
        + [src.schema[k] for k in keep_all])
    tk = dict(topic_kind)
    decoded = src.mapInArrow(lambda it: _decode_batches(it, tk, columns, keep_all), schema)
    out = []
    for f in schema.fields:
        if f.name == "__arrival_us":
            out.append(f"timestamp_micros(__arrival_us) AS {SOURCE_TS}")
        elif f.name.endswith("_ms") and f.name in types:
            out.append(f"timestamp_millis({f.name}) AS {f.name[:-3]}")
        else:
            out.append(f"`{f.name}`")
    return decoded.selectExpr(*out)


# ---------------------------------------------------------------------------
# Encode
# ---------------------------------------------------------------------------

def encode_columns(batch, kind_fixed: str | None, topic_of_kind: dict) -> list:
    """value and topic of a batch of rows, as Arrow arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from . import wire

    n = batch.num_rows
    known = list(MESSAGE_OF_KIND) if kind_fixed is None else [kind_fixed]
    code = np.zeros(n, np.int64) if kind_fixed is not None else pc.fill_null(
        pc.index_in(batch.column("kind"), value_set=pa.array(known, batch.column("kind").type)), -1
    ).to_numpy(zero_copy_only=False)
    if (code < 0).any():
        raise ValueError(f"rows of an unknown kind: {set(batch.column('kind').to_pylist()) - set(known)}")

    def column(name: str, ftype: str, rows: np.ndarray):
        c = batch.column(_out(name, ftype))
        if ftype == "str":
            raw, first, last, valid = wire.flat(c)
            return raw, first[rows], last[rows], valid[rows]
        if ftype == "enum":
            c = pc.index_in(c, value_set=pa.array(FINISH_REASONS, c.type))
        valid = ~np.asarray(c.is_null())
        # E3, floor form: nanos always in [0, 10^9).
        return pc.fill_null(c, 0).to_numpy(zero_copy_only=False)[rows], valid[rows]

    messages = []
    for k, kind in enumerate(known):
        rows = np.flatnonzero(code == k)
        if len(rows):
            messages.append((rows, [wire.Field(num, t, column(name, t, rows))
                                    for name, num, t in WIRE[MESSAGE_OF_KIND[kind]]]))
    topics = pa.array([topic_of_kind.get(k) for k in known], pa.string())
    return [wire.serialize(n, messages), topics.take(pa.array(code))]


def _encode_batches(batches, kind_fixed, topic_of_kind, keep):
    import pyarrow as pa

    for batch in batches:
        arrays = [*encode_columns(batch, kind_fixed, topic_of_kind), *[batch.column(k) for k in keep]]
        yield pa.RecordBatch.from_arrays(arrays, ["value", "topic", *keep])


def _checked_u32(name: str) -> str:
    return (f"CASE WHEN {name} < 0 OR {name} > {UINT32_MAX} THEN "
            f"raise_error(concat('{name} out of uint32 range: ', CAST({name} AS STRING))) "
            f"ELSE {name} END")


def _checked_reason() -> str:
    # An unsupported finish reason fails the job.
    names = ", ".join(f"'{r}'" for r in FINISH_REASONS)
    return ("CASE WHEN finish_reason IS NOT NULL AND finish_reason NOT IN (" + names + ") THEN "
            "raise_error(concat('Unsupported finish reason ', finish_reason)) "
            "ELSE finish_reason END")


def encode(df: DataFrame, topic_of_kind: dict, kind: str | None = None,
           arrival: str = SOURCE_TS, keep: tuple = ()) -> DataFrame:
    """Serialize rows to ``(value, topic, timestamp, *keep)``.

    ``kind`` fixes the message for every row (e.g. 'stats'); otherwise the
    ``kind`` column of a wide event frame picks it per row.  ``arrival``
    names the instant column that becomes the row timestamp.
    """
    ship_package(df.sparkSession)
    kinds = [kind] if kind else ["rated", "tipped", "journey"]
    cols = [] if kind else ["kind"]
    seen = set()
    for k in kinds:
        for name, _, ftype in WIRE[MESSAGE_OF_KIND[k]]:
            if name in seen:
                continue
            seen.add(name)
            if ftype == "ts":
                cols.append(f"unix_millis({name}) AS {name}_ms")
            elif ftype == "u32":
                cols.append(f"{_checked_u32(name)} AS {name}")
            elif ftype == "enum":
                cols.append(f"{_checked_reason()} AS {name}")
            else:
                cols.append(name)
    keep_all = ("__arrival_us", *keep)
    src = df.selectExpr(*cols, f"unix_micros({arrival}) AS __arrival_us", *[f"`{k}`" for k in keep])
    schema = T.StructType([T.StructField("value", T.BinaryType()),
                           T.StructField("topic", T.StringType())]
                          + [src.schema[k] for k in keep_all])
    tok = dict(topic_of_kind)
    enc = src.mapInArrow(lambda it: _encode_batches(it, kind, tok, keep_all), schema)
    return enc.selectExpr("value", "topic", "timestamp_micros(__arrival_us) AS timestamp",
                          *[f"`{k}`" for k in keep])
