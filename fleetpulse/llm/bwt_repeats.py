"""Suffix-array dedup by threshold-bounded interval expansion (operator 9).

A byte is removed when a ``min_bytes``-byte string that covers it also starts
in a document with a smaller doc_id; strings never cross documents.

Sharding.  No task can hold the suffixes of a corpus, so equal strings are
first brought together.  Of every ``min_bytes`` window the k-mer with the
smallest hash is its anchor (a minimizer): equal windows have equal anchors at
equal places.  Anchors that two documents share are found from 6-byte
fingerprints; around each shared anchor the bytes of the windows that may own
it are cut out as a context.  Equal contexts of a chunk travel once, to the
shard of the bytes that all their windows have in common.

Expansion.  A shard's distinct contexts form one collection.  Its
Burrows-Wheeler transform is expanded backwards, breadth first: an interval of
suffixes that begin with w becomes, per preceding byte c, the interval of cw,
and the right end of an interval not met before gets the common prefix length
of the present round.  Lengths thus come out by increasing value, and the
rounds stop at ``min_bytes``: borders still open join suffixes that share a
whole window.  Each such group knows its smallest doc_id, and the answer goes
back to the chunks that hold the context.

Anchors of more than ``HEAVY`` documents (edges of a passage that a third of
the corpus repeats) have many distinct contexts.  Their windows are dealt out
in groups of ``HEAVY_GROUP`` starts, by the longer bytes those have in common.

Exact copies are combined before any shuffle: of equal texts that meet in one
task only that with the smallest doc_id goes on, the others are repeated
whole.  Chunks are dealt by text, so what copies remain meet there.
Documents are written once, bucketed by chunk; the passes over them need no
further shuffle of texts.  What moves between chunks and shards is packed.

Defined cases: null and empty texts have 0 bytes and nothing to remove; a text
shorter than ``min_bytes`` neither loses bytes nor makes others lose any; rows
with equal doc_id do not remove from each other; a null doc_id counts as
larger than any other; one result row per input row.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textops
from .common import BINARY, INT, LONG, STRING, Scratch, field, map_arrow, runs

MIN_BYTES = 50
HEAVY = 1024
HEAVY_GROUP = 4
CHUNK_BYTES = 4 << 20
BLOCK = 128 << 10
PIECE = 250_000
LAST = np.int64(2**63 - 1)
_TOP = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_ORDER = np.uint64(0xD6E8FEB86659FD93)


# -- anchors and contexts of one block ------------------------------------------

class Block:
    """Prefix hashes, anchors and windows of a block of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, size: int = MIN_BYTES):
        self.data, self.off, self.size = data, off, size
        self.k = k = size // 2
        n = len(data)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(textops.BYTE_VALUE[data] * textops.powers(n), out=self.total[1:])
        self.inv = textops.powers(n + 1, inverse=True)
        self.at = np.zeros(0, np.int64)
        if n < size:
            return
        h = self.total[k:] - self.total[:-k]
        h *= self.inv[:n - k + 1]
        low = h * _ORDER  # the order of k-mers: high bits of a product, then place
        low &= _TOP
        low |= np.arange(len(h), dtype=np.uint64)
        span, width = 1, size - k + 1
        while span < width:
            step = min(span, width - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        valid = np.zeros(n - size + 1, np.int64)
        long = np.diff(off) >= size
        first, last = off[:-1][long], off[1:][long] - size
        np.add.at(valid, first, 1)
        np.add.at(valid, last[last + 1 < len(valid)] + 1, -1)
        place = (low & _LOW).astype(np.int64)[np.cumsum(valid) > 0]
        self.at = place[np.r_[True, place[1:] != place[:-1]]] if len(place) else place
        self.doc = np.searchsorted(off, self.at, "right") - 1
        self.anchor = textops.mix(h[self.at])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return textops.mix((self.total[b] - self.total[a]) * self.inv[a])

    def contexts(self, at: np.ndarray, doc: np.ndarray, group: int):
        """doc, start, end, shard key, hash of the contexts around anchors.

        Windows that contain the k-mer at ``p`` start in [p - reach, p]; they are
        taken ``group`` at a time, and all windows of a context cover its key bytes.
        """
        reach = self.size - self.k
        out = []
        for o in range(0, reach + 1, group):
            a = at - reach + o
            z = at - reach + min(o + group - 1, reach)
            lo, hi = np.maximum(a, self.off[doc]), np.minimum(z, self.off[doc + 1] - self.size)
            ok = lo <= hi
            a, z, lo, hi, d = a[ok], z[ok], lo[ok], hi[ok], doc[ok]
            key = self.hash(z, a + self.size)
            ends = hi + self.size
            ctx = self.hash(lo, ends) ^ textops.mix((ends - lo).astype(np.uint64))
            out.append((d, lo, ends, key, ctx))
        return [np.concatenate(x) for x in zip(*out, strict=True)]


def _print(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Fingerprint of an anchor: 44 bits of its hash, and its bucket below them."""
    return (anchor & ~np.uint64(0xFFFFF)) | (anchor % np.uint64(buckets))


def _distinct_texts(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct texts of a chunk, the least doc_id of each, and each row's text
    (-1: a copy that was settled before)."""
    text = pc.fill_null(table["text"].combine_chunks(), "")
    ids = np.array([LAST if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
    code = text.dictionary_encode()
    which = code.indices.to_numpy().astype(np.int64)
    which[table["copied"].is_valid().to_numpy()] = -1
    least = np.full(len(code.dictionary), LAST, np.int64)
    np.minimum.at(least, which[which >= 0], ids[which >= 0])
    return code.dictionary, least, which


# -- expansion ------------------------------------------------------------------

def suffix_order(text: np.ndarray, left: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted up to their separator (ties by place), and the packed first
    ``63 // bits`` symbols of each place.  ``left``: bytes from a place to its
    separator.  Symbols are packed, then ranks are doubled."""
    n, per = len(text), 63 // bits
    packed = np.zeros(n, np.uint64)
    padded = np.r_[text, np.zeros(per, text.dtype)]
    for j in range(per):
        packed = (packed << np.uint64(bits)) | np.where(left > j, padded[j:j + n], 0).astype(np.uint64)
    key, have = packed, per
    while True:
        order = np.argsort(key)
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, k[1:] != k[:-1]])
        if have >= depth:
            return np.argsort(rank * np.int64(n) + np.arange(n)), packed
        nxt = np.zeros(n, np.int64)
        live = np.flatnonzero(left >= have)
        nxt[live] = rank[live + have] + 1
        key = rank * np.int64(n + 1) + nxt
        have *= 2


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals, and each place's interval."""
    size = hi - lo
    own = np.repeat(np.arange(len(lo)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + lo[own], own


def bounded_prefixes(order: np.ndarray, text: np.ndarray, left: np.ndarray, packed: np.ndarray, bits: int,
                     limit: int) -> np.ndarray:
    """Longest common prefixes of neighbours in suffix order, -1 where >= ``limit``.

    Lengths below ``start`` are read off the packed first symbols; from there the
    intervals of equal beginnings are expanded backwards, one byte a round.
    """
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.zeros(n, text.dtype)  # the transform: 0 where a context begins
    inner = np.flatnonzero((order > 0) & (text[order - 1] != 0))
    before[inner] = text[order[inner] - 1]
    back = np.zeros(n, np.int64)  # where the suffix one byte longer stands
    back[inner] = place[order[inner] - 1]
    lcp = np.full(n + 1, -1, np.int16)
    lcp[0] = lcp[n] = 0
    # First lengths: the highest bit in which neighbours' packed symbols differ.
    start = min(63 // bits, limit - 1)
    k = packed[order]
    differ = k[1:] ^ k[:-1]
    high = np.frexp((differ & ~(differ >> np.uint64(1))).astype(np.float64))[1]
    equal = (63 // bits * bits - high) // bits
    equal = np.minimum(equal, np.minimum(left[order[1:]], left[order[:-1]]))
    known = np.flatnonzero(equal < start)
    lcp[known + 1] = equal[known]
    edge = np.flatnonzero(lcp != -1)
    lo, hi = edge[:-1], edge[1:]
    # Beginnings that run into a separator before ``start`` are closed: the
    # separator ends them.  They still precede longer ones, as single suffixes.
    for size in range(start, limit):
        if not len(lo):
            break
        at, own = _ranges(lo, hi)
        some = before[at] != 0
        to, own = back[at[some]], own[some]
        o = np.argsort(to)
        to, own = to[o], own[o]
        if not len(to):
            break
        new = np.r_[True, (own[1:] != own[:-1]) | (text[order[to[1:]]] != text[order[to[:-1]]])]
        first = to[new]
        end = to[np.r_[np.flatnonzero(new)[1:] - 1, len(to) - 1]] + 1
        fresh = lcp[end] == -1
        lo, hi = first[fresh], end[fresh]
        lcp[hi] = size
    return lcp[1:n]


def expand(contexts: list[bytes] | np.ndarray, lengths: np.ndarray, owner: np.ndarray,
           size: int = MIN_BYTES) -> np.ndarray:
    """Bit masks of the contexts: bit i is set when the window that starts at byte i
    also stands in a context whose ``owner`` is smaller than this one's."""
    raw = np.frombuffer(b"".join(contexts), np.uint8) if isinstance(contexts, list) else contexts
    present = np.zeros(256, bool)
    present[raw] = True
    code = (np.cumsum(present) * present).astype(np.int16)
    n, m = len(raw) + len(lengths), len(lengths)
    ends = np.cumsum(lengths + 1) - 1  # separators
    text = np.zeros(n, np.int16)
    body = np.ones(n, bool)
    body[ends] = False
    text[body] = code[raw]
    context = np.repeat(np.arange(m), lengths + 1)
    left = ends[context] - np.arange(n)
    bits = max(1, int(present.sum()).bit_length())
    order, packed = suffix_order(text, left, bits, int(lengths.max()) + 1 if m else 1)
    lcp = bounded_prefixes(order, text, left, packed, bits, size)
    group = np.cumsum(np.r_[0, lcp != -1])
    own = owner[context[order]]
    least = np.minimum.reduceat(own, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))[group]
    hit = np.flatnonzero((least < own) & (left[order] >= size))
    at = order[hit]
    mask = np.zeros(m, np.uint64)
    first = ends - lengths
    np.bitwise_or.at(mask, context[at], np.uint64(1) << (at - first[context[at]]).astype(np.uint64))
    return mask


# -- passes -----------------------------------------------------------------------

def _pack(rows: list, target: np.ndarray, arrays: list[np.ndarray], sender: int) -> None:
    """Append (target, sender, packed arrays) rows, one per distinct target."""
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    t = target[order]
    cut = np.flatnonzero(np.r_[True, t[1:] != t[:-1], True])
    moved = [a[order] for a in arrays]
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        rows.append((int(t[a]), sender, *[x[a:b].tobytes() for x in moved]))


def _table(rows: list, fields: list[T.StructField]) -> pa.Table:
    schema = to_arrow_schema(T.StructType(fields))
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _settle_copies(docs: DataFrame, chunks: int, size: int) -> DataFrame:
    """chunk, doc_id, text, copied: of rows with equal texts in one task those with a
    larger doc_id than one before keep only their size (``copied``)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("k1"),
                       F.xxhash64(F.lit(2), F.col("text")).alias("k2"), F.xxhash64("doc_id").alias("u"))

    def run(batches):
        seen: dict = {}
        for b in batches:
            n = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            ids, k1, k2, u = (b.column(i).to_pylist() for i in (0, 2, 3, 4))
            copied, chunk = [], []
            for i, x, y, other, m in zip(ids, k1, k2, u, n, strict=True):
                i = int(LAST) if i is None else i
                least = seen.get((x, y))
                copy = m >= size and least is not None and least < i
                if least is None or i < least:
                    seen[x, y] = i
                copied.append(m if copy else None)
                chunk.append((other if copy else x) % chunks)
            copied = pa.array(copied, pa.int64())
            yield [pa.array(chunk, pa.int32()), b.column(0),
                   pc.if_else(copied.is_valid(), pa.scalar(None, b.column(1).type), b.column(1)), copied]

    return map_arrow(rows, rows.columns, [field("chunk", INT), field("doc_id", LONG), field("text", STRING),
                                          field("copied", LONG)], run)


def _fingerprints(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """bucket, chunk, prints: 6 bytes per distinct anchor of the chunk (44 bits of hash,
    4 bits for the logarithm of its documents)."""
    fields = [field("bucket", INT), field("chunk", INT), field("prints", BINARY)]

    def run(batches):
        for t in runs(batches, 1):
            rows, found = [], []
            texts, _, _ = _distinct_texts(t)
            for _, _, data, off in textops.blocks(texts, block_bytes=BLOCK):
                b = Block(data, off, size)
                if len(b.at):
                    # once per document: its anchors, sorted, without repeats
                    o = np.lexsort((b.anchor, b.doc))
                    a, d = b.anchor[o], b.doc[o]
                    found.append(a[np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]])
            if found:
                a, n = np.unique(np.concatenate(found), return_counts=True)
                entry = (a >> np.uint64(20) << np.uint64(4)) | np.minimum(np.log2(n), 15).astype(np.uint64)
                six = entry[:, None].view(np.uint8)[:, :6]
                _pack(rows, (a % np.uint64(buckets)).astype(np.int64), [six], t["chunk"][0].as_py())
            if rows:
                yield _table(rows, fields).combine_chunks().to_batches()[0].columns

    return map_arrow(docs, ["chunk", "doc_id", "text", "copied"], fields, run)


def _unpack(prints: list) -> tuple[np.ndarray, np.ndarray]:
    """Entries of packed 6-byte prints, and the row each came from."""
    sizes = [len(p) // 6 for p in prints]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, 6)
    return raw.view(np.uint64).ravel(), np.repeat(np.arange(len(prints)), sizes)


def _shared(prints: DataFrame) -> DataFrame:
    """chunk, shared, heavy: fingerprints of the chunk that several documents have."""
    fields = [field("chunk", INT), field("shared", BINARY), field("heavy", BINARY)]

    def run(batches):
        for t in runs(batches, 1):
            bucket, chunks = t["bucket"][0].as_py(), t["chunk"].to_pylist()
            entry, row = _unpack(t["prints"].to_pylist())
            value = entry >> np.uint64(4)
            docs = np.left_shift(1, (entry & np.uint64(15)).astype(np.int64))
            _, at = np.unique(value, return_inverse=True)
            total = np.bincount(at, weights=docs)[at]
            keys = (value << np.uint64(20)) | np.uint64(bucket)
            rows = []
            for i, chunk in enumerate(chunks):
                own = slice(*np.searchsorted(row, [i, i + 1]))
                k, n = keys[own], total[own]
                if (n > 1).any():
                    rows.append((chunk, k[(n > 1) & (n <= HEAVY)].tobytes(), k[n > HEAVY].tobytes()))
            if rows:
                yield _table(rows, fields).combine_chunks().to_batches()[0].columns

    return map_arrow(prints.repartition("bucket").sortWithinPartitions("bucket"), ["bucket", "chunk", "prints"],
                     fields, run)


def _keys(table: pa.Table, column: str) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(x for x in table[column].to_pylist() if x), np.uint64))


def _among(x: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


CONTEXTS = [field("shard", INT), field("chunk", INT), field("keys", BINARY), field("hashes", BINARY),
            field("owners", BINARY), field("lengths", BINARY), field("bytes", BINARY)]


def _contexts(docs: DataFrame, shared: DataFrame, buckets: int, shards: int, size: int) -> DataFrame:
    """The distinct contexts of each chunk, packed per shard, with their least doc_id."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if left.num_rows and right.num_rows:
            chunk = left["chunk"][0].as_py()
            light, heavy = _keys(right, "shared"), _keys(right, "heavy")
            texts, ids, _ = _distinct_texts(left)
            parts = []
            for i, _, data, off in textops.blocks(texts, block_bytes=BLOCK):
                b = Block(data, off, size)
                if not len(b.at):
                    continue
                f = _print(b.anchor, buckets)
                for keys, group in ((light, size), (heavy, HEAVY_GROUP)):
                    own = _among(f, keys)
                    if own.any():
                        d, lo, end, key, ctx = b.contexts(b.at[own], b.doc[own], group)
                        parts.append(_distinct(data, ids[i + d], lo, end, key, ctx))
            if parts:
                key, ctx, owner, length = (np.concatenate([p[k] for p in parts]) for k in range(4))
                raw = b"".join(p[4] for p in parts)
                start = np.cumsum(length) - length
                # blocks of a chunk may repeat a context: the least owner of each goes
                o = np.lexsort((owner, ctx, key))
                o = o[np.r_[True, (ctx[o][1:] != ctx[o][:-1]) | (key[o][1:] != key[o][:-1])]]
                shard = (key[o] % np.uint64(shards)).astype(np.int64)
                s = np.argsort(shard, kind="stable")
                o, shard = o[s], shard[s]
                cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
                for a, z in zip(cut[:-1], cut[1:], strict=True):
                    x = o[a:z]
                    rows.append((int(shard[a]), chunk, key[x].tobytes(), ctx[x].tobytes(), owner[x].tobytes(),
                                 length[x].astype(np.uint8).tobytes(),
                                 b"".join(raw[p:p + n] for p, n in zip(start[x].tolist(), length[x].tolist(), strict=True))))
        return _table(rows, CONTEXTS)

    return (docs.groupBy("chunk").cogroup(shared.groupBy("chunk"))
            .applyInArrow(run, T.StructType(CONTEXTS)))


def _distinct(data: np.ndarray, owner: np.ndarray, lo: np.ndarray, end: np.ndarray, key: np.ndarray, ctx: np.ndarray):
    """key, hash, least owner, length and bytes of the distinct contexts of a block."""
    o = np.lexsort((owner, ctx, key))
    o = o[np.r_[True, (ctx[o][1:] != ctx[o][:-1]) | (key[o][1:] != key[o][:-1])]]
    length = end[o] - lo[o]
    at, _ = _ranges(lo[o], end[o])
    return key[o], ctx[o], owner[o], length, data[at].tobytes()


RESULTS = [field("chunk", INT), field("hashes", BINARY), field("owners", BINARY), field("masks", BINARY),
           field("heavy", BINARY)]


def _resolved(contexts: DataFrame, size: int) -> DataFrame:
    """chunk, hashes, owners, masks: what the shards found about a chunk's contexts."""

    def run(batches):
        for t in runs(batches, 1):
            chunks = t["chunk"].to_pylist()
            packed = {c: t[c].to_pylist() for c in ("keys", "hashes", "owners", "lengths", "bytes")}
            flat = lambda c, kind: np.frombuffer(b"".join(packed[c]), kind)  # noqa: E731, B023
            key, ctx, owner = flat("keys", np.uint64), flat("hashes", np.uint64), flat("owners", np.int64)
            length, raw = flat("lengths", np.uint8).astype(np.int64), flat("bytes", np.uint8)
            row = np.repeat(np.arange(len(chunks)), [len(x) // 8 for x in packed["keys"]])
            start = np.cumsum(length) - length
            # Distinct contexts by (key, hash): the shard's own copies of a context.
            o = np.lexsort((owner, ctx, key))
            head = np.r_[True, (ctx[o][1:] != ctx[o][:-1]) | (key[o][1:] != key[o][:-1])]
            which = np.empty(len(o), np.int64)
            which[o] = np.cumsum(head) - 1
            one = o[head]
            least, mask = owner[one], np.zeros(len(one), np.uint64)
            # A context alone with its key shares no window with a different one.
            keys = key[one]
            same = keys[1:] == keys[:-1]
            work = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
            # Pieces end where the key changes, so windows that may be equal stay together.
            last = np.r_[keys[work][1:] != keys[work][:-1], True]
            filled, a = np.cumsum(length[one[work]] + 1), 0
            while a < len(work):
                z = int(np.searchsorted(filled, (filled[a - 1] if a else 0) + PIECE))
                z = min(max(z, a), len(work) - 1)
                z = z + int(np.argmax(last[z:])) + 1
                piece = work[a:z]
                at, _ = _ranges(start[one[piece]], start[one[piece]] + length[one[piece]])
                mask[piece] = expand(raw[at], length[one[piece]], least[piece], size)
                a = z
            known = (least[which] < owner) | (mask[which] != 0)
            rows = []
            for i, chunk in enumerate(chunks):
                x = np.flatnonzero(known & (row == i)) if len(chunks) < 4 else None
                if x is None:
                    lo, hi = np.searchsorted(row, [i, i + 1])
                    x = lo + np.flatnonzero(known[lo:hi])
                if len(x):
                    rows.append((chunk, ctx[x].tobytes(), least[which[x]].tobytes(), mask[which[x]].tobytes(), None))
            if rows:
                yield _table(rows, RESULTS).combine_chunks().to_batches()[0].columns

    return map_arrow(contexts.repartition("shard").sortWithinPartitions("shard"),
                     [f.name for f in CONTEXTS], RESULTS, run)


OUT = [field("doc_id", LONG), field("n_bytes", LONG), field("n_removed", LONG), field("n_spans", LONG),
       field("kept_sha256", STRING)]


def _removed(docs: DataFrame, results: DataFrame, buckets: int, size: int, keep_text: bool) -> DataFrame:
    fields = OUT + ([field("kept", BINARY)] if keep_text else [])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, ids, which = _distinct_texts(left)
        heavy = _keys(right, "heavy")
        flat = lambda c, kind: np.frombuffer(b"".join(x or b"" for x in right[c].to_pylist()), kind)
        known, owners, masks = flat("hashes", np.uint64), flat("owners", np.int64), flat("masks", np.uint64)
        o = np.argsort(known)
        known, owners, masks = known[o], owners[o], masks[o]
        held = [(i, data, off) for i, _, data, off in textops.blocks(texts, block_bytes=BLOCK)]
        # The chunk's own least doc_id per context stands where a shard had nothing to add.
        found = []
        for i, data, off in held:
            b = Block(data, off, size)
            if not len(b.at):
                found.append(None)
                continue
            big = _among(_print(b.anchor, buckets), heavy)
            parts = [b.contexts(b.at[x], b.doc[x], g) for x, g in ((~big, size), (big, HEAVY_GROUP)) if x.any()]
            d, lo, end, _, ctx = (np.concatenate(x) for x in zip(*parts, strict=True))
            found.append((d, lo, end, ctx, ids[i + d]))
        every = [x for x in found if x is not None]
        if every:
            ctx, owner = np.concatenate([x[3] for x in every]), np.concatenate([x[4] for x in every])
            o = np.lexsort((owner, ctx))
            head = np.r_[True, ctx[o][1:] != ctx[o][:-1]]
            own_ctx, own_least = ctx[o][head], owner[o][head]
        done = []  # of each distinct text
        for (_, data, off), x in zip(held, found, strict=True):
            n = len(data)
            change = np.zeros(n + 1, np.int32)
            if x is not None:
                d, lo, end, ctx, owner = x
                least = own_least[np.searchsorted(own_ctx, ctx)]
                mask = np.zeros(len(ctx), np.uint64)
                if len(known):
                    slot = np.minimum(np.searchsorted(known, ctx), len(known) - 1)
                    hit = known[slot] == ctx
                    least = np.where(hit, np.minimum(least, owners[slot]), least)
                    mask = np.where(hit & (owner == owners[slot]), masks[slot], mask)
                whole = owner > least  # an equal context stands in an earlier document
                np.add.at(change, lo[whole], 1)
                np.add.at(change, end[whole], -1)
                some = np.flatnonzero(~whole & (mask != 0))
                for bit in range(size):
                    s = lo[some[(mask[some] >> np.uint64(bit)) & np.uint64(1) == 1]] + bit
                    if len(s):
                        np.add.at(change, s, 1)
                        np.add.at(change, s + size, -1)
            gone = np.cumsum(change)[:n] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = off[:-1][off[:-1] < n]
            begins[edge] = gone[edge]
            per = lambda f, off=off: np.diff(np.r_[0, np.cumsum(f)][off]).tolist()
            for j, (r, s) in enumerate(zip(per(gone), per(begins), strict=True)):
                a, z = int(off[j]), int(off[j + 1])
                kept = data[a:z][~gone[a:z]].tobytes() if r else data[a:z].tobytes()
                done.append((z - a, r, s, hashlib.sha256(kept).hexdigest(), *([kept] if keep_text else [])))
        nothing = (hashlib.sha256(b"").hexdigest(), *([b""] if keep_text else []))
        rows = []
        for i, k, m in zip(left["doc_id"].to_pylist(), which.tolist(), left["copied"].to_pylist(), strict=True):
            n = m if k < 0 else done[k][0]
            later = k < 0 or (LAST if i is None else i) > ids[k]
            rows.append((i, n, n, 1, *nothing) if later and n >= size else (i, *done[k]))
        return _table(rows, fields)

    return docs.groupBy("chunk").cogroup(results.groupBy("chunk")).applyInArrow(run, T.StructType(fields))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES,
                   keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) per row."""
    if not 8 <= min_bytes <= 100:
        raise ValueError("min_bytes must be from 8 to 100")
    spark = df.sparkSession
    scratch = Scratch(spark, "bwt")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Chunks grow with the corpus, so that packed rows keep several entries each.
    chunk_bytes = min(128 << 20, max(CHUNK_BYTES, total >> 12))
    chunks = max(1, -(-total // chunk_bytes))
    files = max(1, -(-chunks // 4))
    buckets = min(max(8, 2 * files), 1 << 20)
    shards = max(8, 4 * files)

    name = f"bwt_{uuid.uuid4().hex[:12]}"
    (_settle_copies(docs, chunks, min_bytes).repartition(files, "chunk").write.bucketBy(files, "chunk")
     .sortBy("chunk").option("path", scratch.path("docs")).option("compression", "zstd")
     .format("parquet").saveAsTable(name))
    docs = spark.table(name)
    prints = scratch.write(_fingerprints(docs.sortWithinPartitions("chunk"), buckets, min_bytes), "prints")
    shared = scratch.write(_shared(prints), "shared")
    scratch.drop("prints")
    results = scratch.write(
        _resolved(_contexts(docs, shared, buckets, shards, min_bytes), min_bytes)
        .unionByName(shared.where("length(heavy) > 0").select(
            "chunk", *[F.lit(None).cast("binary").alias(c) for c in ("hashes", "owners", "masks")], "heavy")), "results")
    out = scratch.write(_removed(docs, results, buckets, min_bytes, keep_text), "out")
    spark.sql(f"DROP TABLE {name}")
    for part in ("docs", "shared", "results"):
        scratch.drop(part)
    return out
