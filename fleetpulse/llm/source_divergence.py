"""Source divergence audit with a minimal acyclic transducer vocabulary (operator 13).

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  A
language keeps the terms that stand in at least ``MIN_DOCS`` of its documents.
The kept terms are sorted and cut into ranges of at most ``RANGE_TERMS``; each
range becomes one minimal acyclic transducer, built from its sorted terms,
that maps a term to its lexicographic ordinal within the language.  The terms
of the texts, summed per task first, stream through the transducer of their
range, which drops terms outside the vocabulary; from there on a term is its
ordinal, also where ties are broken.

For a group (lang, source) with ``count`` of a term, N of all kept terms and V
kept terms in the language, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in
exact decimals.  ``pair`` rows compare a group with each other source of its
language by the sum of \\|p - q\\| over all kept terms; ``term`` rows are its
50 terms furthest above the language's own p.

Scale: texts are read twice, each time into sums per task; counts shuffle by
(lang, term), term ranges by (lang, range, salt), the matrix of a pair sum by
(lang, block of ordinals), so neither a language nor a source nor a frequent
term lands in one task.  A task holds one transducer, or one block of terms
of all sources.  The only broadcast is what the planner takes below its own
size threshold; the first terms of the ranges join by language.

Defined cases: null text, lang and source are empty strings; a group whose
texts have no kept term has count 0 throughout; a language without kept terms
has pair rows of value 0 and no term rows; a language with one source has no
pair rows; rows count as often as they stand, whatever their ids; very long
texts are cut at term ends while reading; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import BINARY, INT, LONG, STRING, Scratch, field, map_arrow, runs

MIN_DOCS = 30
TOP_TERMS = 50
#: Terms of a transducer, and ordinals of a block of the pair sums.
RANGE_TERMS = 1 << 16
BLOCK_TERMS = 1 << 12
#: Sums held by a task before they are passed on, and bytes of text cut at once.
HELD_SUMS = 400_000
PIECE_BYTES = 4 << 20

#: The runs of the contract, in UTF-8 bytes after A-Z are lower-cased: every
#: byte of a non-ASCII character is 0x80 or more.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms(text: bytes):
    """Lists of the lower-cased terms of a text, of a bounded piece each."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE_BYTES)
        if end < len(text):
            tail = TERM.match(text[end:end + PIECE_BYTES].lower())
            while tail:
                end += tail.end()
                tail = TERM.match(text[end:end + PIECE_BYTES].lower())
        yield TERM.findall(text[at:end].lower())
        at = end


# -- the transducer ---------------------------------------------------------------

class Transducer:
    """Minimal acyclic transducer of sorted byte strings: term -> place in the order.

    States are numbered; a state has a 256-bit map of its outgoing bytes, and
    its edges stand one after the other in byte order.  An edge carries the
    number of terms that sort before its own within the state; the sum along
    a path is the term's ordinal.
    """

    PARTS = (("bits", np.uint64), ("before", np.int32), ("target", np.int32), ("out", np.int64), ("final", np.bool_))

    def __init__(self, bits, before, target, out, final):
        self.bits, self.before, self.target, self.out, self.final = bits, before, target, out, final

    @classmethod
    def build(cls, ordered: list[bytes]) -> "Transducer":
        """From strictly ascending terms; states that accept the same endings are one."""
        register: dict = {}
        edges: list[tuple] = []   # of each frozen state: ((byte, target), ...)
        ends: list[bool] = []
        below: list[int] = []     # terms that a state accepts

        def freeze(final: bool, out: list) -> int:
            key = (final, tuple(out))
            state = register.get(key)
            if state is None:
                state = register[key] = len(edges)
                edges.append(key[1])
                ends.append(final)
                below.append(final + sum(below[t] for _, t in out))
            return state

        path: list[list] = [[False, []]]  # the states of the last term, not frozen yet
        last = b""
        for term in ordered:
            if not last < term:
                raise ValueError("terms are not in strictly ascending order")
            same = 0
            for a, b in zip(last, term):
                if a != b:
                    break
                same += 1
            while len(path) > same + 1:
                final, out = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(final, out)))
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
            last = term
        while len(path) > 1:
            final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, out)))
        root = freeze(*path[0])

        n = len(edges)
        bits, before = np.zeros((n + 1, 4), np.uint64), np.zeros((n + 1, 4), np.int32)
        target, weight = [], []
        for s, out in enumerate(edges):
            words, at, skipped = [0, 0, 0, 0], [0, 0, 0, 0], int(ends[s])
            first = len(target)
            for k, (byte, t) in enumerate(out):
                words[byte >> 6] |= 1 << (byte & 63)
                at[byte >> 6] += 1
                target.append(t)
                weight.append(skipped)
                skipped += below[t]
            bits[s] = words
            before[s] = first + np.cumsum([0, *at[:3]])
        # State n is the start: a copy of the root, whose number is not fixed.
        bits[n], before[n] = bits[root], before[root]
        return cls(bits, before, np.array(target, np.int32), np.array(weight, np.int64),
                   np.array([*ends, ends[root]], np.bool_))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of each byte run of ``data``, -1 for runs that are no term; one round per byte place."""
        state = np.full(len(starts), len(self.final) - 1, np.int64)
        total = np.zeros(len(starts), np.int64)
        size = ends - starts
        live = np.arange(len(starts))
        place = 0
        while True:
            done = size[live] == place
            total[live[done & ~self.final[state[live]]]] = -1
            live = live[~done]
            if not len(live):
                return total
            byte = data[starts[live] + place].astype(np.int64)
            word = self.bits[state[live], byte >> 6]
            bit = np.uint64(1) << (byte & 63).astype(np.uint64)
            known = (word & bit) != 0
            total[live[~known]] = -1
            live, byte, word, bit = live[known], byte[known], word[known], bit[known]
            edge = self.before[state[live], byte >> 6] + np.bitwise_count(word & (bit - np.uint64(1))).astype(np.int64)
            total[live] += self.out[edge]
            state[live] = self.target[edge]
            place += 1

    def terms(self):
        """All terms in order."""
        stack = [(len(self.final) - 1, b"")]
        while stack:
            state, prefix = stack.pop()
            if self.final[state]:
                yield prefix
            found = []
            for w in range(4):
                word, edge = int(self.bits[state, w]), int(self.before[state, w])
                while word:
                    low = word & -word
                    found.append((int(self.target[edge]), prefix + bytes([64 * w + low.bit_length() - 1])))
                    word ^= low
                    edge += 1
            stack.extend(reversed(found))

    def pack(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, name), kind) for name, kind in self.PARTS]
        return np.array([len(self.final), len(self.target)], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def unpack(cls, raw: bytes) -> "Transducer":
        states, edges = np.frombuffer(raw, np.int64, 2)
        at, got = 16, []
        for (_, kind), shape in zip(cls.PARTS, ((states, 4), (states, 4), (edges,), (edges,), (states,)), strict=True):
            n = int(np.prod(shape))
            got.append(np.frombuffer(raw, kind, n, at).reshape(shape))
            at += n * np.dtype(kind).itemsize
        return cls(*got)


# -- passes over the texts ----------------------------------------------------------

def document_frequency(docs: DataFrame) -> DataFrame:
    """lang, term (binary), docs: terms that stand in at least ``MIN_DOCS`` documents of the language."""
    def run(batches):
        held: dict[str, Counter] = defaultdict(Counter)
        size = 0

        def flush():
            for lang, c in held.items():
                if c:
                    yield [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()),
                           pa.array(list(c.values()), pa.int64())]
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                seen = set()
                for part in terms(text.as_py()):
                    seen.update(part)
                c = held[lang]
                size -= len(c)
                c.update(seen)
                size += len(c)
                if size > HELD_SUMS:
                    yield from flush()
                    size = 0
        yield from flush()

    each = map_arrow(docs, ["lang", "text"],
                     [field("lang", STRING), field("term", BINARY), field("docs", LONG)], run)
    return each.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS)


def build_ranges(kept: DataFrame, partitions: int) -> DataFrame:
    """lang, first (its first term), n, machine: one row per range of kept terms, in order."""
    ordered = kept.select("lang", "term").repartitionByRange(partitions, "lang", "term") \
        .sortWithinPartitions("lang", "term")

    def run(batches):
        def rows(lang, held):
            return [pa.array([lang], pa.string()), pa.array([held[0]], pa.binary()), pa.array([len(held)], pa.int64()),
                    pa.array([Transducer.build(held).pack()], pa.binary())]

        last, held = None, []
        for b in batches:
            for lang, term in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held and (lang != last or len(held) == RANGE_TERMS):
                    yield rows(last, held)
                    held = []
                last = lang
                held.append(term)
        if held:
            yield rows(last, held)

    return map_arrow(ordered, ["lang", "term"], [field("lang", STRING), field("first", BINARY), field("n", LONG),
                                                 field("machine", BINARY)], run)


def text_sums(docs: DataFrame) -> DataFrame:
    """lang, source, blob (sorted terms, one a line), sums: occurrences per task, many terms a row."""
    def run(batches):
        held: dict[tuple, Counter] = defaultdict(Counter)
        size = 0

        def flush():
            for (lang, source), c in held.items():
                names = sorted(c)
                yield [pa.array([lang], pa.string()), pa.array([source], pa.string()),
                       pa.array([b"\n".join(names)], pa.binary()),
                       pa.array([np.array([c[t] for t in names], np.int64).tobytes()], pa.binary())]
            held.clear()

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                for part in terms(text.as_py()):
                    if part:
                        c = held[lang, source]
                        size -= len(c)
                        c.update(part)
                        size += len(c)
                if size > HELD_SUMS:
                    yield from flush()
                    size = 0
        yield from flush()

    return map_arrow(docs, ["lang", "source", "text"], [field("lang", STRING), field("source", STRING),
                                                        field("blob", BINARY), field("sums", BINARY)], run)


def route(sums: DataFrame, starts: DataFrame, salts: int) -> DataFrame:
    """text_sums cut at the ranges' first terms: lang, range, salt, kind 1, source, blob, sums."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for lang, source, blob, sums_, firsts in zip(*(c.to_pylist() for c in b.columns)):
                names, counts = blob.split(b"\n"), np.frombuffer(sums_, np.int64)
                at = [bisect_left(names, f["first"]) for f in firsts] + [len(names)]
                salt = zlib.crc32(blob) % salts
                for k in range(len(firsts)):
                    i, j = at[k], at[k + 1]
                    if i < j:
                        for col, v in zip(out, (lang, firsts[k]["range"], salt, 1, source,
                                                b"\n".join(names[i:j]), counts[i:j].tobytes()), strict=True):
                            col.append(v)
            yield out

    joined = sums.join(starts, "lang").select("lang", "source", "blob", "sums", "firsts")
    return map_arrow(joined, joined.columns, ROUTED, run)


ROUTED = [field("lang", STRING), field("range", INT), field("salt", INT), field("kind", INT), field("source", STRING),
          field("blob", BINARY), field("sums", BINARY)]


def recount(routed: DataFrame, ranges: DataFrame, salts: int, partitions: int) -> DataFrame:
    """lang, source, ordinal, n: occurrences of the kept terms, through the transducers."""
    machines = ranges.select(
        "lang", "range", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
        F.col("offset").cast("string").alias("source"), F.col("machine").alias("blob"),
        F.lit(b"").alias("sums"))
    rows = routed.unionByName(machines).repartition(partitions, "lang", "range", "salt") \
        .sortWithinPartitions("lang", "range", "salt", "kind")

    def run(batches):
        machine, offset = None, 0
        held: dict[tuple, np.ndarray] = {}

        def flush():
            for (lang, source), total in held.items():
                at = np.flatnonzero(total)
                yield [pa.array([lang] * len(at), pa.string()), pa.array([source] * len(at), pa.string()),
                       pa.array(at + offset, pa.int64()), pa.array(total[at], pa.int64())]
            held.clear()

        for b in batches:
            for lang, _, _, kind, source, blob, sums_ in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    yield from flush()
                    machine, offset = Transducer.unpack(blob), int(source)
                    continue
                data = np.frombuffer(blob, np.uint8)
                cut = np.flatnonzero(data == 10)
                got = machine.ordinals(data, np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(data)]]))
                known = got >= 0
                total = held.get((lang, source))
                if total is None:
                    if len(held) >= 64:
                        yield from flush()
                    total = held[lang, source] = np.zeros(RANGE_TERMS, np.int64)
                total[got[known]] += np.frombuffer(sums_, np.int64)[known]
        yield from flush()

    each = map_arrow(rows, [c for c in rows.columns], [field("lang", STRING), field("source", STRING),
                                                       field("ordinal", LONG), field("n", LONG)], run)
    return each.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


# -- the comparison -------------------------------------------------------------------

def _p(count: str, total: str, v: str):
    """1 + floor(10^9 (count + 5) / (N + 5 V)), exact."""
    wide = lambda e: f"CAST({e} AS DECIMAL(25, 0))"
    return F.expr(f"1 + CAST((1000000000 * ({wide(count)} + 5)) div ({wide(total)} + 5 * {wide(v)}) AS BIGINT)")


def pair_sums(counts: DataFrame, groups: DataFrame, partitions: int) -> DataFrame:
    """lang, source, item, value: sums of \\|p - q\\| over all kept terms, both ways.

    ``counts`` has lang, source, ordinal, p; ``groups`` lang, source, v and p0
    (p of a term that the group lacks).  Every group comes to every block of
    its language, so each block sees the whole row set of the comparison.
    """
    blocks = groups.select("lang", "source", "v", F.explode(F.expr(
        f"sequence(0L, greatest(v - 1, 0L) div {BLOCK_TERMS})")).alias("block"),
        F.lit(-1).cast("long").alias("ordinal"), F.col("p0").alias("p"))
    cells = counts.select("lang", "source", F.lit(0).cast("long").alias("v"),
                          F.expr(f"ordinal div {BLOCK_TERMS}").alias("block"), "ordinal", "p")
    rows = blocks.unionByName(cells).repartition(partitions, "lang", "block") \
        .sortWithinPartitions("lang", "block", "source", "ordinal")

    def run(batches):
        for t in runs(batches, 2):
            at = np.asarray(t.column(4))
            heads = np.flatnonzero(at < 0)  # one per source, before its cells
            names = t.column(2).take(pa.array(heads)).to_pylist()
            values, v, block = np.asarray(t.column(5)), int(t.column(3)[int(heads[0])].as_py()), t.column(1)[0].as_py()
            width = max(0, min(BLOCK_TERMS, v - block * BLOCK_TERMS))
            grid = np.repeat(values[heads][:, None], width, axis=1)
            row = np.cumsum(at < 0) - 1
            is_cell = at >= 0
            grid[row[is_cell], at[is_cell] - block * BLOCK_TERMS] = values[is_cell]
            lang = t.column(0)[0].as_py()
            for i, name in enumerate(names):
                total = np.abs(grid - grid[i]).sum(axis=1)
                others = [k for k in range(len(names)) if k != i]
                if others:
                    yield [pa.array([lang] * len(others), pa.string()), pa.array([name] * len(others), pa.string()),
                           pa.array([names[k] for k in others], pa.string()), pa.array(total[others], pa.int64())]

    each = map_arrow(rows, ["lang", "block", "source", "v", "ordinal", "p"],
                     [field("lang", STRING), field("source", STRING), field("item", STRING), field("value", LONG)], run)
    return each.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def vocabulary(ranges: DataFrame) -> DataFrame:
    """lang, ordinal, term (text): the transducers' terms in their order."""
    def run(batches):
        for b in batches:
            for lang, offset, raw in zip(*(c.to_pylist() for c in b.columns)):
                names = list(Transducer.unpack(raw).terms())
                yield [pa.array([lang] * len(names), pa.string()),
                       pa.array(np.arange(offset, offset + len(names)), pa.int64()),
                       pa.array(names, pa.binary()).cast(pa.string())]

    return map_arrow(ranges, ["lang", "offset", "machine"],
                     [field("lang", STRING), field("ordinal", LONG), field("term", STRING)], run)


def audit(spark: SparkSession, documents: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module text."""
    scratch = scratch or Scratch(spark, "divergence")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    docs = documents.select(*named, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    kept = scratch.write(document_frequency(docs), "kept")
    cut = max(1, min(partitions, -(-4 * kept.count() // RANGE_TERMS)))
    ranges = scratch.write(build_ranges(kept, cut), "machines")
    placed = ranges.select("lang", "first", "n").withColumns({
        "offset": F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("first").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)),
        "range": F.row_number().over(Window.partitionBy("lang").orderBy("first"))})
    placed = scratch.write(placed, "ranges")
    starts = placed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("first", "range"))).alias("firsts"))
    ranges = ranges.join(placed.select("lang", "first", "offset", "range"), ["lang", "first"])

    salts = max(1, partitions // max(1, placed.count()))
    counts = scratch.write(recount(route(text_sums(docs), starts, salts), ranges, salts, partitions), "counts")

    sizes = placed.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (documents.select(*named).distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                      F.coalesce("v", F.lit(0)).alias("v")))
    groups = scratch.write(groups.withColumn("p0", F.when(F.col("v") > 0, _p("0", "total", "v")).otherwise(0)),
                           "groups")
    rated = counts.join(groups.select("lang", "source", "total", "v"), ["lang", "source"]) \
        .withColumn("p", _p("n", "total", "v"))

    pairs = pair_sums(rated, groups, partitions)
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    q = whole.join(langs, "lang").select("lang", "ordinal", _p("n", "total", "v").alias("q"))
    above = rated.join(q, ["lang", "ordinal"]).where("p > q") \
        .select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = above.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP_TERMS)
    top = top.join(vocabulary(ranges), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    ranked = pairs.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(top)
