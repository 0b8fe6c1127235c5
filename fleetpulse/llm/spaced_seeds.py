"""Benchmark decontamination by spaced-seed hashing (operator 8).

Words are lower-cased runs of letters, digits and non-ASCII characters.  A
mask names the positions of a window that count; the others may differ.  Each
benchmark item and each document is hashed under every mask at every word,
equal hashes are joined, and each hit is verified: along its diagonal an
overlap is any run of aligned words that starts and ends on an equal word, has
at least ``min_overlap`` words and ``min_identity`` of them equal, or the whole
item (of ``MIN_ITEM`` words or more) with that share equal.  A document is
contaminated by an item that has an overlap with it; of overlaps within one
another the longest is reported.

Seeds of the benchmark are broadcast only while their counted number is at
most ``max_broadcast_seeds`` (24 bytes each); beyond it both sides meet in a
shuffled join on the hash, with the same verification.  There a bitmap of
``2**FILTER_BITS`` bits marks the benchmark's seeds, and only the seeds of the
documents that it lets pass are shuffled.

Defined cases: null or empty text has no words and is clean; items with fewer
than ``MIN_ITEM`` words are ignored; an item shorter than ``MIN_OVERLAP`` is
sought as a whole, under masks of its own length; equal items are all reported; an empty benchmark marks
nothing; rows that repeat a doc_id are judged row by row.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .common import BOOL, INT, LONG, append_arrow, field, map_arrow, quoted

#: Masks in which six words count.  Every run of 13 words or more that starts
#: and ends on an equal word and has 80 % of them equal shows at least one of
#: them, wherever its substitutions stand (tests/llm walks all such runs).
MASKS = ("111111", "1011000111", "10110111", "11100010011")
SPAN = max(map(len, MASKS))
MIN_ITEM = 5
MIN_OVERLAP = 13
MIN_IDENTITY = 0.8
MAX_BROADCAST_SEEDS = 2_000_000
#: The bitmap's size is fixed: 8 MB, with at most one row per 64 bits sent to the driver.
FILTER_BITS = 26

#: Letters, digits and all non-ASCII bytes make words.
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_CARES = [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS]


def whole_masks(n: int) -> list[tuple[int, ...]]:
    """Places that count in an item of ``n`` < ``MIN_OVERLAP`` words sought as a whole.

    ``MIN_IDENTITY`` allows k substitutions.  Of k + 2 groups of places they leave
    at least two equal, and each two groups make a mask."""
    k = n - math.ceil(MIN_IDENTITY * n - 1e-6)
    groups = [range(n * i // (k + 2), n * (i + 1) // (k + 2)) for i in range(k + 2)]
    return [(*a, *b) for a, b in itertools.combinations(groups, 2)]


def seeds(h: np.ndarray, counts: np.ndarray, short: tuple[int, ...]):
    """(hash, first word, length) of every window under every mask, and of whole
    items of the ``short`` lengths; the mask is part of the hash.  The length is that
    of the items sought so, 0 for those of ``MIN_OVERLAP`` words or more."""
    for i, cares in enumerate(_CARES):
        got, at, _ = textops.window_hashes(h, counts, len(MASKS[i]), cares)
        yield got ^ textops.BYTE_VALUE[i], at, 0
    for n in short:
        for i, cares in enumerate(whole_masks(n)):
            got, at, _ = textops.window_hashes(h, counts, n, cares)
            yield got ^ textops.mix(textops.BYTE_VALUE[n:n + 1] + np.uint64(i)), at, n


def item_seeds(h: np.ndarray, counts: np.ndarray, short: tuple[int, ...]):
    """(hash, first word) of the seeds by which benchmark items are sought."""
    row = textops.rows_of(counts)
    for got, at, n in seeds(h, counts, short):
        size = counts[row[at]]
        mine = size == n if n else size >= MIN_OVERLAP
        yield got[mine], at[mine]


def short_lengths(sizes) -> tuple[int, ...]:
    return tuple(sorted({n for n in sizes if MIN_ITEM <= n < MIN_OVERLAP}))


def runs(same: np.ndarray, least: int, min_identity: float) -> list[tuple[int, int]]:
    """First, end of the runs of a 0/1 match vector that start and end on a match, have
    ``least`` places and ``min_identity`` of them equal, and lie in no other such run."""
    first = np.flatnonzero(same)
    end = first + 1
    score = np.r_[0, np.cumsum(same)] - min_identity * np.arange(len(same) + 1)
    tail = np.maximum.accumulate(score[end][::-1])  # of the last end, the last two, ...
    last = end[len(end) - 1 - np.searchsorted(tail, score[first] - 1e-6, "left")]
    first, last = first[last - first >= least], last[last - first >= least]
    new = np.flatnonzero(np.diff(np.maximum.accumulate(last), prepend=-1) > 0)
    return list(zip(first[new].tolist(), last[new].tolist(), strict=True))


def verify(doc: np.ndarray, item: np.ndarray, diagonal: int, min_overlap: int,
           min_identity: float) -> list[tuple[int, int]]:
    """(first document word, words) of the overlaps on a diagonal."""
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    if hi <= lo:
        return []
    same = doc[lo:hi] == item[lo - diagonal:hi - diagonal]
    if len(same) == len(item) and same.sum() >= min_identity * len(item) - 1e-6:
        return [(lo, len(item))]
    return [(lo + first, end - first) for first, end in runs(same, min(min_overlap, len(item)), min_identity)]


def item_words(texts: list) -> list[np.ndarray]:
    out = []
    for _, _, data, off in textops.blocks(pa.array(texts, pa.large_string()), lower=True):
        s, e, c = textops.words(data, off, SEPARATOR)
        out += np.split(textops.word_hashes(data, s, e), np.cumsum(c)[:-1])
    return out


class Index:
    """Seeds of a benchmark, sorted by hash."""

    def __init__(self, ids: list, texts: list):
        self.ids = ids
        self.words = item_words(texts)
        self.short = short_lengths(len(w) for w in self.words)
        hashes, items, places = [], [], []
        for k, w in enumerate(self.words):
            if len(w) < MIN_ITEM:
                continue
            for h, at in item_seeds(w, np.array([len(w)]), short_lengths([len(w)])):
                hashes.append(h)
                items.append(np.full(len(h), k))
                places.append(at)
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.hash, self.item, self.place = join(hashes, np.uint64), join(items, np.int64), join(places, np.int64)
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.item, self.place = self.hash[order], self.item[order], self.place[order]
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[self.hash & np.uint64((1 << 22) - 1)] = True

    def hits(self, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Distinct (text, item, diagonal) of the equal seeds of a block of texts."""
        first = np.cumsum(counts) - counts
        found = []
        for got, at, _ in seeds(h, counts, self.short):
            near = np.flatnonzero(self.bits[got & np.uint64((1 << 22) - 1)])
            lo = np.searchsorted(self.hash, got[near], "left")
            n = np.searchsorted(self.hash, got[near], "right") - lo
            if not n.any():
                continue
            at = np.repeat(at[near], n)
            seed = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            text = np.searchsorted(first, at, "right") - 1
            while (empty := counts[text] == 0).any():  # empty texts share their neighbour's start
                text[empty] -= 1
            found.append(np.stack([text, self.item[seed], at - first[text] - self.place[seed]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _fold(n: int, found: list[tuple[int, object, int, int]]) -> list:
    """Per-text columns from (text, item id, first, words) overlaps."""
    best: list = [{} for _ in range(n)]
    spans: list = [[] for _ in range(n)]
    for text, item, first, words in found:
        best[text][item] = max(words, best[text].get(item, 0))
        spans[text].append((first, first + words))
    top, size, covered = [], [], []
    for b, sp in zip(best, spans, strict=True):
        winner = min(b, key=lambda i: (-b[i], i)) if b else None
        top.append(winner)
        size.append(b[winner] if b else 0)
        total, end = 0, 0
        for lo, hi in sorted(sp):
            total += max(0, hi - max(lo, end))
            end = max(end, hi)
        covered.append(total)
    return [[bool(b) for b in best], [sorted(b) for b in best], top, size, covered]


FIELDS = [field("contaminated", BOOL), field("items", T.ArrayType(LONG)), field("best_item", LONG),
          field("best_overlap", INT), field("covered_words", LONG)]


def mark(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", min_overlap: int = MIN_OVERLAP, min_identity: float = MIN_IDENTITY,
         max_broadcast_seeds: int = MAX_BROADCAST_SEEDS) -> DataFrame:
    """``df`` plus contaminated, items, best_item, best_overlap, covered_words.

    ``best_item`` has the longest overlap (smallest id at a tie);
    ``covered_words`` counts the document's words inside any overlap.
    """
    spark = df.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")) \
        .where("text IS NOT NULL AND item IS NOT NULL")
    size = items.select(F.sum(F.length("text")).alias("n"), F.count(F.lit(1)).alias("k")).first()
    # A word and its separator are two characters at least: a bound on the seeds.
    if ((size["n"] or 0) / 2 + size["k"]) * (len(MASKS) + 1) > max_broadcast_seeds:
        return _mark_shuffled(df, items, text_col, min_overlap, min_identity)
    rows = sorted((r["item"], r["text"]) for r in items.collect())
    index = spark.sparkContext.broadcast(Index([r[0] for r in rows], [r[1] for r in rows]))

    def fn(texts):
        ix, found = index.value, []
        for i, _, data, off in textops.blocks(texts, lower=True):
            s, e, counts = textops.words(data, off, SEPARATOR)
            h = textops.word_hashes(data, s, e)
            edges = np.r_[0, np.cumsum(counts)]
            for text, k, diagonal in ix.hits(h, counts).tolist():
                for first, n in verify(h[edges[text]:edges[text + 1]], ix.words[k], diagonal,
                                       min_overlap, min_identity):
                    found.append((i + text, ix.ids[k], first, n))
        return _fold(len(texts), found)

    return append_arrow(df, text_col, FIELDS, fn)


def _seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bitmap of the low ``FILTER_BITS`` bits of the seeds, 64 to a word, or-ed per word before the shuffle."""
    slot = seeds.select(F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("slot"))
    words = (slot.groupBy(F.expr("slot div 64").alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")).alias("bits")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _passes(bitmap: np.ndarray, got: np.ndarray) -> np.ndarray:
    slot = got & np.uint64((1 << FILTER_BITS) - 1)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _mark_shuffled(df: DataFrame, items: DataFrame, text_col: str, min_overlap: int,
                   min_identity: float) -> DataFrame:
    """The same for a benchmark of any size: seeds meet in a shuffled join.

    A text is known by a 128-bit hash, so copies are verified once.
    """
    key = lambda c: [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("2"), c).alias("k2")]
    texts = df.select(*key(F.col(text_col)), F.col(text_col).alias("text")).where("text IS NOT NULL")
    # One id may stand for several texts: an item is its id and its text.
    items = items.withColumn("digest", F.xxhash64("text"))
    short = short_lengths(
        r[0] for r in map_arrow(items, ["text"], [field("n", INT)], lambda bs: (
            [pa.array([len(w) for w in item_words(b.column(0).to_pylist())], pa.int32())] for b in bs))
        .where(f"n >= {MIN_ITEM} AND n < {MIN_OVERLAP}").distinct().collect())  # at most MIN_OVERLAP - MIN_ITEM rows

    def emit(batches, make, bitmap=None):
        """The ids, seed hash, first word of the seeds that the bitmap lets pass."""
        for b in batches:
            ids = b.columns[:-1]
            for i, _, data, off in textops.blocks(b.column(len(ids)), lower=True):
                s, e, counts = textops.words(data, off, SEPARATOR)
                h = textops.word_hashes(data, s, e)
                row = textops.rows_of(counts)
                place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
                for got, at, *_ in make(h, counts, short):
                    if bitmap is not None:
                        live = _passes(bitmap.value, got)
                        got, at = got[live], at[live]
                    take = pa.array(i + row[at])
                    yield [*[c.take(take) for c in ids], pa.array(got.view(np.int64)), pa.array(place[at])]

    def check(batches):
        for b in batches:
            docs, its = item_words(b.column(2).to_pylist()), item_words(b.column(4).to_pylist())
            got = [(i, *run) for i, (d, w, g) in enumerate(zip(docs, its, b.column(5).to_pylist(), strict=True))
                   if len(w) >= MIN_ITEM for run in verify(d, w, g, min_overlap, min_identity)]
            at, first, n = (pa.array([g[k] for g in got], pa.int64()) for k in range(3))
            yield [*[b.column(k).take(at) for k in (0, 1, 3)], first, n]

    right = map_arrow(items, ["item", "digest", "text"], [field("item", LONG), field("digest", LONG), field("seed", LONG),
                                                field("q", LONG)], lambda bs: emit(bs, item_seeds))
    bitmap = df.sparkSession.sparkContext.broadcast(_seed_filter(right))
    left = map_arrow(texts, ["k1", "k2", "text"], [field("k1", LONG), field("k2", LONG), field("seed", LONG),
                                                   field("p", LONG)], lambda bs: emit(bs, seeds, bitmap))
    pairs = (left.join(right, "seed").select("k1", "k2", "item", "digest", (F.col("p") - F.col("q")).alias("diagonal"))
             .distinct())
    one = texts.dropDuplicates(["k1", "k2"])
    full = (pairs.join(one, ["k1", "k2"]).join(items.withColumnRenamed("text", "item_text").distinct(), ["item", "digest"])
            .select("k1", "k2", "text", "item", "item_text", "diagonal"))
    over = map_arrow(full, full.columns, [field("k1", LONG), field("k2", LONG), field("item", LONG),
                                          field("first", LONG), field("words", LONG)], check)
    # Overlaps of one text: at most its words times the benchmark, gathered per text.
    folded = over.groupBy("k1", "k2").agg(F.collect_list(F.struct("item", "first", "words")).alias("o"))
    fields = [field("k1", LONG), field("k2", LONG), *FIELDS]

    def fold(batches):
        for b in batches:
            rows = b.column(2).to_pylist()
            found = [(i, x["item"], x["first"], x["words"]) for i, o in enumerate(rows) for x in o]
            yield [b.column(0), b.column(1), *_fold(len(rows), found)]

    marks = map_arrow(folded, folded.columns, fields, fold)
    fresh = [f.name for f in FIELDS]
    marks = marks.select("k1", "k2", F.struct(*fresh).alias("mark"))
    names = [c for c in df.columns if c not in fresh]
    # Columns travel under positional names, so no name of theirs can clash.
    rows = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)], *key(quoted(text_col)))
    out = rows.join(marks, ["k1", "k2"], "left")
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.coalesce("mark.contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("mark.items", F.array().cast("array<bigint>")).alias("items"),
        F.col("mark.best_item").alias("best_item"),
        F.coalesce("mark.best_overlap", F.lit(0)).alias("best_overlap"),
        F.coalesce("mark.covered_words", F.lit(0).cast("long")).alias("covered_words"))
