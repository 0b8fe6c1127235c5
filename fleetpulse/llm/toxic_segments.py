"""Toxicity by maximum-scoring segment search (operator 4).

Fit.  Words are counted per class over a bounded, seeded sample of labelled
rows (``TRAIN_ROWS``).  Words and their stems (first 4 to 10 bytes) are the
tokens.  Copies of one text must not make its words telling, so a token's
toxic count is at most the effective number of its left neighbours (inverse
Simpson index): that is near 1 for a word that a family of copies repeats in
one place.  The counts of all words over the *whole* corpus give the
Dirichlet prior: a token has prior mass ``PRIOR_MASS`` times its corpus share,
plus ``PRIOR_FLOOR``, in either class.  A token's weight is the difference of
its smoothed log odds between the classes; it is kept when that is ``MIN_Z``
standard deviations above 0 (Monroe's z-score) and at least ``MIN_WEIGHT``.  Of the tokens a word
matches, the longest counts; tokens seen in clean texts that begin with a
kept stem are kept too, so that a stem does not speak for them.

Scan.  A text is the sequence of its words' weights less ``DRIFT`` (words
without a weight score ``-DRIFT``).  One linear scan (Ruzzo and Tompa's) finds
every maximal-scoring segment.  Only weighted words can start or end one, so
the scan walks those and takes the drift between them in one step.

Calibration.  The largest segment of n clean words follows an extreme-value
law: P(S >= s) = 1 - exp(-K n exp(-lambda s)).  ``lambda`` is the positive root
of the moment equation of the sample's clean words, ``K`` is matched to how
many clean texts have a segment.  The evidence of a text is the sum of
-log10 P of its significant segments (P < ``MAX_P``); a logistic curve, fitted
on the sample, turns it into the score.

Defined cases: null or empty text has no segment and gets the score of zero
evidence; labels that are null are not used, and a doc_id with several
labels is toxic if one says so; without labels of both classes every score
is 0; one result row per input row, repeated or null ids included.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .common import BINARY, DOUBLE, INT, LONG, Scratch, append_arrow, field, map_arrow
from .spaced_seeds import SEPARATOR

TRAIN_ROWS = 10_000
PRIOR_MASS = 500.0
PRIOR_FLOOR = 0.5
MIN_Z = 3.2
STEMS = range(4, 11)
MIN_WEIGHT = 3.0
MIN_FORMS = 3
DRIFT = 0.05
MAX_P = 0.05
FLUSH_WORDS = 400_000
WHOLE = 0
_BITS = np.uint64((1 << 20) - 1)


class Lookup:
    """Weights by token hash."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order]
        self.near = np.zeros(int(_BITS) + 1, dtype=bool)
        self.near[hashes & _BITS] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` that have a weight, and the weights."""
        near = np.flatnonzero(self.near[h & _BITS])
        slot = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
        hit = self.hashes[slot] == h[near]
        return near[hit], self.weights[slot[hit]]


@dataclass
class Model:
    """Token weights by stem length (``WHOLE``: words), and the calibration."""

    levels: dict[int, Lookup]
    lam: float = 1.0
    k: float = 1.0
    bias: float = -20.0
    slope: float = 0.0
    trained: bool = False

    def weights(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a weight (indices, ascending) and the weight of their longest token."""
        at, w = [], []
        for size in [x for x in sorted(self.levels) if x != WHOLE] + [x for x in self.levels if x == WHOLE]:
            some = np.flatnonzero(e - s >= size) if size != WHOLE else np.arange(len(s))
            stop = s[some] + size if size != WHOLE else e
            got, weight = self.levels[size].find(textops.word_hashes(data, s[some], stop))
            at.append(some[got])
            w.append(weight)
        if not at:
            return np.zeros(0, np.int64), np.zeros(0)
        at, w = np.concatenate(at), np.concatenate(w)
        order = np.argsort(at, kind="stable")  # longer tokens stand last
        at, w = at[order], w[order]
        last = np.r_[at[1:] != at[:-1], True] if len(at) else np.zeros(0, bool)
        return at[last], w[last]

    def p_value(self, score: float, n: int) -> float:
        return -math.expm1(-self.k * n * math.exp(-self.lam * score))

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        total = 0.0
        for _, _, s in segments:
            p = max(self.p_value(s, n), 1e-300)
            if p < MAX_P:
                total -= math.log10(p)
        return total

    def score(self, evidence: float) -> float:
        if not self.trained:
            return 0.0
        x = self.bias + self.slope * math.log1p(evidence)
        return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0


def segments(places: list[int], weights: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end word, score) of a text.

    ``places`` and ``weights`` name the words with a weight, in order; every
    word also costs ``drift``.  Linear time: each candidate is pushed and
    merged once, and a candidate keeps a link to the one whose left sum is
    smaller, so the search back never walks a candidate twice.
    """
    cand: list[list] = []  # [first, end, left sum, right sum, link to a smaller left sum]
    total, at = 0.0, 0
    for p, w in zip(places, weights, strict=True):
        total -= drift * (p - at)
        at = p + 1
        before, total = total, total + w - drift
        if w <= drift:
            continue
        new = [p, p + 1, before, total, -1]
        while True:
            j = len(cand) - 1
            while j >= 0 and cand[j][2] >= new[2]:
                j = cand[j][4]
            if j < 0 or cand[j][3] >= new[3]:
                new[4] = j
                cand.append(new)
                break
            new = [cand[j][0], new[1], cand[j][2], new[3], -1]
            del cand[j:]
    return [(c[0], c[1], c[3] - c[2]) for c in cand]


def scan(texts: pa.Array, model: Model):
    """(text index, words, segments, weights) of every text with a weighted word;
    the others have none.  Vectorized up to the words that carry a weight."""
    for i, _, data, off in textops.blocks(texts, lower=True):
        s, e, counts = textops.words(data, off, SEPARATOR)
        at, w = model.weights(data, s, e)
        first = np.r_[0, np.cumsum(counts)]
        text = np.searchsorted(first, at, "right") - 1
        edges = np.flatnonzero(np.r_[True, text[1:] != text[:-1], True]) if len(at) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            t, own = int(text[a]), w[a:b].tolist()
            yield i + t, int(counts[t]), segments((at[a:b] - first[t]).tolist(), own), own


def _corpus_words(df: DataFrame, text_col: str) -> DataFrame:
    """word (hash), n: occurrences over all texts, combined before the shuffle."""

    def run(batches):
        held, size = [], 0

        def flush():
            w, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([x for _, x in held])).astype(np.int64)
            return w, n

        for b in batches:
            for _, _, data, off in textops.blocks(b.column(0), lower=True):
                s, e, _ = textops.words(data, off, SEPARATOR)
                w, n = np.unique(textops.word_hashes(data, s, e), return_counts=True)
                held.append((w, n))
                size += len(w)
                if size > 2 * FLUSH_WORDS:
                    held = [flush()]
                    size = len(held[0][0])
                    if size > FLUSH_WORDS:
                        w, n = held[0]
                        yield [pa.array(w.view(np.int64)), pa.array(n)]
                        held, size = [], 0
        if held:
            w, n = flush()
            yield [pa.array(w.view(np.int64)), pa.array(n)]

    counted = map_arrow(df, [text_col], [field("word", LONG), field("n", LONG)], run)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _neighbours(df: DataFrame) -> DataFrame:
    """toxic, word (bytes), h (its hash), left (hash of the word before) of each word."""

    def run(batches):
        for b in batches:
            for i, j, data, off in textops.blocks(b.column(1), lower=True):
                s, e, counts = textops.words(data, off, SEPARATOR)
                h = textops.word_hashes(data, s, e)
                if not len(h):
                    continue
                rows = textops.rows_of(counts)
                left = np.r_[np.uint64(0), np.where(rows[1:] == rows[:-1], h[:-1], np.uint64(0))]
                raw = data.tobytes()
                yield [b.column(0).slice(i, j - i).take(pa.array(rows)),
                       pa.array([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)], pa.binary()),
                       pa.array(h.view(np.int64)), pa.array(left.view(np.int64))]

    return map_arrow(df, ["toxic", "text"], [field("toxic", INT), field("word", BINARY), field("h", LONG),
                                            field("left", LONG)], run)


def _tokens(words: DataFrame) -> tuple[list, int, int]:
    """Kept tokens (size, token, weight); words counted toxic and clean."""
    sums = words.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0"), F.sum("n").alias("n")).first()
    n1, n0 = sums["n1"] or 0, sums["n0"] or 0
    if not n1 or not n0:
        return [], n1, n0
    entry = lambda n, c: F.struct(F.lit(n).alias("size"), c.alias("token"))
    stems = [F.when(F.octet_length("word") >= n, entry(n, F.substring("word", 1, n))) for n in STEMS]
    tokens = (words.select("y1", "q1", "y0", "n", F.explode(F.array(entry(WHOLE, F.col("word")), *stems)).alias("t"))
              .where("t IS NOT NULL").groupBy("t.size", "t.token")
              .agg((F.sum("y1") * F.sum("y1") / F.greatest(F.sum("q1"), F.lit(1))).alias("y1"),
                   F.sum("y0").alias("y0"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms")))
    a = F.col("n") / F.lit(float(sums["n"])) * PRIOR_MASS + PRIOR_FLOOR
    odds = lambda y, n: F.log((F.col(y) + a) / (F.lit(float(n) + PRIOR_MASS) - F.col(y)))
    weighed = tokens.select(
        "size", "token", "y0", "forms", (odds("y1", n1) - odds("y0", n0)).alias("d"),
        F.sqrt(1 / (F.col("y1") + a) + 1 / (F.col("y0") + a)).alias("sd"))
    told = (F.col("d") >= F.greatest(F.lit(MIN_WEIGHT), MIN_Z * F.col("sd"))) & ((F.col("size") == WHOLE) | (F.col("forms") >= MIN_FORMS))
    # Tokens of the sample's texts that tell the classes apart: bounded by the sample.
    kept = weighed.where(told).collect()
    out = {(r["size"], bytes(r["token"])): r["d"] for r in kept}
    for n in STEMS:
        stem = [t for size, t in out if size == n]
        if stem:
            begun = words.sparkSession.createDataFrame([(bytearray(t),) for t in stem], "begin binary")
            longer = (F.col("size") == WHOLE) | (F.col("size") > n)
            for r in (weighed.where(longer & (F.col("y0") > 0) & (F.octet_length("token") > n))
                      .join(F.broadcast(begun), F.substring("token", 1, n) == F.col("begin"), "left_semi").collect()):
                out.setdefault((r["size"], bytes(r["token"])), r["d"])
    return [(size, t, d) for (size, t), d in sorted(out.items())], n1, n0


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", seed: int = 17) -> Model:
    """Model of ``labels`` (id, label): at most ``train_rows`` labelled rows are used,
    those with the smallest seeded hash of the id; they are the only data that
    is broadcast or collected, besides tokens and segments of their texts."""
    spark = docs.sparkSession
    empty = Model({})
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
              .where("id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(train_rows)).collect()
    if len({r["toxic"] for r in chosen}) < 2:
        return empty
    sample = spark.createDataFrame([(r["id"], r["toxic"]) for r in chosen],
                                   T.StructType([field("id", labels.schema[id_col].dataType), field("toxic", INT)]))
    scratch = Scratch(spark, "toxic")
    rows = scratch.write(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(sample), "id").select("id", "toxic", "text"), "sample")
    seen = _neighbours(rows).groupBy("word", "h", "left").agg(
        F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0"))
    words = seen.groupBy("word", "h").agg(F.sum("c1").alias("y1"), F.sum(F.col("c1") * F.col("c1")).alias("q1"),
                                          F.sum("c0").alias("y0"))
    corpus = _corpus_words(docs, text_col).withColumnRenamed("word", "h")
    words = scratch.write(words.join(corpus, "h"), "words")
    told, n1, n0 = _tokens(words)
    if not told:
        scratch.drop()
        return empty
    levels = {}
    for size in {x[0] for x in told}:
        own = [(t, d) for n, t, d in told if n == size]
        data = np.frombuffer(b"".join(t for t, _ in own), np.uint8)
        ends = np.cumsum([len(t) for t, _ in own])
        starts = ends - np.array([len(t) for t, _ in own])
        levels[size] = Lookup(textops.word_hashes(data, starts, ends), np.array([d for _, d in own]))
    model = Model(levels)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            n = len(b.column(2))
            segs, own = [[] for _ in range(n)], [[] for _ in range(n)]
            counts = [0] * n
            for i, j, data, off in textops.blocks(b.column(2), lower=True):
                counts[i:j] = textops.words(data, off, SEPARATOR)[2].tolist()
            for i, _, got, w in scan(b.column(2), shared.value):
                segs[i], own[i] = [x[2] for x in got], w
            yield [b.column(0), b.column(1), pa.array(counts, pa.int64()), pa.array(segs, pa.list_(pa.float64())),
                   pa.array(own, pa.list_(pa.float64()))]

    # The sample's own segments: one small row per labelled document.
    got = map_arrow(rows, ["id", "toxic", "text"],
                    [rows.schema["id"], field("toxic", INT), field("n", LONG),
                     field("segments", T.ArrayType(DOUBLE)), field("weights", T.ArrayType(DOUBLE))], run).collect()
    scratch.drop()
    got.sort(key=lambda r: (r["id"], r["toxic"], r["n"]))
    clean = [r for r in got if r["toxic"] == 0]
    # lambda: the mean of exp(lambda score) over clean words is 1; one further
    # hit of the mean positive weight stands for those not seen.
    positive = [d for _, _, d in told if d > DRIFT]
    total = sum(r["n"] for r in clean) + 1
    hits = np.array([w for r in clean for w in r["weights"]] + [float(np.mean(positive)) if positive else 1.0])
    moment = lambda x: float(np.exp(x * (hits - DRIFT)).sum() + (total - len(hits)) * math.exp(-x * DRIFT)) - total
    hi = 1e-3
    while moment(hi) < 0 and hi < 50:
        hi *= 1.5
    lo = hi / 1.5
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if moment(mid) < 0 else (lo, mid)
    model.lam = hi
    # K: as many clean texts have a segment as the law expects of the segments seen.
    best = [(max(r["segments"]), r["n"]) for r in clean if r["segments"]]
    expected = sum(n * math.exp(-model.lam * s) for s, n in best)
    # Where no clean text has one: half a text, at the mean positive weight.
    seen, expected = (len(best), expected) if best else (0.5, total * math.exp(-model.lam * (hits[-1] - DRIFT)))
    model.k = min(1.0, max(1e-4, seen / expected))
    x = np.array([math.log1p(model.evidence([(0, 0, s) for s in r["segments"]], r["n"])) for r in got])
    y = np.array([r["toxic"] for r in got], dtype=float)
    model.bias, model.slope = _logistic(x, y)
    model.trained = True
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Bias and slope of a ridge-penalized logistic curve (Newton steps)."""
    a = np.stack([np.ones_like(x), x], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (y - p) - ridge * beta
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


FIELDS = [field("score", DOUBLE), field("predicted", INT), field("n_segments", INT),
          field("top_first", INT), field("top_end", INT)]


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` plus score, predicted, n_segments (significant ones) and the words
    [top_first, top_end) of the strongest; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def fn(texts):
        m, n = shared.value, len(texts)
        base = m.score(0.0)
        scores, segs = [base] * n, [0] * n
        first, end = [None] * n, [None] * n
        for i, words_, got, _ in scan(texts, m):
            scores[i] = m.score(m.evidence(got, words_))
            good = [g for g in got if m.p_value(g[2], words_) < MAX_P]
            segs[i] = len(good)
            if good:
                first[i], end[i], _ = max(good, key=lambda g: (g[2], -g[0]))
        return [scores, [int(s >= 0.5) for s in scores], segs, first, end]

    return append_arrow(df, text_col, FIELDS, fn)
