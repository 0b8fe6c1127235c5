"""Quality rules by line sequence labelling (operator 6).

Base counts of a text come from its words and lines.  Then a linear-chain
conditional random field labels every line with a word as content or
boilerplate (Viterbi), and the share of words in content lines decides.

The field is trained here, on every line of every labelled document.  Its line labels differ
within a document: a line that the whole corpus shows in ever new surroundings (``shared_lines``) is
boilerplate wherever it stands, every other line of a good document is
content, and every line of a bad one boilerplate.  Copies of a page repeat a line
between the same neighbours, so their lines are not taken for boilerplate.  Being such
a line is a feature too, and transitions beside such a line are learned apart, so that a footer does not
pull the text before it; transitions and the form of a line decide on the rest.

Scale: texts stay where they are read.  One pass writes, per text, hashes of its lines and their
surroundings and the counts that the features are made from (``line_counts``, some two bytes each); the
hashes are counted by shuffles, and the counts of a text, not the text, travel to meet its shared lines by
a digest.  Training rows (features and labels of the lines) are written once; every step of the training is a Spark job over them, of which the driver gets the
likelihood and its gradient, 37 numbers per task.  The likelihood is concave, so the steps (BFGS)
end at its maximum, whatever the order of the rows.

Defined cases: null or empty text has zero counts and fails the base rule (too
few words); without labels of both classes the field is not used and the
base rule decides alone; one row per input row, repeated or null ids too.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .common import BINARY, BOOL, DOUBLE, INT, LONG, Scratch, field, map_arrow

TRAIN_PIECES = 8
PIECE_LINES = 256
MIN_WORDS = 50
MAX_REPEAT = 50
MIN_CONTENT = 0.5
STEPS = 250
#: The gradient at which training has arrived.
ARRIVED = 1e-5
#: Lines of a padded group of documents that the likelihood takes at a time.
GROUP_LINES = 1 << 15

_flag = lambda chars: np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8))
SYMBOL = _flag("#*$%&|<>")
UPPER = _flag("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _flag("abcdefghijklmnopqrstuvwxyz")
DIGIT = _flag("0123456789")
PUNCT = _flag(".,;:!?")
BANG = _flag("!?")
START = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a character
N_FEATURES = 14
#: Counts of a line that its features are made from (``line_counts``).
N_COUNTS = 11
#: A shared line stands in this many places at least, at most half of them between the same two lines.
MIN_PLACES = 8


class Lines:
    """Words, lines and per-line sums of one block of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, n = data, len(off) - 1
        newline = np.flatnonzero(data == 10)
        # A line starts at each text's start and after each newline.
        start = np.sort(np.r_[off[:-1], newline + 1], kind="stable")
        text = np.r_[np.arange(n), np.searchsorted(off, newline, "right") - 1]
        self.text = np.sort(text, kind="stable")
        self.per = np.bincount(self.text, minlength=n)
        self.start = start
        nl = np.r_[0, np.cumsum(self.per)]
        self.end = np.empty(len(start), np.int64)
        self.end[:-1] = start[1:] - 1
        if n:
            self.end[nl[1:] - 1] = off[1:]
        s, e, self.words = textops.words(data, off)
        self.hash = textops.word_hashes(data, s, e)
        self.word_start, self.word_end = s, e
        self.first_word = np.searchsorted(s, self.start)
        self.line_words = np.searchsorted(s, self.end) - self.first_word
        self.live = np.flatnonzero(self.line_words > 0)
        self.live_per = np.bincount(self.text[self.live], minlength=n)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Flagged bytes per line."""
        at = np.flatnonzero(table[self.data])
        return np.searchsorted(at, self.end) - np.searchsorted(at, self.start)

    @functools.cached_property
    def live_hashes(self) -> np.ndarray:
        """Hash of each line with a word."""
        start, end = self.start[self.live], self.end[self.live]
        total = np.r_[np.uint64(0), np.cumsum(textops.BYTE_VALUE[self.data] * textops.powers(len(self.data)))]
        h = (total[end] - total[start]) * textops.powers(len(self.data) + 1, inverse=True)[start]
        return textops.mix(h ^ (end - start).astype(np.uint64))

    @functools.cached_property
    def live_repeats(self) -> np.ndarray:
        return repeats(self.live_hashes, self.text[self.live])

    @functools.cached_property
    def windows_again(self) -> np.ndarray:
        """First word of each 3-word window that stands twice or more in its text."""
        w3, at, per = textops.window_hashes(self.hash, self.words, 3)
        return at[repeats(w3, textops.rows_of(per)) > 0]


def repeats(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Occurrence flags within a text: 2 if equal to an earlier element, 1 if a later one equals it."""
    out = np.zeros(len(keys), np.int8)
    if not len(keys):
        return out
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    out[order[1:][same]] = 2
    head = order[:-1][same]
    out[head] = np.maximum(out[head], 1)
    return out


def base_counts(data: np.ndarray, off: np.ndarray, x: Lines | None = None) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text of a block."""
    x = x or Lines(data, off)
    n = len(off) - 1
    count = lambda flags: np.diff(np.searchsorted(np.flatnonzero(flags), off))
    chars = count((START & ~textops.SPACE)[data])
    dup = np.bincount(x.text[x.live][x.live_repeats == 2], minlength=n)
    covered = np.zeros(len(x.hash), bool)
    for k in range(3):
        covered[x.windows_again + k] = True
    first = np.r_[0, np.cumsum(x.words)]
    repeated = np.diff(np.r_[0, np.cumsum(covered)][first])
    return {"n_words": x.words, "word_chars": chars, "n_symbols": count(SYMBOL[data]),
            "n_dup_lines": dup, "n_repeat_words": repeated}


def places(x: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each line with a word, and of the two lines with a word around it in its text."""
    h, text = x.live_hashes, x.text[x.live]
    same = text[1:] == text[:-1]
    before, after = np.zeros_like(h), np.zeros_like(h)
    before[1:] = np.where(same, h[:-1], 0)
    after[:-1] = np.where(same, h[1:], 0)
    return h, textops.mix(before * textops.BYTE_VALUE[1] + textops.mix(after))


def line_counts(x: Lines) -> np.ndarray:
    """Of the lines with a word, in order: words, bytes, symbols, upper and lower case letters, digits, punctuation,
    exclamation and question marks, whether it ends in punctuation, whether it stands again in its text, and the
    repeated 3-word windows that begin in it (int64, ``N_COUNTS`` columns)."""
    hit = np.bincount(np.searchsorted(x.first_word, x.windows_again, "right") - 1, minlength=len(x.start))
    ends = PUNCT[x.data[x.end[x.live] - 1]]
    whole = [x.line_words, x.end - x.start, *(x.sums(t) for t in (SYMBOL, UPPER, LOWER, DIGIT, PUNCT, BANG))]
    return np.stack([*(v[x.live] for v in whole), ends, x.live_repeats > 0, hit[x.live]], 1).astype(np.int64)


def features_of(counts: np.ndarray, shared: np.ndarray | None = None) -> np.ndarray:
    """Feature rows (float32) of lines by their counts; ``shared``: which lines are."""
    words, size, symbol, upper, lower, digit, punct, bang, ends, dup, hit = np.ascontiguousarray(counts.T)
    rows = np.stack([
        np.ones(len(counts)), np.minimum(np.log1p(words) / 4, 2), words < 4,
        np.minimum(size / words / 10, 3), 5 * (symbol / size), upper / np.maximum(upper + lower, 1),
        5 * (digit / size), 3 * (punct / size), 5 * (bang / size), ends, dup,
        np.minimum(hit / words, 1), np.minimum(symbol / words, 3),
        np.zeros(len(counts)) if shared is None else shared], 1)
    return rows.astype(np.float32)


def features(x: Lines, shared: np.ndarray | None = None) -> np.ndarray:
    """Feature rows of the lines with a word, in order."""
    return features_of(line_counts(x), shared)


def packed(counts: np.ndarray, per: np.ndarray) -> pa.Array:
    """The counts of each text's ``per`` lines as one binary: every count in as many bytes as the text's
    largest needs, by byte (low first), column and line, which packs best."""
    octets = np.ascontiguousarray(counts, "<i8").view(np.uint8).reshape(-1, N_COUNTS, 8)
    top, edges = counts.max(1, initial=0), np.r_[0, np.cumsum(per)].tolist()
    out = []
    for a, z in zip(edges, edges[1:]):
        width = -(-int(top[a:z].max(initial=1)).bit_length() // 8)
        out.append(octets[a:z, :, :width].transpose(2, 1, 0).tobytes())
    return pa.array(out, pa.binary())


def unpacked(found: pa.Array, per: np.ndarray) -> np.ndarray:
    """The counts that ``packed`` made binaries of."""
    edges = np.r_[0, np.cumsum(per)].tolist()
    out = np.zeros((edges[-1], N_COUNTS, 8), np.uint8)
    for a, z, f in zip(edges, edges[1:], found):
        if z > a:
            octets = np.frombuffer(f.as_buffer(), np.uint8).reshape(-1, N_COUNTS, z - a)
            out[a:z, :, :len(octets)] = octets.transpose(2, 1, 0)
    return out.reshape(-1, N_COUNTS * 8).view("<i8")


def groups(per: np.ndarray, lines: int = GROUP_LINES):
    """(first, end) of runs of texts with at most so many lines, or one text that has more."""
    edges, i = np.r_[0, np.cumsum(per)], 0
    while i < len(per):
        j = max(i + 1, int(np.searchsorted(edges, edges[i] + lines, "right")) - 1)
        yield i, j
        i = j


def steps_between(shared: np.ndarray) -> np.ndarray:
    """Which transitions hold between lines that follow each other: 1 if either is shared, else 0."""
    return (shared[..., 1:].astype(bool) | shared[..., :-1].astype(bool)).astype(np.int8)


def viterbi(score: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label sequence (1 = content) of one text's line scores (n, 2); ``trans`` is
    (2, 2), or (n - 1, 2, 2) with the transitions of each step."""
    trans = np.broadcast_to(trans, (max(len(score) - 1, 0), 2, 2)).reshape(-1, 4)
    a, b = score[0].tolist() if len(score) else (0.0, 0.0)
    back = []
    for (s0, s1), (t00, t01, t10, t11) in zip(score[1:].tolist(), trans.tolist(), strict=True):
        back.append((a + t00 < b + t10, a + t01 < b + t11))
        a, b = s0 + max(a + t00, b + t10), s1 + max(a + t01, b + t11)
    out = np.zeros(len(score), np.int8)
    label = int(b >= a)
    for k in range(len(score) - 1, -1, -1):
        out[k] = label
        if k:
            label = int(back[k - 1][label])
    return out


def pieces(f: np.ndarray, most: int = TRAIN_PIECES, lines: int = PIECE_LINES) -> list[np.ndarray]:
    """Runs of lines of one text, for a caller of ``train`` that holds few: all lines up to
    ``most * lines``, evenly spread runs beyond.  ``fit`` takes texts whole."""
    if len(f) <= most * lines:
        return np.array_split(f, -(-len(f) // lines)) if len(f) else []
    return [f[a:a + lines] for a in np.linspace(0, len(f) - lines, most).astype(int).tolist()]


def likelihood(w: np.ndarray, t: np.ndarray, seqs: list[np.ndarray], lines: list[np.ndarray],
               weights: np.ndarray) -> np.ndarray:
    """Weighted log-likelihood of labelled sequences and its gradient by ``w`` and ``t``, in one row."""
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    value, gw, gt = 0.0, np.zeros_like(w), np.zeros_like(t)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(seqs[order[end]]) <= GROUP_LINES:
            end += 1
        idx, at = order[at:end], end
        n = len(seqs[idx[-1]])
        x = np.zeros((len(idx), n, w.shape[0]))
        live = np.zeros((len(idx), n), bool)
        want = np.zeros((len(idx), n, 2))
        for r, i in enumerate(idx):
            x[r, :len(seqs[i])] = seqs[i]
            live[r, :len(seqs[i])] = True
            want[r, np.arange(len(seqs[i])), lines[i]] = 1
        weight = weights[idx]
        s = x @ w
        step_of = steps_between(x[:, :, -1])
        tr = t[step_of]
        f, b = np.zeros_like(s), np.zeros_like(s)
        f[:, 0] = s[:, 0]
        for k in range(1, n):
            nxt = s[:, k] + np.logaddexp(f[:, k - 1, 0, None] + tr[:, k - 1, 0], f[:, k - 1, 1, None] + tr[:, k - 1, 1])
            f[:, k] = np.where(live[:, k, None], nxt, f[:, k - 1])
        for k in range(n - 2, -1, -1):
            v = s[:, k + 1] + b[:, k + 1]
            nxt = np.logaddexp(v[:, 0, None] + tr[:, k, :, 0], v[:, 1, None] + tr[:, k, :, 1])
            b[:, k] = np.where(live[:, k + 1, None], nxt, 0.0)
        z = np.logaddexp(f[:, -1, 0], f[:, -1, 1])
        value += float(weight @ ((want * s).sum((1, 2)) - z))
        p = np.exp(np.minimum(f + b - z[:, None, None], 0)) * live[:, :, None]
        gw += np.tensordot(x, (want - p) * weight[:, None, None], ([0, 1], [0, 1]))
        if n > 1:
            for i in range(2):
                for j in range(2):
                    q = np.exp(np.minimum(f[:, :-1, i] + tr[:, :, i, j] + s[:, 1:, j] + b[:, 1:, j] - z[:, None], 0))
                    seen = want[:, :-1, i] * want[:, 1:, j]
                    g = (seen - q) * live[:, 1:] * weight[:, None]
                    value += float((seen * tr[:, :, i, j] * weight[:, None]).sum())
                    gt[:, i, j] += g[step_of == 0].sum(), g[step_of == 1].sum()
    return np.r_[value, gw.ravel(), gt.ravel()]


def ascend(total, steps: int = STEPS, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, 2) and transitions (2, 2, 2) of the highest likelihood less the ridge's part, by BFGS.
    ``total(w, t)`` is ``likelihood`` over all sequences; it is asked at most ``steps`` times."""
    split = lambda v: (v[:N_FEATURES * 2].reshape(N_FEATURES, 2), v[N_FEATURES * 2:].reshape(2, 2, 2))

    def at(v):
        got = total(*split(v))
        return ridge / 2 * (v @ v) - got[0], ridge * v - got[1:]

    v = np.zeros(N_FEATURES * 2 + 8)
    inverse, first = np.eye(len(v)), True
    value, slope = at(v)
    asked, size = 1, 1.0
    while asked < steps and np.abs(slope).max() > ARRIVED:
        way = -inverse @ slope
        size = min(1.0, 1 / np.abs(slope).sum()) if first else 1.0
        while asked < steps:
            new_value, new_slope = at(v + size * way)
            asked += 1
            if new_value <= value + 1e-4 * size * (slope @ way):
                break
            size /= 2
            if size < 1e-10:
                return split(v)
        else:
            break
        moved, turned = size * way, new_slope - slope
        v, value, slope = v + moved, new_value, new_slope
        curve = moved @ turned
        if curve > 1e-14:
            if first:
                inverse, first = np.eye(len(v)) * curve / (turned @ turned), False
            part = np.eye(len(v)) - np.outer(moved, turned) / curve
            inverse = part @ inverse @ part.T + np.outer(moved, moved) / curve
    return split(v)


def train(seqs: list[np.ndarray], labels: list[int], steps: int = STEPS, ridge: float = 1e-3,
          sizes: list[int] | None = None, lines: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of the field, beside no shared line and beside one, for sequences at hand.

    ``sizes`` has the lines of the document that a sequence is a piece of, so
    that every document weighs the same (default: a sequence is a document), and
    ``lines`` the labels of its lines (default: the document's).
    """
    lines = [np.full(len(s), y) for s, y in zip(seqs, labels, strict=True)] if lines is None else lines
    sizes = [len(s) for s in seqs] if sizes is None else sizes
    part = np.array([len(s) / n for s, n in zip(seqs, sizes, strict=True)])
    y = np.array(labels)
    weights = 0.5 / np.maximum(np.where(y == 1, part[y == 1].sum(), part[y == 0].sum()), 1e-300) / np.array(sizes)
    return ascend(lambda w, t: likelihood(w, t, seqs, lines, weights), steps, ridge)


def with_key(docs: DataFrame, text_col: str) -> DataFrame:
    """u, v: digest of the text."""
    text = F.col(text_col)
    return docs.withColumns({"__u": F.xxhash64(text), "__v": F.xxhash64(F.lit(6), text)})


def text_rows(docs: DataFrame) -> DataFrame:
    """id, u, v, n, f, copies, line, place of every document with a word (of columns id and text): its lines with
    a word, their packed counts, hashes and places.  Of the copies of a text in a block, the first has
    their number and the hashes, the others 0 and none."""

    def run(batches):
        for b in batches:
            for i, j, data, off in textops.blocks(b.column(3)):
                x = Lines(data, off)
                ids, u, v = (b.column(k).slice(i, j - i) for k in range(3))
                _, first, of = np.unique(np.stack([u.to_numpy(), v.to_numpy()], 1), axis=0,
                                         return_index=True, return_inverse=True)
                copies = np.zeros(j - i, np.int64)
                copies[first] = np.bincount(of.ravel())
                own = np.repeat(copies > 0, x.live_per)
                edges = pa.array(np.r_[0, np.cumsum(np.where(copies > 0, x.live_per, 0))].astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(h[own].view(np.int64))) for h in places(x)]
                yield [ids, u, v, pa.array(x.live_per), packed(line_counts(x), x.live_per), pa.array(copies), *lists]

    return map_arrow(with_key(docs, "text"), ["id", "__u", "__v", "text"],
                     [field("id", docs.schema["id"].dataType), *(field(c, LONG) for c in ("u", "v", "n")),
                      field("f", BINARY), field("copies", LONG), *(field(c, T.ArrayType(LONG)) for c in ("line", "place"))],
                     run).where("n > 0")


def line_rows(texts: DataFrame) -> DataFrame:
    """u, v, pos, line, place, n: every line of ``text_rows``, copies of a text in a block once."""
    lines = texts.select("u", "v", F.col("copies").alias("n"), F.posexplode(F.arrays_zip("line", "place")).alias("pos", "at"))
    return lines.select("u", "v", "pos", "at.line", "at.place", "n")


def spread_lines(rows: DataFrame, least: int = MIN_PLACES) -> DataFrame:
    """line: those that stand in ``least`` places or more, at most half of them between the same two lines."""
    return (rows.groupBy("line", "place").agg(F.sum("n").alias("n"))
            .groupBy("line").agg(F.sum("n").alias("total"), F.max("n").alias("most"))
            .where(f"total >= {int(least)} AND 2 * most <= total").select("line"))


def shared_lines(docs: DataFrame, of: np.ndarray, text_col: str = "text", least: int = MIN_PLACES) -> np.ndarray:
    """Those of the line hashes ``of`` that all documents show in ever new surroundings; sorted."""
    asked = docs.sparkSession.createDataFrame([(int(h),) for h in of.view(np.int64)], "line long")
    texts = text_rows(docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text")))
    found = spread_lines(line_rows(texts), least).join(asked, "line")
    return np.sort(np.array([r["line"] for r in found.collect()], np.int64).view(np.uint64))


def shared_lists(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """u, v, shared: which lines of every text (of ``text_rows``) that has some are shared."""
    rows = line_rows(texts)
    shared = scratch.write(spread_lines(rows), "shared")
    return scratch.write(rows.join(shared, "line").groupBy("u", "v").agg(F.collect_set("pos").alias("shared")), "lists")


def marked(shared: pa.Array, per: np.ndarray) -> np.ndarray:
    """Which of the texts' lines, ``per`` each, are in the texts' lists."""
    out, at = np.zeros(int(per.sum()), bool), shared.value_lengths().fill_null(0).to_numpy()
    out[np.repeat(np.cumsum(per) - per, at) + shared.flatten().to_numpy()] = True
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", scratch: Scratch | None = None):
    """(weights, transitions, table of the texts' shared lines), or None without labels of both
    classes.  Uses all lines of all labelled documents."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "line-crf")
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y")))
    texts = scratch.write(text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), "texts")
    lists = shared_lists(texts, scratch)
    # By a shuffle at every size: the labels grow with the documents.
    rows = (texts.select("id", "u", "v", "n", "f").join(lab.hint("merge"), "id")
            .join(lists, ["u", "v"], "left"))

    def run(batches):
        for b in batches:
            for i, j in groups(b.column(1).to_numpy()):
                y, n, f, shared = (c.slice(i, j - i) for c in b.columns)
                per = n.to_numpy()
                found = features_of(unpacked(f, per), marked(shared, per))
                yield [y, n, pa.array([f.tobytes() for f in np.split(found, np.cumsum(per)[:-1])], pa.binary())]

    got = map_arrow(rows, ["y", "n", "f", "shared"], [field("y", INT), field("n", LONG), field("f", BINARY)], run)
    got = scratch.write(got, "train")
    scratch.drop("texts")
    count = {r["y"]: r["count"] for r in got.groupBy("y").count().collect()}
    if len(count) < 2:
        return None

    def total(w, t):
        def part(batches):
            out = np.zeros(1 + w.size + t.size)
            for b in batches:
                y, n = b.column(0).to_numpy(), b.column(1).to_numpy()
                seqs = [np.frombuffer(f.as_py(), np.float32).reshape(-1, N_FEATURES) for f in b.column(2)]
                lines = [np.where(q[:, -1] > 0, 0, k) for q, k in zip(seqs, y)]
                out = out + likelihood(w, t, seqs, lines, 0.5 / np.where(y == 1, count[1], count[0]) / n)
            yield [pa.array([out.tolist()], pa.list_(pa.float64()))]

        parts = map_arrow(got, ["y", "n", "f"], [field("g", T.ArrayType(DOUBLE))], part).collect()
        # Added up exactly, so the order of the tasks does not matter.
        return np.array([math.fsum(c) for c in zip(*[r["g"] for r in parts])])

    return *ascend(total), lists


FIELDS = [field("n_words", LONG), field("word_chars", LONG), field("n_symbols", LONG),
          field("n_dup_lines", LONG), field("n_repeat_words", LONG), field("base_failed", BOOL),
          field("kept", BOOL), field("n_lines", LONG), field("content_words", LONG)]


def quality(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            max_repeat: int = MAX_REPEAT, min_content: float = MIN_CONTENT) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, n_lines (with a word), content_words."""
    field_of, lists = (None, None) if model is None else (model[:2], model[2])

    def measure(batches):
        for b in batches:
            for i, j, data, off in textops.blocks(b.column(3)):
                x = Lines(data, off)
                yield [*(b.column(k).slice(i, j - i) for k in range(3)),
                       *[pa.array(v.astype(np.int64)) for v in base_counts(data, off, x).values()],
                       pa.array(x.live_per), packed(line_counts(x), x.live_per)]

    def judge(batches):
        for b in batches:
            for i, j in groups(b.column(6).to_numpy()):
                c = [v.slice(i, j - i) for v in b.columns]
                n, repeated, per = (c[k].to_numpy() for k in (1, 5, 6))
                failed = (n < min_words) | (100 * repeated > max_repeat * n)
                content = n.copy()
                if field_of is not None:
                    counts = unpacked(c[7], per)
                    rows = features_of(counts, marked(c[8], per))
                    scores, trans = rows @ field_of[0], field_of[1][steps_between(rows[:, -1])]
                    edges = np.r_[0, np.cumsum(per)]
                    for t in range(j - i):
                        a, z = edges[t], edges[t + 1]
                        if z > a:
                            content[t] = int(counts[a:z, 0] @ viterbi(scores[a:z], trans[a:z - 1]))
                kept = ~failed & (content >= min_content * n)
                yield [*c[:6], pa.array(failed), pa.array(kept), c[6], pa.array(content)]

    kind, base = df.schema[id_col].dataType, FIELDS[:5]
    rows = with_key(df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text")
    rows = map_arrow(rows, ["__id", "__u", "__v", "__text"],
                     [field("id", kind), field("u", LONG), field("v", LONG), *base, field("n", LONG), field("f", BINARY)], measure)
    if lists is None:
        rows = rows.withColumn("shared", F.lit(None).cast(T.ArrayType(INT)))
    else:
        rows = rows.join(lists, ["u", "v"], "left")
    return map_arrow(rows, ["id", *(c.name for c in base), "n", "f", "shared"], [field("doc_id", kind), *FIELDS], judge)


def base_counts_plain(text: str | None) -> tuple[int, int, int, int, int]:
    """The base counts of one text, as the contract words them (for tests)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))
