"""N-gram Jaccard join by a MinHash LSH forest (operator 1).

Documents with the same set of word ``WIDTH``-grams form one class; only one
text of a class is compared.  Each class has ``TREES`` signatures of ``DEPTH``
MinHash values, one per tree; a bucket is a node of a tree's sorted prefix
trie, that is, the classes that share a signature prefix.

Prefixes are shortened in all trees together, by each class for itself.  A class
starts with whole signatures and gives up one value at a time while the shorter
prefix can bring a partner that it has not met.  Two bounds say who can be a
partner: the sizes of the shingle sets, and the agreement over all
``TREES * DEPTH`` values, too small for a link on the threshold with a chance
below ``(1 - recall)**2``.  No prefix gets shorter than the floor, the longest one that
gives a pair exactly on the threshold a chance of ``recall`` to meet.  So each
link has at least this chance whatever the other rows are: they can keep a class
in the descent, never end it.  ``prefix`` is the length a class came down to;
``DEPTH`` where no shorter one could bring a partner.

Signatures alone travel for this.  Texts are fetched for the classes with a
possible partner only, and every pair of what is left of a bucket is verified
exactly, on the shingle sets.

No pair is emitted.  A bucket larger than ``BLOCK`` classes is dealt out as
pairs of blocks, so no task holds more than two blocks, and verified links
leave a task as link counts and as edges to the least class of each group of
linked classes.  A pair that meets in several buckets is counted in the first
of them; a bucket with the same members as another is verified once.

Defined cases: null, empty and blank texts have no shingle: a class of their
own each, no links; a text of 1 to ``WIDTH`` - 1 words has one shingle, all of
its words; copies are members of one class and count as links of each
other; rows that repeat a doc_id count each, and different texts under the
least doc_id of two classes make these one class; a null doc_id takes part with
its text, but names no class: linked rows without any doc_id have a null class.  Only the two named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import BINARY, INT, LONG, Scratch, field, map_arrow, runs
from .components import components

WIDTH = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 8
RECALL = 0.9999
BLOCK = 256
_rng = np.random.Generator(np.random.PCG64(5))
_XOR = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_ODD = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)


def shingles(data: np.ndarray, off: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of each text in order, and their number per text."""
    s, e, counts = textops.words(data, off)
    h = textops.word_hashes(data, s, e)
    long, _, per = textops.window_hashes(h, counts, width)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return long, per
    first = (np.cumsum(counts) - counts)[short]
    n = counts[short]
    one = textops.BYTE_VALUE[n].copy()
    for k in range(width - 1):
        one += np.where(k < n, h[np.minimum(first + k, len(h) - 1)] * (textops.BYTE_VALUE[k] | np.uint64(1)),
                        np.uint64(0))
    at = (np.cumsum(per) - per)[short]
    per = per.copy()
    per[short] = 1
    return np.insert(long, at, textops.mix(one)), per


def sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for _, _, data, off in textops.blocks(texts):
        h, per = shingles(data, off, width)
        out += [np.unique(x) for x in np.split(h, np.cumsum(per)[:-1])]
    return out


def chance(s: float, depth: int, trees: int = TREES) -> float:
    """Chance that a pair of similarity s shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - s**depth) ** trees


def floor_depth(threshold: float, recall: float) -> int:
    """Longest prefix at which a pair on the threshold still meets with chance ``recall``."""
    return next((d for d in range(DEPTH, 0, -1) if chance(threshold, d) >= recall), 1)


def least_agreement(threshold: float, recall: float, values: int = TREES * DEPTH) -> int:
    """Most values that a pair on the threshold agrees in, but for a chance of ``(1 - recall)**2``."""
    below, k = 0.0, 0
    while k <= values:
        below += math.comb(values, k) * threshold**k * (1 - threshold) ** (values - k)
        if below > (1 - recall) ** 2:
            break
        k += 1
    return k


def signatures(df: DataFrame, width: int) -> DataFrame:
    """``df`` (doc_id, text) as doc_id, text key, n, digest d1 d2 of the shingle set, signature."""

    def run(batches):
        for b in batches:
            for i, j, data, off in textops.blocks(b.column(2)):
                h, per = shingles(data, off, width)
                edges = np.cumsum(per) - per
                some = np.flatnonzero(per)
                low = (h >> np.uint64(32)).astype(np.uint32)
                mins = np.zeros((len(per), TREES * DEPTH), np.uint16)
                for k in range(TREES * DEPTH if len(some) else 0):
                    m = np.minimum.reduceat((low ^ _XOR[k]) * _ODD[k], edges[some])
                    mins[some, k] = (m * np.uint32(0x9E3779B1)) >> np.uint32(16)
                sets_ = [np.unique(x) for x in np.split(h, edges[1:])]
                yield [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                       pa.array([len(u) for u in sets_], pa.int64()),
                       pa.array([int(u.sum(dtype=np.uint64).view(np.int64)) for u in sets_], pa.int64()),
                       pa.array([int(textops.mix(u).sum(dtype=np.uint64).view(np.int64)) for u in sets_], pa.int64()),
                       pa.array([x.tobytes() for x in mins], pa.binary())]

    rows = df.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    return map_arrow(rows, rows.columns, [field("doc_id", LONG), field("tkey", LONG), field("n", LONG),
                                          field("d1", LONG), field("d2", LONG), field("sig", BINARY)], run)


def common(keys: list[np.ndarray]) -> np.ndarray:
    """Number of keys each two of the given distinct-key arrays have in common."""
    m = len(keys)
    out = np.zeros((m, m), np.float32)
    row = np.repeat(np.arange(m), [len(k) for k in keys])
    _, col, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    twice = count > 1
    number = np.cumsum(twice) - 1
    live = twice[col]
    row, col, total = row[live], number[col[live]], int(twice.sum())
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for lo in range(0, total, 8192):
        a, b = np.searchsorted(col, [lo, lo + 8192])
        x = np.zeros((m, min(8192, total - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        out += x @ x.T
    return out


def verify(keys: list[np.ndarray], bucket: int, mine: list[np.ndarray], block: np.ndarray, across: bool,
           threshold: float) -> np.ndarray:
    """Link matrix of the pairs this bucket (and block pair) counts."""
    inter = common(keys)
    n = np.array([len(k) for k in keys], np.float32)
    union = n[:, None] + n[None, :] - inter
    link = inter >= threshold * union - 1e-4
    np.fill_diagonal(link, False)
    if across:
        link &= block[:, None] != block[None, :]
    if link.any():
        link &= common([b[b < bucket] for b in mine]) == 0
    return link


def descend(sig: np.ndarray, n: np.ndarray, block: np.ndarray, across: bool, threshold: float, floor: int,
            least: int) -> np.ndarray:
    """The prefix that each class of a bucket comes down to, 0 where no member can be its partner.

    Row by row: the members that neither size nor agreement excludes, and the
    longest prefix shared with each in any tree; the shortest of these is as far
    as the class has to go.
    """
    m = len(sig)
    reach = np.full(m, DEPTH + 1, np.int64)
    step = max(1, (1 << 20) // (m * sig.shape[1]))
    for lo in range(0, m, step):
        at = np.arange(lo, min(m, lo + step))
        same = sig[at, None, :] == sig[None, :, :]
        may = same.sum(2, dtype=np.int32) >= least
        may &= np.minimum(n[at, None], n) >= threshold * np.maximum(n[at, None], n) - 1e-4
        may[np.arange(len(at)), at] = False
        if across:
            may &= block[at, None] != block
        r, c = np.nonzero(may)
        if not len(r):
            continue
        path = same[r, c].reshape(len(r), TREES, DEPTH)
        shared = path[:, :, :floor].all(2)
        depth = np.full(len(r), floor)
        for k in range(floor, DEPTH):
            shared &= path[:, :, k]
            depth += shared.any(1)
        np.minimum.at(reach, at[r], depth)
    return np.where(reach > DEPTH, 0, reach)


def _descended(dealt: DataFrame, threshold: float, recall: float) -> DataFrame:
    """bucket, rep, prefix of the classes with a possible partner in the bucket."""
    floor, least = floor_depth(threshold, recall), least_agreement(threshold, recall)

    def run(batches):
        for t in runs(batches, 3):
            if t.num_rows < 2:
                continue
            across = t["i"][0].as_py() != t["j"][0].as_py()
            sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(t.num_rows, -1)
            reach = descend(sig, t["n"].to_numpy(), t["block"].to_numpy(), across, threshold, floor, least)
            hit = np.flatnonzero(reach)
            if len(hit):
                yield [t["bucket"].combine_chunks().take(pa.array(hit)), t["rep"].combine_chunks().take(pa.array(hit)),
                       pa.array(reach[hit].astype(np.int32))]

    rows = map_arrow(dealt, dealt.columns, [field("bucket", LONG), field("rep", LONG), field("prefix", INT)], run)
    return rows.groupBy("bucket", "rep").agg(F.min("prefix").alias("prefix"))


def _roots(link: np.ndarray) -> np.ndarray:
    """Least row index of each row's group of linked rows."""
    label = np.arange(len(link))
    while True:
        best = np.where(link, label[None, :], len(label)).min(1)
        new = np.minimum(label, best)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _verified(groups: DataFrame, threshold: float, width: int) -> DataFrame:
    """rep, links, root of the linked classes of each (bucket, block pair)."""

    def run(batches):
        for t in runs(batches, 3):
            t = t.combine_chunks()
            if t.num_rows < 2:
                continue
            rep, weight = t["rep"].to_numpy(), t["weight"].to_numpy()
            order = np.argsort(rep, kind="stable")
            rep, weight = rep[order], weight[order]
            t = t.take(pa.array(order))
            mine = [np.array(x, np.int64) for x in t["mine"].to_pylist()]
            across = t["i"][0].as_py() != t["j"][0].as_py()
            link = verify(sets(t["text"], width), t["bucket"][0].as_py(), mine, t["block"].to_numpy(), across,
                          threshold)
            hit = np.flatnonzero(link.any(1))
            if not len(hit):
                continue
            root = _roots(link)
            yield [pa.array(rep[hit]), pa.array((link.astype(np.float64) @ weight)[hit].astype(np.int64)),
                   pa.array(rep[root[hit]])]

    return map_arrow(groups, groups.columns, [field("rep", LONG), field("links", LONG), field("root", LONG)], run)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL, width: int = WIDTH) -> DataFrame:
    """doc_id, class_id (least doc_id linked to it by a chain of links), n_links
    (other rows with similarity >= threshold), copies (rows with the same shingle set),
    prefix (values of the prefix that its class came down to; null without words)."""
    return keyed(df, id_col, text_col, threshold, recall, width).drop("text_key")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
          recall: float = RECALL, width: int = WIDTH) -> DataFrame:
    """``near_duplicates`` plus ``text_key`` (``xxhash64`` of the text), which tells
    rows apart that have one doc_id but different texts."""
    result = Scratch(df.sparkSession, "lsh-classes")
    scratch = Scratch(df.sparkSession, "lsh-forest")
    try:
        return result.write(_joined(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                                    threshold, recall, width, scratch), "result")
    finally:
        scratch.drop()


def _joined(docs: DataFrame, threshold: float, recall: float, width: int, scratch: Scratch) -> DataFrame:
    signed = scratch.write(signatures(docs, width), "signed")
    some = signed.where("n > 0")
    # A class is known by its least doc_id; one without any by its digest.
    named = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tkey")))
    classes = scratch.write(some.groupBy("d1", "d2").agg(
        named.alias("r"), F.min("tkey").alias("t"), F.count(F.lit(1)).alias("weight")).select(
            "d1", "d2", F.col("r.doc_id").alias("id"), F.coalesce("r.doc_id", F.xxhash64("d1", "d2")).alias("rep"),
            F.coalesce("r.tkey", "t").alias("tkey"), "weight"), "classes")
    forest = scratch.write(
        some.select("d1", "d2", "tkey", "n", "sig").dropDuplicates(["d1", "d2", "tkey"])
        .join(classes, ["d1", "d2", "tkey"]).select("rep", "id", "tkey", "weight", "n", "sig"), "forest")

    floor = floor_depth(threshold, recall)
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    nodes = (forest.select("rep", "sig", tree.alias("tree"))
             .select("rep", F.xxhash64(F.lit(floor), "tree", F.substring(
                 "sig", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * floor))).alias("bucket")))
    met = _members(nodes).join(forest.select("rep", "n", "sig"), "rep")
    near = scratch.write(_descended(_dealt(met, "n", "sig"), threshold, recall), "near")
    members = scratch.write(_members(near.select("rep", "bucket")), "members")
    texts = scratch.write(_texts(docs, members, forest), "texts")
    lists = scratch.write(members.groupBy("rep").agg(F.collect_list(F.struct("bucket", "size")).alias("mine")), "lists")
    pairs = (lists.join(texts, "rep").select("rep", "weight", "text", F.col("mine.bucket").alias("mine"), F.explode("mine"))
             .select("*", "col.bucket", "col.size"))
    verified = scratch.write(_verified(_dealt(pairs, "weight", "text", "mine"), threshold, width), "links")

    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    root = components(verified.select(F.col("rep").alias("u"), F.col("root").alias("v")), scratch)
    ids = classes.select(F.col("id").alias("node")).where("id IS NOT NULL")
    names = root.join(ids, "node", "left_semi").groupBy("root").agg(F.min("node").alias("name"))
    root = root.join(names, "root", "left").select(F.col("node").alias("rep"), "name", F.lit(True).alias("linked"))
    reach = near.groupBy("rep").agg(F.min("prefix").alias("prefix"))
    groups = (classes.join(links, "rep", "left").join(root, "rep", "left").join(reach, "rep", "left")
              .select("d1", "d2", F.when(F.col("linked"), F.col("name")).otherwise(F.col("id")).alias("class_id"),
                      (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.col("weight").alias("copies"), F.coalesce("prefix", F.lit(DEPTH)).alias("prefix")))
    out = some.select("doc_id", F.col("tkey").alias("text_key"), "d1", "d2").join(groups, ["d1", "d2"]).drop("d1", "d2")
    alone = signed.where("n = 0").select(
        "doc_id", F.col("tkey").alias("text_key"), F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"),
        F.lit(None).cast("int").alias("prefix"))
    return out.unionByName(alone)


def _members(rows: DataFrame) -> DataFrame:
    """(bucket, rep, size) of the buckets with several classes among ``rows`` (rep, bucket),
    one bucket per distinct set of members, which an order-free fingerprint tells."""
    nodes = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"),
                                        F.bit_xor(F.xxhash64("rep")).alias("f1"),
                                        F.bit_xor(F.xxhash64(F.lit(2), "rep")).alias("f2"))
             .where("size > 1").groupBy("size", "f1", "f2").agg(F.min("bucket").alias("bucket")))
    return rows.join(nodes.select("bucket", "size"), "bucket")


def _texts(docs: DataFrame, members: DataFrame, forest: DataFrame) -> DataFrame:
    """rep, weight, text of the classes with a possible partner."""
    wanted = forest.select("rep", "id", "tkey", "weight").join(members.select("rep").distinct(), "rep", "left_semi")
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return (rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["key"] == wanted["tkey"]))
            .dropDuplicates(["rep", "tkey"]).select("rep", "weight", "text"))


def _dealt(members: DataFrame, *columns: str) -> DataFrame:
    """Classes with ``columns``, dealt to (bucket, block i, block j), sorted."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = members.select("*", F.pmod(F.xxhash64(F.lit(3), "rep"), n).cast("int").alias("block"), n.alias("blocks"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    return (rows.select("bucket", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "rep",
                        "block", *columns)
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))
