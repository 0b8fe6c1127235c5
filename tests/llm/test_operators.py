"""The ten operators against brute force, on edge cases and on empty tables."""

import hashlib
import itertools
import math
import os
import re

import numpy as np
import pytest

import brute
from conftest import SF001
from fleetpulse.llm import (budget_mix, bwt_repeats, line_crf, line_spread, lsh_forest, preference, queries,
                            spaced_seeds, textops, token_counts, toxic_segments)
from fleetpulse.llm.common import table

SF01 = "/root/testdata/sf0.01"
VOICE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box up jugs of amber ink"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
DOCS = [
    (1, "alpha\n" + VOICE + "\nomega line here", "en", "a"), (2, "alpha\n" + VOICE + "\nomega line here", "en", "b"),
    (2, "alpha\n" + VOICE + "\nomega line here", "en", "b"), (3, None, None, None), (4, "", "en", "a"),
    (5, " \n\t \n", "en", None), (None, VOICE, "en", "c"), (6, LONG, "en", "a"),
    (7, VOICE + " and then some more words follow", "en", "a"), (8, "one two", "en", "b"), (9, "one two", "fr", "b"),
    (10, "naïve café — 你好 世界 🙂\x00 nul\x85nel", "fr", "a"), (11, "x" * 49, "en", "a"), (12, "x" * 49, "en", "a"),
]
#: Columns the operators' results use, with other meanings.
CLASH = {"n_words": "'w'", "score": "'s'", "class_id": "true", "size": "'z'", "kept": "1", "contaminated": "'c'",
         "taken": "'t'", "n_removed": "'r'", "rank": "'k'", "cell": "'e'", "toxic": "'q'", "n_lines": "'l'",
         "tkey": "0", "k1": "'x'", "chunk": "'y'", "left": "'f'", "`a.b`": "'d'", "__k1": "'u'", "__mark": "'v'",
         "mark": "'m'", "`c``d`": "'b'"}


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    table(spark, SF001, "documents")  # session settings
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASH.items()])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def ids(rows):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows)


ALL = sorted((d[0] is not None, d[0] or 0) for d in DOCS)


# -- 1 ----------------------------------------------------------------------------

def test_op1_equals_brute_force(spark):
    docs = table(spark, SF001, "documents")
    want = brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op1_ngram_jaccard_join(spark, SF001).collect()}
    assert got == want


def test_op1_blocks_and_prefix_levels_lose_no_link(spark, monkeypatch):
    """One hot family, larger than a block, of many different near copies."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(60):
        w = list(base)
        for p in rng.choice(120, i % 4, replace=False):
            w[p] = f"edit{i}x{p}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{x}" for x in rng.integers(0, 5000, 80))) for i in range(20)]
    monkeypatch.setattr(lsh_forest, "BLOCK", 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in lsh_forest.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(rows)


def test_op1_a_hot_family_costs_no_other_link(spark):
    """300 near copies, and 300 pairs exactly on the threshold."""
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:i] + [f"edit{i}"] + base[i + 1:])) for i in range(300)]
    for i in range(300):
        w = [f"p{i}x{x}" for x in rng.integers(0, 10**9, 129)]
        rows += [(1000 + 2 * i, " ".join(w[:104])), (1001 + 2 * i, " ".join(w))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in lsh_forest.near_duplicates(df).collect()}
    assert all(got[1000 + 2 * i] == got[1001 + 2 * i] == (1000 + 2 * i, 1) for i in range(300))
    assert all(got[i] == (0, 299) for i in range(300))


def test_op1_near_copies_without_an_id_take_part(spark):
    w = [f"w{i}" for i in range(120)]
    near = lambda k: " ".join([*w[:k], "edit", *w[k + 1:]])
    lost = [f"v{i}" for i in range(60)]
    rows = [(7, " ".join(w)), (None, near(40)), (None, near(40)), (9, near(119)), (None, "quite alone here"),
            (None, " ".join(lost)), (None, " ".join([*lost, "more"])), (3, "another text of some words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.class_id, r.n_links, r.copies) for r in lsh_forest.near_duplicates(df).collect()]
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=key) == sorted([(7, 7, 3, 1), (9, 7, 3, 1), (None, 7, 3, 2), (None, 7, 3, 2),
                                           (None, None, 0, 1), (None, None, 1, 1), (None, None, 1, 1), (3, 3, 0, 1)],
                                          key=key)


def test_op1_edges(odd, none):
    got = lsh_forest.near_duplicates(odd).collect()
    assert ids(got) == ALL
    by = {r.doc_id: r for r in got}
    assert (by[1].class_id, by[1].n_links, by[1].copies) == (1, 2, 3) and by[2].class_id == 1
    assert (by[9].class_id, by[9].n_links) == (8, 1)
    assert all(by[i].class_id == i and by[i].n_links == 0 for i in (3, 4, 5, 6, 10))
    assert lsh_forest.near_duplicates(none).collect() == []


def test_op1_recall_per_similarity_and_prefixes_reached(spark):
    """100 pairs per similarity bin: all links are found, nearer pairs keep longer prefixes."""
    rng = np.random.default_rng(21)
    rows, bins = [], {}
    for i in range(500):
        share = (0.80, 0.82, 0.85, 0.92, 0.98)[i % 5]
        w = [f"p{i}x{x}" for x in rng.integers(0, 10**9, 204)]
        rows += [(2 * i, " ".join(w[:4 + math.ceil(200 * share)])), (2 * i + 1, " ".join(w))]
        bins.setdefault(share, []).append(2 * i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lsh_forest.near_duplicates(df).collect()}
    for pairs in bins.values():
        assert sum(got[i].n_links == got[i + 1].n_links == 1 and got[i + 1].class_id == i for i in pairs) >= 99
        assert all(got[i].prefix == got[i + 1].prefix for i in pairs)
    mean = [np.mean([got[i].prefix for i in bins[share]]) for share in sorted(bins)]
    assert mean == sorted(mean) and mean[0] < mean[-1] == lsh_forest.DEPTH
    alone = lsh_forest.near_duplicates(df.where("doc_id % 2 = 0").unionAll(df.where("doc_id % 2 = 0"))).collect()
    assert {(r.prefix, r.n_links, r.copies) for r in alone} == {(lsh_forest.DEPTH, 1, 2)}


def test_op1_descent_equals_brute_force():
    rng = np.random.default_rng(3)
    values, floor, least = lsh_forest.TREES * lsh_forest.DEPTH, 5, 120
    base = rng.integers(0, 9, (6, values)).astype(np.uint16)
    sig = base[rng.integers(0, 6, 90)]
    for i, row in enumerate(sig):
        at = rng.choice(values, i, replace=False)
        row[at] = rng.integers(0, 9, i)
    n, block = rng.integers(80, 120, 90), rng.integers(0, 2, 90)
    for across in (False, True):
        want = []
        for a in range(90):
            best = 0
            for b in range(90):
                same = sig[a] == sig[b]
                if a == b or (across and block[a] == block[b]) or same.sum() < least or (
                        min(n[a], n[b]) < 0.8 * max(n[a], n[b])):
                    continue
                lead = max(np.append(np.flatnonzero(~x), 8)[0] for x in same.reshape(-1, 8))
                best = min(best or 9, max(lead, floor))
            want.append(best)
        assert lsh_forest.descend(sig, n, block, across, 0.8, floor, least).tolist() == want
        assert 0 in want and len(set(want)) > 2


def test_op1_bounds():
    least = lsh_forest.least_agreement(0.8, lsh_forest.RECALL)
    below = np.random.default_rng(2).binomial(192, 0.8, 10**6) < least
    assert 110 < least < 130 and below.sum() <= 2 and lsh_forest.floor_depth(0.8, lsh_forest.RECALL) == 5


def test_chance_and_floor():
    assert lsh_forest.chance(1.0, 8) == 1 and lsh_forest.chance(0.8, 5) > lsh_forest.RECALL


# -- 3 ----------------------------------------------------------------------------

def _library_counts(texts):
    t = token_counts.load(queries.tokenizer_path("byte_bpe_50k.json"))
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_op3_equals_the_library(spark):
    docs = table(spark, SF001, "documents").collect()
    want = {d.doc_id: n for d, n in zip(docs, _library_counts([d.text for d in docs]), strict=True)}
    got = queries.op3_token_counts(spark, SF001).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_op3_special_strings_spaces_and_edges(spark, odd, none, monkeypatch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    counter = token_counts.Counter(path, token_counts.prove(path), token_counts.classes(path),
                                   token_counts.classes(path, token_counts.LATIN))
    texts = ["a<|endoftext|> b<|endoftext|><|endoftext|>", "  two   spaces \n\n\n end  ", "it's we'll 'tis 's", "<|endoftext",
             "x\x1cy\x85z", " nb", "tab\t\tnew\r\nline", "123 456,789!!", "été œuvre ſ", "ʼn", VOICE, LONG,
             "你好 世界 123", "Привет, мир! it's", "🙂🙂 x 🙂", "१२३ ४५", "é combining ﬁ Ⅳ ½", "a b　c d", "\U000E0001 tag",
             "word's don't 'll", "x!!y ##z", " ", "\n", "", None]
    assert counter.count(texts) == _library_counts(texts)
    assert [counter.count([t])[0] for t in texts] == _library_counts(texts)
    monkeypatch.setattr(token_counts, "CACHE_LIMIT", 3)
    for _ in range(3):
        assert counter.count([LONG, VOICE]) == _library_counts([LONG, VOICE])
    got = token_counts.token_counts(spark, odd, path).collect()
    assert sorted(r.n_tokens for r in got) == sorted(_library_counts([d[1] for d in DOCS]))
    assert sorted(r.n_bytes for r in got) == sorted(len((d[1] or "").encode()) for d in DOCS)
    assert token_counts.token_counts(spark, none, path).collect() == []


# -- 4 ----------------------------------------------------------------------------

def test_segments_are_the_maximal_ones():
    """Against the recursive definition: the best run, then the same on either side."""
    def plain(x, lo, hi):
        best = max(((sum(x[a:b]), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0),
                   key=lambda t: (round(t[0], 9), -t[2] + t[1]))
        if best[0] <= 1e-12:
            return []
        return plain(x, lo, best[1]) + [(best[1], best[2], round(best[0], 6))] + plain(x, best[2], hi)

    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 25))
        places = sorted(rng.choice(n, int(rng.integers(0, n + 1)), replace=False).tolist())
        weights = rng.normal(1, 2, len(places)).tolist()
        x = [-0.5] * n
        for p, w in zip(places, weights, strict=True):
            x[p] += w
        got = [(a, b, round(s, 6)) for a, b, s in toxic_segments.segments(places, weights, 0.5)]
        assert got == plain(x, 0, n)


def test_op4_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.predicted, r.score) for r in queries.op4_toxic_segments(spark, sf).collect()
           if r.held_out and r.doc_id in labels]
    found = sum(y == 1 and p == 1 for y, p, _ in got) / sum(y == 1 for y, _, _ in got)
    false = sum(y == 0 and p == 1 for y, p, _ in got) / sum(y == 0 for y, _, _ in got)
    assert found >= 0.85 and false <= 0.01
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, p, s in got)


def test_op4_edges(spark, odd, none, monkeypatch):
    monkeypatch.setattr(toxic_segments, "PRIOR_MASS", 10.0)  # of a corpus of a few thousand words
    schema = "doc_id long, toxic int"
    for labels in ([], [(1, 0), (2, 0)], [(None, 1), (3, None)]):
        model = toxic_segments.fit(odd, spark.createDataFrame(labels, schema))
        got = toxic_segments.score(odd, model).collect()
        assert ids(got) == ALL and {r.score for r in got} == {0.0}
    rows = [(i, f"{VOICE} w{i} {'vilename' if i % 5 == 0 else 'kindname'} z{i * 7} stop q{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxic_segments.fit(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], schema))
    assert {r.doc_id for r in toxic_segments.score(docs, model).collect() if r.predicted} == set(range(0, 100, 5))
    got = toxic_segments.score(odd, model).collect()
    assert ids(got) == ALL and not any(r.predicted for r in got) and got[0].class_id is True
    assert toxic_segments.score(none, model).collect() == []


# -- 5 ----------------------------------------------------------------------------

def _targets(sizes, weights=budget_mix.WEIGHTS):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (budget - sum(2 * sizes[s] for s in capped)) / (sum(w[s] for s in names if s not in capped) or 1)
        over = {s for s in names if s not in capped and w[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else w[s] * level for s in names}
        capped |= over


def test_op5_targets_sizes_and_reruns(spark):
    docs = {r.doc_id: r for r in table(spark, SF001, "documents").collect()}
    size = {i: len(brute.words(r.text)) for i, r in docs.items()}
    total = {}
    for i, r in docs.items():
        total[r.source] = total.get(r.source, 0) + size[i]
    want = _targets(total)
    got = queries.op5_budget_mix(spark, SF001).collect()
    taken = dict.fromkeys(total, 0)
    for r in got:
        s = docs[r.doc_id].source
        assert r.size == size[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    # About ten documents a source: the sums they can make are that far apart.
    assert all(abs(taken[s] - want[s]) <= 0.03 * total[s] for s in total if total[s] > 2000)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op5_budget_mix(spark, SF001).collect()))


def test_subset_and_budget():
    assert budget_mix.subset([3, 5], [2, 2], 11) == [2, 1]
    rng = np.random.default_rng(2)
    for _ in range(40):
        sizes = rng.choice(np.arange(1, 60), 5, replace=False)
        counts = rng.integers(1, 4, 5)
        budget = int(rng.integers(0, int((sizes * counts).sum()) + 1))
        take = np.array(budget_mix.subset(sizes.tolist(), counts.tolist(), budget))
        sums = {0}
        for s, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            sums = {x + s * k for x in sums for k in range(c + 1)}
        assert (take <= counts).all() and (take * sizes).sum() == max(x for x in sums if x <= budget)
        full = budget_mix.fit_budget(sizes, counts, budget)
        assert (full <= counts).all() and (full * sizes).sum() <= budget


def test_budget_is_met_beside_documents_longer_than_the_window():
    for sizes, counts, budget in (([300, 3_000_000], [10_000, 1], 3_000_000),
                                  ([300, 70_000], [10_000, 1], 1_500_000),
                                  ([*range(200, 400), 400_000], [50] * 200 + [5], 2_500_000),
                                  ([*range(200, 400), 400_000], [50] * 200 + [5], 4_900_000),
                                  ([100, 90_000, 1_000_000], [30_000, 20, 3], 5_700_000)):
        take = budget_mix.fit_budget(np.array(sizes), np.array(counts), budget)
        assert (take >= 0).all() and (take <= counts).all() and (take * sizes).sum() == budget
    take = budget_mix.fit_budget(np.array([7, 400_000]), np.array([100, 3]), 300_000)
    assert take.tolist() == [100, 0]


def test_op5_edges_and_hot_length(spark, odd, none):
    got = budget_mix.mix(odd).collect()
    assert ids(got) == ALL and all(r.taken <= 2 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert budget_mix.mix(none).collect() == []
    hot = spark.createDataFrame([(i, "a b c", "s" if i % 3 else "t") for i in range(900)],
                                "doc_id long, text string, source string")
    same = [(i % 3 or None, f"a b c {i % 50}", "s", i) for i in range(300)]  # repeated and missing ids of one size
    frames = [spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` long").repartition(n)
              for rows, n in ((same, 1), (same[::-1], 3), (sorted(same, key=lambda r: r[3] * 7 % 31), 5))]
    picks = [sorted((r["a.b"], r.taken) for r in budget_mix.mix(f).collect()) for f in frames]
    assert picks[0] == picks[1] == picks[2] and len({t for _, t in picks[0]}) > 1
    rows = budget_mix.mix(hot).collect()
    for s, target in _targets({"s": 1800, "t": 900}).items():
        assert abs(sum(r.taken for r in rows if r.source == s) - target) <= 3


# -- 6 ----------------------------------------------------------------------------

def test_op6_base_counts_and_labels(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    got = queries.op6_line_crf(spark, SF001).collect()
    for r in got:
        want = line_crf.base_counts_plain(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_op6_keeps_good_and_drops_bad(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r) for r in queries.op6_line_crf(spark, SF01).collect() if r.doc_id in labels]
    good = [r.kept for y, r in got if y == 1 and not r.base_failed]
    bad = [r.kept for y, r in got if y == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_op6_edges(odd, none, spark):
    assert line_crf.fit(odd, spark.createDataFrame([], "doc_id long, quality int")) is None
    got = line_crf.quality(odd, None).collect()
    assert ids(got) == ALL
    want = sorted(line_crf.base_counts_plain(d[1])[:4] for d in DOCS)
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in got) == want
    assert line_crf.quality(none, None).collect() == []


def _line_hash(line):
    import pyarrow as pa

    for _, _, data, off in textops.blocks(pa.array([line])):
        return line_crf.places(line_crf.Lines(data, off))[0]


def test_op6_shared_lines_are_told_from_copied_ones(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    footer, copied, rare = "Subscribe to our newsletter today", "One page that many sites copy", "Seen in few places"
    texts = [f"{own(i)}\n{footer}\n{own(i + 1000)}" for i in range(20)]          # ever new surroundings
    texts += [f"{own(-1)}\n\n{copied}\n{own(-2)}"] * 30                          # copies of one page
    texts += [f"{own(5000 + i)}\n{rare}" for i in range(3)] + [None, "", footer]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    of = np.unique(np.concatenate([_line_hash(x) for x in (footer, copied, rare, own(3))]))
    assert line_crf.shared_lines(docs, of).tolist() == _line_hash(footer).tolist()
    assert line_crf.shared_lines(docs.where("false"), of).tolist() == []


def test_op6_labels_lines_within_a_document(spark):
    """Boilerplate in good documents is marked, the text around it stays content."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    junk = lambda: "\n".join("#$ " * 6 + word().upper() + " !!" for _ in range(9))
    footer = "Accept all cookies to continue"
    good = [f"{prose(40)}\n{footer}\n{prose(30)}" for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + [junk() for _ in range(60)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in line_crf.quality(docs, line_crf.fit(docs, labels)).collect()}
    assert all(got[i].content_words == 70 and got[i].kept for i in range(60))
    assert all(got[i].content_words == 0 and not got[i].kept for i in range(60, 120))


def test_op6_whole_table_has_documents_with_both_labels(spark):
    got = queries.op6_line_crf(spark, SF01).collect()
    assert sum(0 < r.content_words < r.n_words for r in got) >= 0.1 * len(got)


def test_op6_long_texts_train_in_bounded_pieces():
    rows = lambda n: np.arange(n, dtype=np.float32)[:, None]
    assert line_crf.pieces(rows(0)) == []
    for n in (1, 256, 257, 2048):
        got = line_crf.pieces(rows(n))
        assert np.concatenate(got)[:, 0].tolist() == list(range(n)) and max(map(len, got)) <= 256
    got = line_crf.pieces(rows(100_000))
    assert [len(p) for p in got] == [256] * 8 and got[0][0, 0] == 0 and got[-1][-1, 0] == 99_999
    # A document cut into pieces weighs as much as a whole one.
    rng = np.random.default_rng(3)
    good, bad = (rng.normal(m, 1, (300, line_crf.N_FEATURES)) for m in (1, -1))
    one = line_crf.train([good, bad], [1, 0], steps=60)
    cut = line_crf.train([*np.array_split(good, 3), bad], [1, 1, 1, 0], steps=60, sizes=[300] * 4)
    assert np.allclose(one[0], cut[0], atol=0.05)


def test_op6_every_labelled_line_trains_and_the_gradient_is_exact(spark, monkeypatch):
    """More labelled documents than any sample: the distributed likelihood is the local one over all of them."""
    rows = [(i, "\n".join(f"{'# ' * (i % 3)}w{i}x{k} some words." for k in range(1 + i % 5))) for i in range(4000)]
    rows[7] = (7, "\n".join(f"line {k} of a long text" for k in range(3000)))
    docs = spark.createDataFrame([*rows, (None, "x"), (9000, None)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(9000, 1)], "doc_id long, quality int")
    at = []
    monkeypatch.setattr(line_crf, "ascend", lambda total, *a: at.append(total) or (None, None))
    assert line_crf.fit(docs, labels) is not None
    rng = np.random.default_rng(1)
    w, t = rng.normal(size=(line_crf.N_FEATURES, 2)), rng.normal(size=(2, 2, 2))
    import pyarrow as pa
    seqs = []
    for _, text in rows:
        for _, _, data, off in textops.blocks(pa.array([text])):
            seqs.append(line_crf.features(line_crf.Lines(data, off)))
    y = np.array([int(i % 3 == 0) for i, _ in rows])
    weights = np.array([0.5 / (y == k).sum() / len(s) for k, s in zip(y, seqs)])
    lines = [np.full(len(s), k) for k, s in zip(y, seqs)]
    want = line_crf.likelihood(w, t, seqs, lines, weights)
    assert np.allclose(at[0](w, t), want, rtol=1e-9, atol=1e-9)
    for k, (i, j) in enumerate([(3, 1), (0, 0)]):     # the gradient against differences
        d = np.zeros_like(w)
        d[i, j] = 1e-5
        slope = (line_crf.likelihood(w + d, t, seqs, lines, weights)[0]
                 - line_crf.likelihood(w - d, t, seqs, lines, weights)[0]) / 2e-5
        assert slope == pytest.approx(want[1 + 2 * i + j], abs=1e-6)
    d = np.zeros_like(t)
    d[0, 1, 0] = 1e-5
    slope = (line_crf.likelihood(w, t + d, seqs, lines, weights)[0] - line_crf.likelihood(w, t - d, seqs, lines, weights)[0]) / 2e-5
    assert slope == pytest.approx(want[1 + 2 * line_crf.N_FEATURES + 2], abs=1e-6)


def test_op6_texts_do_not_travel(spark, monkeypatch, capsys):
    """Training and labelling shuffle counts of lines, never texts, whatever the size of labels and lists."""
    rng, footer = np.random.default_rng(5), "Accept all cookies to continue"
    own = lambda i: " ".join(f"w{rng.integers(99)}x{i}" for _ in range(40))
    rows = [(i, f"{own(i)}\n{footer}\n{own(-i)}" if i % 2 else "#$ !!\n" * 60) for i in range(40)]
    docs = spark.createDataFrame([*rows, (None, rows[1][1]), (3, rows[1][1]), (50, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    frames, write = [], line_crf.Scratch.write
    monkeypatch.setattr(line_crf.Scratch, "write", lambda s, df, name: frames.append(df) or write(s, df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = line_crf.quality(docs, line_crf.fit(docs, labels))
        for df in [*frames, out]:
            df.explain("formatted")
        moved = re.findall(r"\) Exchange\s*\nInput.*: \[(.*)\]", capsys.readouterr().out)
        assert moved and not [m for m in moved if "text" in m]
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 43
    assert {(r.n_words, r.content_words, r.kept) for r in got if r.doc_id is None or (r.doc_id % 2 and r.doc_id < 40)} == {(85, 80, True)}


def test_op6_packed_counts_come_back():
    import pyarrow as pa

    texts = ["", "one line", None, "A b!\n\n \nA b!\n" + "#x 1 " * 20_000 + "\nend.", "\n", "x" * 70_000]
    for _, _, data, off in textops.blocks(pa.array(texts), block_bytes=1 << 30):
        x = line_crf.Lines(data, off)
        want = line_crf.line_counts(x)
        assert x.live_per.tolist() == [0, 1, 0, 4, 0, 1]
        assert want[1].tolist() == [2, 4, 0, 1, 1, 0, 1, 1, 1, 1, 0] and want[:, 1].max() == 100_000
        got = line_crf.packed(want, x.live_per)
        assert (line_crf.unpacked(got, x.live_per) == want).all()
        assert (line_crf.unpacked(got.slice(3, 3), x.live_per[3:]) == want[1:]).all()
        marks = line_crf.marked(pa.array([None, [0], None, [3, 1], None, []], pa.list_(pa.int32())), x.live_per)
        assert marks.tolist() == [True, False, True, False, True, False]
    assert list(line_crf.groups(np.array([2, 2, 0, 9, 1, 1]), 4)) == [(0, 3), (3, 4), (4, 6)]


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(3)
    for _ in range(40):
        s, t = rng.normal(size=(int(rng.integers(1, 8)), 2)), rng.normal(size=(2, 2))
        value = lambda p, s=s, t=t: sum(s[i, x] for i, x in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:]))
        best = max(product((0, 1), repeat=len(s)), key=value)
        assert value(tuple(line_crf.viterbi(s, t))) == pytest.approx(value(best))


# -- 7 ----------------------------------------------------------------------------

def test_op7_prefix_masks_and_edges(spark):
    turns = [(0, 0, "user", "hi <|x"), (0, 1, "assistant", "yes"), (0, 2, "user", "go"), (0, 3, "assistant", "A"),
             (1, 0, "user", "hi <|x"), (1, 1, "assistant", "yes"), (1, 2, "user", "go"), (1, 3, "assistant", None),
             (2, 0, "user", "q"), (2, 1, "assistant", "a"), (4, 0, None, "x"), (4, 0, None, "x"), (5, 0, None, "x"),
             (None, 0, "user", "lost")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").selectExpr(
        "*", "1 AS pair_id", "'p' AS prompt", "'c' AS chosen")
    got = {r.pair_id: r for r in preference.format_pairs(df).collect()}
    assert sorted(got) == [0, 1, 2]
    a = got[0]
    assert a.n_common == 3 and a.prompt.startswith("<|user|>\nhi < |x<|end|>\n") and a.usable
    assert a.chosen == "<|assistant|>\nA<|end|>\n" and a.rejected == "<|assistant|>\n<|end|>\n"
    assert [a.chosen[m.first:m.end] for m in a.chosen_mask] == ["A<|end|>\n"]
    assert got[1].n_common == 0 and got[1].rejected == "" and not got[1].usable
    assert got[2].n_common == 1 and got[2].rejected == "" and not got[2].usable
    assert preference.format_pairs(df.limit(0)).collect() == []


# -- 8 ----------------------------------------------------------------------------

BENCH = [(1, " ".join(f"item{i}" for i in range(20))), (2, "five words make this one"), (3, None), (4, "too short"),
         (5, "")]


def _leaks():
    w = BENCH[0][1].split()
    swap = w[:6] + ["CHANGED"] + w[7:13] + ["other"] + w[14:]
    return [(1, "so it begins " + BENCH[0][1].upper() + " and ends"), (2, "so " + " ".join(swap) + " end"),
            (3, " ".join(w[:12])), (4, " ".join(w[3:17])), (5, "we say five, words make this one!"), (6, VOICE),
            (7, None), (8, ""), (9, " ".join(reversed(w))), (None, BENCH[0][1]), (10, LONG + " " + BENCH[0][1])]


@pytest.mark.parametrize("limit", [spaced_seeds.MAX_BROADCAST_SEEDS, 0])
def test_op8_substitutions_and_both_joins(spark, limit):
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    df = spark.createDataFrame(_leaks(), "doc_id long, text string").selectExpr("*", "'x' AS items", "0 AS k1")
    got = {r.doc_id: r for r in spaced_seeds.mark(df, items, max_broadcast_seeds=limit).collect()}
    assert len(got) == 11 and {i for i, r in got.items() if r.contaminated} == {1, 2, 4, 5, 10, None}
    assert (got[1].best_item, got[1].best_overlap, got[1].covered_words) == (1, 20, 20)
    assert got[4].best_overlap == 14 and got[5].items == [2] and got[6].items == []


def test_op8_finds_every_planted_passage(spark):
    """Whole benchmark texts inside documents, by plain substring search."""
    items = table(spark, SF01, "benchmark").collect()
    docs = table(spark, SF01, "documents").collect()
    want = {d.doc_id for d in docs if any(i.text in d.text for i in items)}
    got = {r.doc_id for r in queries.op8_spaced_seeds(spark, SF01).collect() if r.contaminated}
    assert want and want <= got


@pytest.mark.parametrize("limit", [spaced_seeds.MAX_BROADCAST_SEEDS, 0])
def test_op8_equals_brute_force_on_a_table(spark, limit):
    """All columns of the result, by a walk along every diagonal; planted weak copies beside the table's own."""
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    rng = np.random.default_rng(9)
    for k in range(60):
        w = items[k % len(items)][1].split(" ")
        gone = rng.random(len(w)) < (0.1, 0.2, 0.25)[k % 3]
        docs.append((10**6 + k, " ".join(["before", *("x" if g else x for x, g in zip(w, gone, strict=True)), "after"])))
    want = brute.overlaps(docs, items)
    assert len({w[0][0] for w in want.values() if w[0]}) > 5
    got = spaced_seeds.mark(spark.createDataFrame(docs, "doc_id long, text string"),
                            table(spark, SF001, "benchmark"), max_broadcast_seeds=limit).collect()
    assert {r.doc_id: (r["items"], r.best_item, r.best_overlap, r.covered_words) for r in got} == want
    assert all(r.contaminated == bool(r["items"]) for r in got)
    if limit:
        rows = queries.op8_spaced_seeds(spark, SF001).collect()
        assert all((r["items"], r.best_item, r.best_overlap, r.covered_words) == want[r.doc_id] for r in rows)


def test_op8_filter_loses_no_seed():
    got = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    bitmap = np.zeros(1 << (spaced_seeds.FILTER_BITS - 6), np.uint64)
    slot = got[:2500] & np.uint64((1 << spaced_seeds.FILTER_BITS) - 1)
    np.bitwise_or.at(bitmap, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
    assert spaced_seeds._passes(bitmap, got[:2500]).all() and spaced_seeds._passes(bitmap, got[2500:]).sum() < 10


def test_op8_runs_equal_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(300):
        same = rng.random(int(rng.integers(1, 70))) < rng.choice([0.3, 0.7, 0.8, 0.9])
        n = len(same)
        good = [(i, j) for i in range(n) for j in range(i + 13, n + 1)
                if same[i] and same[j - 1] and 5 * int(same[i:j].sum()) >= 4 * (j - i)]
        want = [(i, j) for i, j in good if not any(a <= i and j <= b and (a, b) != (i, j) for a, b in good)]
        assert spaced_seeds.runs(same, 13, 0.8) == want


@pytest.mark.parametrize("limit", [spaced_seeds.MAX_BROADCAST_SEEDS, 0])
def test_op8_weak_words_beside_a_run_do_not_undo_it(spark, limit):
    long, short = [f"item{i}" for i in range(63)], [f"short{i}" for i in range(15)]
    weak = [w if i < 13 or i % 10 in (0, 1, 2, 4, 5, 7, 8) else f"x{i}" for i, w in enumerate(long)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id long, text string")
    rows = [(1, " ".join(weak))] + [(10 + k, " ".join(["so", *short[:k], "x", *short[k + 1:], "end"])) for k in (2, 12)]
    df = spark.createDataFrame([*rows, (2, " ".join(long[:12] + ["x"] * 20))], "doc_id long, text string")
    got = {r.doc_id: r for r in spaced_seeds.mark(df, items, max_broadcast_seeds=limit).collect()}
    assert got[1].items == [1] and 13 <= got[1].best_overlap < 63 and not got[2].contaminated
    assert all(got[10 + k].items == [2] and got[10 + k].best_overlap == 15 for k in (2, 12))


def test_op8_masks_miss_no_overlap_of_any_length():
    """The best score (equal +1, changed -4: 80 % equal is 0) of the runs without a mask, by their last words."""
    masks, n = [int(m, 2) for m in spaced_seeds.MASKS], 1 << (spaced_seeds.SPAN - 1)
    window = (np.arange(n) << 1)[:, None] | np.array([1, 0])  # an equal word, a changed one
    free = ~np.any([(window & m) == m for m in masks], axis=0)
    score = np.full(n, -np.inf)
    score[1] = 1  # a run starts on an equal word; before it nothing is known to be equal
    for length in range(2, 2 * n):
        new = np.full(n, -np.inf)
        for k, gain in enumerate((1, -4)):
            np.maximum.at(new, window[free[:, k], k] & (n - 1), score[free[:, k]] + gain)
        score = new
        assert length < 13 or score[1::2].max() < 0
    # Whole items whose first or last words are changed.
    for length in (13, 14, 15):
        for gone in itertools.combinations(range(length), length // 5):
            same = "".join("0" if i in gone else "1" for i in range(length))
            assert any(int(same[i:i + len(m)], 2) & int(m, 2) == int(m, 2)
                       for m in spaced_seeds.MASKS for i in range(length - len(m) + 1))


def test_op8_short_items_are_found_alike_by_both_joins(spark):
    for n in range(spaced_seeds.MIN_ITEM, spaced_seeds.MIN_OVERLAP):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not set(gone) & set(m) for m in spaced_seeds.whole_masks(n))
    text = {n: [f"w{n}x{i}" for i in range(n)] for n in (5, 7, 10, 12, 20)}
    items = spark.createDataFrame([(n, " ".join(w)) for n, w in text.items()], "item_id long, text string")
    rows, want = [], {}
    for n, w in text.items():
        for k, gone in enumerate(itertools.combinations(range(n), n // 5) if n < 20 else [(3, 8, 9, 16)]):
            rows.append((100 * n + k, " ".join(["so", *("x" if i in gone else x for i, x in enumerate(w)), "end"])))
            want[100 * n + k] = [n]
        rows.append((9000 + n, " ".join(["so", *w[:n * 4 // 5 - 1], "end"]))), want.update({9000 + n: [20] if n == 20 else []})
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (spaced_seeds.MAX_BROADCAST_SEEDS, 0):
        got = spaced_seeds.mark(df, items, max_broadcast_seeds=limit).collect()
        assert {r.doc_id: r.items for r in got} == want


def test_op8_repeated_item_ids(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(20)) for c in "uv")
    items = spark.createDataFrame([(7, one), (7, two), (7, two), (8, one)], "item_id long, text string")
    df = spark.createDataFrame([(1, one), (2, "so " + two), (3, "none of them")], "doc_id long, text string")
    want = {1: ([7, 8], 20), 2: ([7], 20), 3: ([], 0)}
    for limit in (spaced_seeds.MAX_BROADCAST_SEEDS, 0):
        got = spaced_seeds.mark(df, items, max_broadcast_seeds=limit).collect()
        assert {r.doc_id: (r["items"], r.best_overlap) for r in got} == want


def test_op8_empty_tables(spark, odd, none):
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    assert spaced_seeds.mark(none, items).collect() == []
    for limit in (0, 10**6):
        got = spaced_seeds.mark(odd, items.limit(0), max_broadcast_seeds=limit).collect()
        assert ids(got) == ALL and not any(r.contaminated for r in got)


# -- 9 ----------------------------------------------------------------------------

def test_op9_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    assert sorted(map(tuple, queries.op9_bwt_repeats(spark, SF001).collect())) == sorted(brute.repeats(docs))


def test_op9_edges_hot_anchors_and_small_chunks(spark, odd, none, monkeypatch):
    monkeypatch.setattr(bwt_repeats, "HEAVY", 2)
    monkeypatch.setattr(bwt_repeats, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(bwt_repeats, "PIECE", 300)
    key = lambda t: (t[0] is None, *[x or 0 for x in t[:4]], t[4])
    got = sorted(map(tuple, bwt_repeats.remove_repeats(odd).collect()), key=key)
    assert got == sorted(brute.repeats([d[:2] for d in DOCS]), key=key)
    rng = np.random.default_rng(8)
    line = "a boilerplate line of more than fifty bytes that a third of all documents show"
    rows = [(i, " ".join(f"v{x}" for x in rng.integers(0, 99, 20)) + (line if i % 3 else line[:60]) + f" tail {i}"
             + "ab" * (i % 40)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bwt_repeats.remove_repeats(df, keep_text=True).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute.repeats(rows))
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert bwt_repeats.remove_repeats(none).collect() == []


def test_expansion_equals_string_sets():
    rng = np.random.default_rng(3)
    for size in (10, 20, 50):
        base = "".join(rng.choice(list("abcd "), 300)).encode()
        found = {}
        for _ in range(12):
            a = int(rng.integers(0, 200))
            s = bytearray(base[a:a + size + int(rng.integers(0, 26))])
            if rng.random() < 0.5:
                s[int(rng.integers(0, len(s)))] = ord("z")
            found.setdefault(bytes(s), int(rng.integers(0, 8)))
        texts, owner = list(found), np.array(list(found.values()))
        best = {}
        for t, o in found.items():
            for i in range(len(t) - size + 1):
                best[t[i:i + size]] = min(o, best.get(t[i:i + size], 99))
        want = [sum(1 << i for i in range(len(t) - size + 1) if best[t[i:i + size]] < o) for t, o in found.items()]
        assert bwt_repeats.expand(texts, np.array([len(t) for t in texts]), owner, size).tolist() == want


# -- 10 ---------------------------------------------------------------------------

def test_op10_spread_band_and_edges(spark, odd, none):
    rows = []
    for i in range(60):
        site = f"s{i % 20}"
        lines = [f"own line number {i}", "everywhere the same", f"tail of {i} with more and more text to keep"]
        if i % 20 < 10:
            lines.insert(1, "on ten sites exactly")
        if i % 20 < 9:
            lines.insert(1, "on nine sites only")
        rows.append((i, "\n".join(lines), site))
    rows.append((100, "everywhere the same", "s0"))  # nothing else: an empty text is left
    rows.append((101, "\n".join(["everywhere the same", "on ten sites exactly"] * 5 + ["mine"]), "s0"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_spread.clean(df).collect()}
    for i, text, _ in rows[:-2]:
        want = [x for x in text.split("\n") if x not in ("everywhere the same", "on ten sites exactly")]
        assert got[i].text.split("\n") == want and got[i].n_removed == text.count("\n") + 1 - len(want)
    assert got[100].text == "" and got[100].n_removed == 1
    assert got[101].text == "mine" and got[101].n_removed == 10
    out = line_spread.clean(odd).collect()
    assert ids(out) == ALL and {r.n_lines for r in out if r.doc_id == 3} == {0} and out[0].score == "s"
    assert line_spread.clean(none).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    from tools.oracle_check import duck, rows_of

    df = queries.QUERIES[name](spark, SF01)
    res = duck(SF01).execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())
