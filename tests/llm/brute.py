"""Brute-force versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re


def repeats(rows, size=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) per (doc_id, text) row."""
    last = 2**63 - 1
    first = {}
    raws = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    for i, r in raws:
        for p in range(len(r) - size + 1):
            s = r[p:p + size]
            if first.get(s, last + 1) > i:
                first[s] = i
    out = []
    for (orig, _), (i, r) in zip(rows, raws, strict=True):
        gone = bytearray(len(r))
        for p in range(len(r) - size + 1):
            if first[r[p:p + size]] < i:
                gone[p:p + size] = b"\x01" * size
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((orig, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def near_duplicates(rows, threshold=0.8):
    """doc_id -> (class_id, n_links) of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    links = {i: set() for i in sets}
    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                continue
            n = len(x & y)
            if n >= threshold * (len(x) + len(y) - n) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    root = {}
    for i in sorted(sets):
        if i in root:
            continue
        todo, root[i] = [i], i
        while todo:
            for j in links[todo.pop()]:
                if j not in root:
                    root[j] = i
                    todo.append(j)
    return {i: (root[i], len(links[i])) for i in sets}


def overlaps(docs, items, least=13):
    """doc_id -> (item ids, best item, its overlap, covered words), every diagonal of every pair walked."""
    def split(text):
        return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())

    benchmark = [(i, w) for i, t in items if len(w := split(t)) >= 5]
    out = {}
    for doc, text in docs:
        d = split(text)
        where, best, covered = {}, {}, set()
        for p, x in enumerate(d):
            where.setdefault(x, []).append(p)
        for item, w in benchmark:
            for g in {p - q for q, x in enumerate(w) for p in where.get(x, ())}:
                lo, hi = max(0, g), min(len(d), g + len(w))
                same = [d[p] == w[p - g] for p in range(lo, hi)]
                if 5 * sum(same) < 4 * min(least, len(w)):
                    continue
                if len(same) == len(w) and 5 * sum(same) >= 4 * len(w):
                    good = [(0, len(w))]
                else:
                    good = [(a, b) for a in range(len(same)) for b in range(a + min(least, len(w)), len(same) + 1)
                            if same[a] and same[b - 1] and 5 * sum(same[a:b]) >= 4 * (b - a)]
                for a, b in good:
                    best[item] = max(best.get(item, 0), b - a)
                    covered.update(range(lo + a, lo + b))
        top = min(best, key=lambda i: (-best[i], i)) if best else None
        out[doc] = (sorted(best), top, best.get(top, 0), len(covered))
    return out
