"""Operators 11 to 13 against brute force, on edge cases and on empty tables."""

import bisect
import html
import itertools
import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest

from conftest import SF001
from fleetpulse.llm import filter_audit, queries, source_divergence, style_tree
from fleetpulse.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def clash(df):
    """Extra columns with the names that the operators use inside."""
    return df.selectExpr("*", "'x' AS mask", "'y' AS digest", "1 AS n", "'z' AS part", "'k' AS key", "2 AS host",
                         "3 AS p", "'o' AS ordinal", "'q' AS `a.b`", "4 AS good", "'r' AS rank", "5 AS __u")


# -- 11 ---------------------------------------------------------------------------

def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and least[t] < i)) if bad}
        rows.append((lang or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order):
                kept = removed = redundant = unique = gl = tl = 0
                for p, fails, g, x in rows:
                    if p != part:
                        continue
                    gone = bool(fails & set(order[:k]))
                    hit = f in fails
                    kept += not gone and not hit
                    removed += hit and not gone
                    redundant += hit and gone
                    unique += fails == {f}
                    gl += hit and not gone and g
                    tl += hit and not gone and x
                out[part, order, k + 1] = [kept, removed, redundant, unique, gl, tl]
                shapley[part, f] += removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


MANY = " ".join(f"w{i}" for i in range(120))
AUDIT_DOCS = [
    (1, MANY, "en"), (2, MANY, "en"), (2, MANY, "en"), (2, MANY, "de"), (None, MANY, "en"), (3, None, "en"),
    (4, "", None), (5, "", ""), (6, "A" * 9 + "b" * 81, "en"), (7, "A" * 10 + "b" * 89, "en"),
    (8, MANY + " 50%", "en"), (9, ("same " * 200).strip(), "en"), (10, "ÀÉ🙂" * 40, "fr"), (11, "a\x85b c\x0bd " * 60, "fr"),
    (12, " ".join(f"W{i} {i}" for i in range(300)), "en"), (13, "x" * 300_000, "en"), (1, MANY + " |", "en"),
    (-5, MANY, "fr"),
]
AUDIT_LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (8, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, 0)]


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in df.collect()}


def test_op11_equals_brute_force_on_edge_cases(spark):
    table(spark, SF001, "documents")
    docs = clash(spark.createDataFrame(AUDIT_DOCS, "doc_id long, text string, lang string"))
    labels = spark.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS good", "2 AS id")
    got = audit_rows(filter_audit.audit(docs, labels))
    assert got == brute_audit(AUDIT_DOCS, AUDIT_LABELS)
    assert len(got) == 600 * 4  # de, en, fr and the empty string


def test_op11_equals_brute_force_on_a_table(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, SF001, "documents").collect()]
    labels = [tuple(r) for r in table(spark, SF001, "labels").select("doc_id", "quality", "toxic").collect()]
    assert audit_rows(queries.op11_filter_audit(spark, SF001)) == brute_audit(docs, labels)


def test_op11_empty_tables(spark):
    docs = spark.createDataFrame(AUDIT_DOCS, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    none = audit_rows(filter_audit.audit(docs, labels.limit(0)))
    assert all(v[4] == v[5] == 0 for v in none.values())


# -- 12 ---------------------------------------------------------------------------

class Article(HTMLParser):
    """Blocks of the article element, for pages whose only content is in one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.blocks.append("") if tag in ("p", "h1", "article") else None

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.blocks.append("") if tag in ("p", "h1", "article") else None

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def article(page):
    p = Article()
    p.feed(page or "")
    p.close()
    return "\n".join(b for b in (" ".join(x.split()) for x in p.blocks) if b)


def test_op12_keeps_the_article_of_every_page(spark):
    pages = {r.page_id: r for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    got = queries.op12_style_tree(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def site(i, copies=()):
    """A page without any telling mark: menu, notice and footer by texts and place only."""
    own = copies.get(i, i) if copies else i
    body = "".join(f"<p>Story {own} part {k} tells of matter {own * 7 + k} at some length &amp; care.</p>"
                   for k in range(2 + own % 3))
    return (f"<html><head><title>Site</title></head><body><div class=x1><ul><li>Home</li><li>About</li><li>Shop</li>"
            f"</ul></div><div class=x2>We use small files to remember you.</div><div class=x3>{body}"
            f"</div><div class=x4>All rights kept, line {i % 2}</div></body></html>")


def body_text(i, copies=()):
    own = copies.get(i, i) if copies else i
    return "\n".join(f"Story {own} part {k} tells of matter {own * 7 + k} at some length & care." for k in range(2 + own % 3))


def test_op12_style_tree_finds_unmarked_boilerplate(spark):
    copies = {5: 4, 6: 4, 7: 4, 8: 4}
    rows = [(i, "http://one.example/%d" % i, site(i, copies)) for i in range(40)]
    rows += [(100, "http://lone.example/", site(100))]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r.text for r in style_tree.extract(spark, pages).collect()}
    for i in range(40):
        assert got[i] == body_text(i, copies), i
    # One page of a host: nothing repeats, so nothing is boilerplate.
    assert got[100].startswith("Home\nAbout\nShop\nWe use") and body_text(100) in got[100]


def test_op12_marked_articles_are_judged_by_the_tree(spark):
    """The same notice in every article of a host leaves; a title that two pages share stays."""
    page = lambda i, title: (f"<body><nav><a>Menu</a></nav><article><h1>{title}</h1><p>Story {i} tells of {i * 7} things"  # noqa: E731
                             f"</p><p>Follow us for more</p></article><footer>end</footer></body>")
    rows = [(i, f"http://one.example/{i}", page(i, f"Title {i % 15}")) for i in range(30)]
    rows += [(100 + i, f"http://two.example/{i}", page(i, "News")) for i in range(2)]
    rows += [(200 + i, f"http://copies.example/{i}", page(1, "News")) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.extract(spark, pages).collect()}
    for i in range(30):
        assert got[i] == f"Title {i % 15}\nStory {i} tells of {i * 7} things"
    for i in (100, 200, 239):
        assert got[i] == f"News\nStory {int(i >= 200)} tells of {7 * (i >= 200)} things\nFollow us for more"


def brute_importance(pages):
    """Importance by a tree of tuples instead of hashes, for (host, html) rows."""
    hosts = defaultdict(dict)
    for host, page in pages:
        tree = style_tree.parse(page)
        found = []

        def walk(node, path, found=found):
            if node.text is not None:
                found.append((path, node.text))
                return
            style = tuple(c.label for c in node.children)
            found.append((path, style))
            for k, c in enumerate(node.children):
                walk(c, (*path, style, k, c.label))

        walk(tree, ())
        name = max((t for _, t in found if isinstance(t, str)), key=lambda t: (len(t), t))
        hosts[host].setdefault(name, set()).update(found)
    out = []
    for host, by_name in hosts.items():
        counts = defaultdict(Counter)
        for found in by_name.values():
            for path, variant in found:
                counts[path][variant] += 1
        for c in counts.values():
            m = sum(c.values())
            s = sum(n * math.log(n) for n in c.values())
            out.append((m, 1.0 if len(by_name) == 1 else 1 - s / (m * math.log(len(by_name)))))
    return sorted(out)


def test_op12_importance_equals_brute_force(spark):
    copies = {5: 4, 6: 4}
    rows = [(i, "http://%s.example/%d" % ("ab"[i % 2], i), site(i, copies)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = style_tree.importance(style_tree.node_rows(style_tree.with_site(pages))).collect()
    want = brute_importance([("ab"[i % 2], h) for i, _, h in rows])
    assert sorted((r.m, round(r.importance, 9)) for r in got) == sorted((m, round(x, 9)) for m, x in want)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain &lt;words&gt;\n and  more", "plain <words> and more"),
    ("<p>one<p>two<br>three<ul><li>a<li>b</ul>four", "one\ntwo three\na\nb\nfour"),
    ("<nav>menu</nav><main><h1>T</h1><form>ask</form><p>x <b>y</b>&nbsp;z</p><aside>s</aside></main><p>out</p>", "T\nx y z"),
    ("<form id=all><header>H</header><article><header><h1>T</h1></header><p>x</p><div class='reader-comments'>"
     "<article><p>first!</p></article></div></article></form>", "T\nx"),
    ("<div class='cookie-notice'>ok?</div><p>text</p><div hidden>no</div><span class=ad>buy</span>", "text"),
    ("<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p title='a>b'>yes</p", "yes"),
    ("<p>a</p></div></b></section><p>b", "a\nb"), ("<" * 50 + "p>x", "<" * 49 + "\nx"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<p class=\"open>never closed</p><p>x</p>", "never closed\nx"),
    ("&amp &am; &#8364; &copy; &unknown;", "& &am; € © &unknown;"),
    ("<div>" * 500 + "deep" + "</div>" * 500 + "after", "deep\nafter"),
])
def test_op12_blocks(spark, page, want):
    blocks = style_tree.nodes(style_tree.parse(page or ""))[1]
    assert "\n".join(t for _, t, w, _ in blocks if w is None or w == 1.0) == want


def test_op12_edge_tables(spark):
    long = "<article>" + "".join(f"<p>para {i} of many</p>" for i in range(30_000)) + "</article>"
    rows = [(1, None, None), (None, "http://a.example/", "<p>a</p>"), (None, "http://a.example/", "<p>a</p>"),
            (2, "not a url", ""), (3, "http://a.example/", long), (3, "http://u@A.example:80/x", "<p>b</p>")]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = style_tree.extract(spark, pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == sorted(
        [(1, 0), (0, 1), (0, 1), (2, 0), (3, 1), (3, sum(len(f"para {i} of many") + 1 for i in range(30_000)) - 1)])
    assert style_tree.extract(spark, pages.limit(0)).count() == 0


# -- 13 ---------------------------------------------------------------------------

def sorted_terms(rng, n):
    return sorted({bytes(rng.integers(97, 97 + 3, rng.integers(1, 9)).astype(np.uint8)) for _ in range(n)}
                  | {"é".encode(), "éa".encode(), bytes([0xff, 0x80]), b"a"})


def test_op13_transducer_gives_ordinals():
    rng = np.random.default_rng(5)
    for n in (0, 1, 40, 3000):
        words = sorted_terms(rng, n)
        m = source_divergence.Transducer.unpack(source_divergence.Transducer.build(words).pack())
        assert list(m.terms()) == words
        ask = words + [w + b"a" for w in words] + [w[:-1] for w in words] + [b"zz", b""]
        data = np.frombuffer(b"".join(ask), np.uint8)
        ends = np.cumsum([len(w) for w in ask])
        got = m.ordinals(data, ends - [len(w) for w in ask], ends).tolist()
        at = [bisect.bisect_left(words, w) for w in ask]
        assert got == [i if i < len(words) and words[i] == w else -1 for i, w in zip(at, ask)]
    with pytest.raises(ValueError):
        source_divergence.Transducer.build([b"b", b"a"])


def test_op13_transducer_is_minimal():
    words = sorted(p + s for p in (b"walk", b"talk", b"work") for s in (b"", b"ed", b"er", b"ing", b"s"))
    m = source_divergence.Transducer.build(words)
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p))
               for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(m.final) - 1 == len(endings)  # the start state is kept twice


def brute_divergence(docs, min_docs):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    df, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = term.findall((text or "").translate(low))
        df[lang or ""].update(set(found))
        count[lang or "", source or ""].update(found)
    out = []
    for lang in df:
        kept = sorted((t for t, n in df[lang].items() if n >= min_docs), key=str.encode)
        groups = {s: c for (g, s), c in count.items() if g == lang}
        rate = {}
        for s, c in [*groups.items(), (None, sum(groups.values(), Counter()))]:
            total = sum(c[t] for t in kept)
            rate[s] = {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s, c in groups.items():
            pairs = sorted((-sum(abs(rate[s][t] - rate[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            top = sorted((rate[None][t] - rate[s][t], t.encode(), t) for t in kept if c[t] and rate[s][t] > rate[None][t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(top[:50])]
    return sorted(out)


def divergence_rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_op13_equals_brute_force_on_a_table(spark):
    docs = [(r.text, r.lang, r.source) for r in table(spark, SF001, "documents").collect()]
    got = divergence_rows(queries.op13_source_divergence(spark, SF001))
    assert got == brute_divergence(docs, source_divergence.MIN_DOCS)


def test_op13_edge_cases_with_small_ranges(spark, monkeypatch):
    docs = [(None, "en", "a"), ("", None, None), ("Éa éa ÉA x-Y_z", "fr", "b")] * 2
    docs += [(f"Common term{'abc'[i % 3]} {'Rare' if i % 5 else 'often'} naïve 你好 tie{'xyz'[i % 3]}", "en", "abcd"[i % 4])
             for i in range(70)]
    docs += [("common " * 5000 + "s" * 9000, "en", "a")] * 31 + [("only one", "it", "a")]
    monkeypatch.setattr(source_divergence, "RANGE_TERMS", 3)
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", 2)
    monkeypatch.setattr(source_divergence, "HELD_SUMS", 7)
    monkeypatch.setattr(source_divergence, "PIECE_BYTES", 1000)
    df = clash(spark.createDataFrame(docs, "text string, lang string, source string"))
    want = brute_divergence(docs, source_divergence.MIN_DOCS)
    assert divergence_rows(source_divergence.audit(spark, df)) == want
    assert {r[2] for r in want} == {"pair", "term"} and len({r[3] for r in want if r[0] == "en"}) > 8
    assert source_divergence.audit(spark, df.limit(0)).count() == 0


def test_op13_long_terms_are_not_cut():
    text = (b"ab " * 500 + b"x" * 5000 + b" Cd") * 3
    got = [t for part in source_divergence.terms(text) for t in part]
    assert got == re.findall(rb"[a-z]+", text.lower())
    source_divergence.PIECE_BYTES, old = 700, source_divergence.PIECE_BYTES
    try:
        assert [t for part in source_divergence.terms(text) for t in part] == got
    finally:
        source_divergence.PIECE_BYTES = old


def test_html_unescape_is_the_library_of_references():
    assert html.unescape("&middot;") == "·"
