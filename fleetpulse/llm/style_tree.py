"""Main text of web pages by a site style tree (operator 12).

The pages of one host are merged into a style tree: elements merge when the
elements above them merged and stand in the same sequence of siblings (the
presentation style of their parent).  A *presentation* node varies by the
style of its children, a *content* node (a block of text) by its text.  Over
the M different pages of a host, a node that stands on m of them in variants
of c_1, c_2, ... pages has the importance

    1 - sum(c ln c) / (m ln M)

the entropy of its variants, raised where only few pages have it: 0 for the
same notice on every page, 1 for a text that no other page has.  A block
counts as the most important of itself and the presentation nodes it hangs
on; this is weighted by what the markup says of it, and blocks below
``LEAST`` leave their page:

* weight 1/2 below an element that names itself a menu, footer, advert, form,
  comment and the like (``NOISE``), and outside of the article on pages that
  mark one (``article``, ``main``);
* an article's other blocks stand in the tree like all others, and the article's mark counts as
  ``VOUCHED`` further pages with texts of their own: a title that two pages
  share stays, a notice that every page repeats inside its article leaves;
* pages of a host with the same longest block count as one page, so copies of an
  article on one host do not make each other boilerplate.

Head, scripts, styles, comments of the markup and void elements hold no text.
A block is the text between two starts or ends of block elements; references
are decoded, white space (Unicode's) becomes one space, ``br`` too.

Scale: pages are parsed twice, in tasks.  Between lie narrow rows, one per
node, aggregated by (host, node): a host with a third of
all pages is spread over its nodes and pre-aggregated by task, and no host is
ever held in one place.  Pages meet those of their blocks
that the tree cuts by a digest of host and html; such lists are written first, so
that Spark broadcasts them where they are short and no page is shuffled.

Defined cases: null html or url are empty; an empty page has an empty text;
repeated pages and page ids give a row each, like pages the same text;
unclosed and stray tags follow the usual implied ends; elements nested deeper
than ``MAX_DEPTH`` lend their text to the one at that depth; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as markup
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, BOOL, DOUBLE, LONG, STRING, Scratch, field, map_arrow

#: Blocks of less importance leave their page.
LEAST = 0.7
#: Weight of what the markup itself sets apart from the article.
ASIDE = 0.5
#: Pages that the mark of an article counts for, on behalf of its blocks.
VOUCHED = 8
MAX_DEPTH = 64

# Fixed values of HTML: elements without content, with raw content, and inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe object svg math canvas audio video head title select "
                "textarea button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
#: Start tags that end an open element of the first set, up to one of the second.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Block elements do not stand inside a paragraph: their start ends it.
KEEPS_P = INLINE | {"br", "img", "wbr", "input"}

ARTICLE = frozenset(("article", "main"))
NOISE_TAGS = frozenset("nav footer aside menu dialog".split())
#: Forms are no content unless they hold an article or a first heading, as a page inside one form does.
FORM_TAGS = frozenset("form fieldset".split())
#: Headers of an article belong to it.
WEAK_TAGS = frozenset(("header",))
NOISE_ROLES = frozenset("navigation contentinfo complementary search alert dialog alertdialog menu menubar".split())
WEAK_ROLES = frozenset(("banner",))
NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent notice gdpr popup modal
    overlay newsletter subscribe signup share sharing social related recommended comment comments disqus reply replies
    respond widget toolbar pagination pager login skip""".split())
WEAK_NAMES = frozenset("header masthead topbar".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>
                   |<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>
                   |</?[a-zA-Z][^>]*\Z""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}

CONTENT, FREE, NOISY = 0, 1, 2


class Node:
    __slots__ = ("tag", "label", "form", "weak", "strong", "article", "children", "text")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.text, self.form = tag, [], None, tag in FORM_TAGS
        self.label, self.weak, self.strong, self.article = tag, tag in WEAK_TAGS, tag in NOISE_TAGS, tag in ARTICLE
        if attributes and not attributes.isspace():
            self._read(attributes)

    def _read(self, attributes: str) -> None:
        got = {}
        for name, value in ATTRIBUTE.findall(attributes):
            got.setdefault(name.lower(), value.strip("\"'"))
        names = {p.lower() for n in ("class", "id") for p in NAME.findall(got.get(n, ""))}
        role = got.get("role", "").strip().lower()
        self.label = f"{self.tag}.{' '.join(sorted(got.get('class', '').split()))}"
        self.article |= role in ("main", "article") or got.get("itemprop", "") == "articleBody"
        self.form |= role == "form"
        self.weak |= role in WEAK_ROLES or not names.isdisjoint(WEAK_NAMES)
        self.strong |= (role in NOISE_ROLES or not names.isdisjoint(NOISE_NAMES) or "hidden" in got
                        or got.get("aria-hidden", "").lower() == "true")


def parse(page: str) -> Node:
    """The page's block elements as a tree; its leaves are blocks of text, in page order."""
    root = Node("html")
    stack, buffer = [root], []
    at, size = 0, len(page)

    def flush():
        if buffer:
            text = " ".join(markup.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                leaf = Node("#text")
                leaf.text = text
                stack[-1].children.append(leaf)

    def close(depth: int):
        flush()
        del stack[depth:]

    def opened(tags, stop=frozenset()):
        for d in range(len(stack) - 1, 0, -1):
            if stack[d].tag in tags:
                return d
            if stack[d].tag in stop:
                return None
        return None

    deep: list[str] = []  # open elements below MAX_DEPTH, by tag
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        if m.start() > at:
            buffer.append(page[at:m.start()])
        at = m.end()
        end, start, attributes, start2, attributes2 = m.groups()
        if end:
            tag = end.lower()
            if tag in INLINE:
                if stack[-1].tag == tag and len(stack) > 1:
                    close(len(stack) - 1)  # an inline element that names itself noise
                continue
            if tag in deep:
                flush()
                del deep[len(deep) - 1 - deep[::-1].index(tag):]
                continue
            d = opened({tag})
            if d is not None:
                deep.clear()
                close(d)
            else:
                flush()
            continue
        tag = (start or start2 or "").lower()
        if not tag:
            continue  # comment, doctype, processing instruction
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            over = RAW_END[tag].search(page, at)
            if over is not None:
                at = over.end()
            elif tag != "head":  # without its end the head goes up to the next body
                at = size
            buffer.append(" ")
            continue
        if tag in ("html", "body"):
            flush()
            if tag == "body" and len(stack) == 1:
                stack[0].children.append(body := Node("body"))
                stack.append(body)
            continue
        node = Node(tag, attributes if start else attributes2)
        if tag in INLINE and not node.strong:
            continue
        if tag not in KEEPS_P:
            p = opened({"p"}, {"table", "article", "section", "div", "button"})
            if p is not None:
                close(p)
        ends = ENDS.get(tag)
        if ends:
            d = opened(*ends)
            if d is not None:
                close(d)
        flush()
        if tag == "h1":
            for above in stack:
                above.form = False
        if len(stack) > MAX_DEPTH:
            deep.append(tag)
            continue
        stack[-1].children.append(node)
        stack.append(node)
    flush()
    return root


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"\x00".join(parts), digest_size=8).digest()


def number(raw: bytes) -> int:
    return int.from_bytes(raw, "little", signed=True)


def nodes(root: Node):
    """(presentations, blocks) of a page in page order.

    A presentation is (key, style); a block (key, text, weight, chain) with
    the keys of the presentations below the body that it hangs on.  Blocks of
    an article that nothing sets apart have weight None: 1, vouched for by its mark.
    """
    presentations, blocks = [], []
    marked = False
    stack = [(root, _digest(b"site"), (), FREE, False)]  # node, key, chain, state, set apart for good
    while stack:
        node, key, chain, state, strong = stack.pop()
        strong |= node.strong
        if strong or node.form or node.weak and state != CONTENT:
            state = NOISY
        elif node.article:
            state = CONTENT
        if node.text is not None:
            marked |= state == CONTENT
            blocks.append([key, node.text, state, chain])
            continue
        style = _digest(*(c.label.encode() for c in node.children))
        presentations.append((key, number(style)))
        below = chain if node.tag in ("html", "body") else (*chain, number(key))
        for i in range(len(node.children) - 1, -1, -1):
            child = node.children[i]
            stack.append((child, _digest(key, style, b"%d" % i, child.label.encode()), below, state, strong))
    for b in blocks:
        b[2] = None if b[2] == CONTENT else ASIDE if marked or b[2] == NOISY else 1.0
        b[0] = number(b[0]) ^ (2 if b[2] is None else b[2] == ASIDE)
    return [(number(k), s) for k, s in presentations], blocks


# -- on Spark ---------------------------------------------------------------------

def with_site(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """host, u, v (digest of host and html), page: what a row's text depends on."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")),
                                    r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)", 1))
    page = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select("*", host.alias("__host"), F.xxhash64(host, page).alias("__u"),
                        F.xxhash64(page, F.lit(12), host).alias("__v"), page.alias("__page"))


NODE = [field("host", STRING), field("u", LONG), field("v", LONG), field("page", LONG), field("key", LONG),
        field("variant", LONG), field("weight", DOUBLE), field("vouched", LONG), field("chain", T.ArrayType(LONG))]


def node_rows(sited: DataFrame) -> DataFrame:
    """One row per node; ``weight`` is null for presentations."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in NODE]
            for host, u, v, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                        b.column(3)):
                presentations, blocks = nodes(parse(page.as_py()))
                free = [t for _, t, w, _ in blocks if w != ASIDE] or [t for _, t, _, _ in blocks]
                name = number(_digest(max(free, key=lambda t: (len(t), t), default="").encode()))
                rows = [(k, s, None, 0, None) for k, s in presentations]
                rows += [(k, number(_digest(t.encode("utf-8", "surrogatepass"))), 1.0 if w is None else w,
                          VOUCHED if w is None else 0, list(chain)) for k, t, w, chain in blocks]
                for row in rows:
                    for col, x in zip(out, (host, u, v, name, *row), strict=True):
                        col.append(x)
            yield out

    return map_arrow(sited, ["__host", "__u", "__v", "__page"], NODE, run)


def importance(rows: DataFrame) -> DataFrame:
    """host, key, m, importance of every node, over the different pages of its host."""
    judged = F.max("weight").alias("weight"), F.max("vouched").alias("vouched")
    once = rows.groupBy("host", "key", "variant", "page").agg(*judged)
    variants = once.groupBy("host", "key", "variant").agg(F.count(F.lit(1)).alias("c"), *judged)
    per_node = variants.groupBy("host", "key").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("s"),
        *judged)
    sites = rows.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(
        F.count(F.lit(1)).alias("site_pages"))
    imp = F.when(F.col("site_pages") > 1,
                 1 - F.col("s") / ((F.col("m") + F.col("vouched"))
                                   * F.log((F.col("site_pages") + F.col("vouched")).cast("double")))).otherwise(1.0)
    return per_node.join(sites, "host").select("host", "key", "m", "weight", imp.alias("importance"))


def cut_blocks(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """host, key of the blocks whose weighted importance is below ``LEAST``, but not their weight alone."""
    own = scored.where("weight IS NOT NULL")
    maybe = own.where((F.col("weight") >= LEAST) & (F.col("weight") * F.col("importance") < LEAST)).select("host", "key")
    chains = rows.where("weight IS NOT NULL").join(maybe, ["host", "key"]).select("host", "key", "chain") \
        .dropDuplicates(["host", "key"])
    hangs = chains.select("host", "key", F.explode("chain").alias("above"))
    held = hangs.join(scored.where((F.col("weight").isNull()) & (F.col("importance") >= LEAST))
                      .select("host", F.col("key").alias("above")), ["host", "above"]).select("host", "key").distinct()
    return maybe.join(held, ["host", "key"], "left_anti")


def text_of(page: str, cut: frozenset) -> str:
    return "\n".join(t for k, t, w, _ in nodes(parse(page))[1] if k not in cut and (w is None or w >= LEAST))


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", scratch: Scratch | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) per row of ``pages``."""
    scratch = scratch or Scratch(spark, "style-tree")
    sited = with_site(pages.select(id_col, url_col, html_col), html_col, url_col)
    rows = scratch.write(node_rows(sited), "nodes")
    scored = scratch.write(importance(rows), "importance")
    cut = cut_blocks(rows, scored)
    lists = scratch.write(rows.where(F.col("weight") >= LEAST).join(cut, ["host", "key"]).groupBy("u", "v").agg(
        F.collect_set("key").alias("cut")), "lists")
    joined = sited.join(lists, (F.col("__u") == F.col("u")) & (F.col("__v") == F.col("v")), "left")

    def run(batches):
        for b in batches:
            texts = [text_of(p.as_py(), frozenset(c or ()))
                     for p, c in zip(b.column(2), b.column(3).to_pylist())]
            yield [b.column(0), b.column(1), pa.array(texts, pa.string()),
                   pa.array([len(t) for t in texts], pa.int64())]

    return map_arrow(joined, [F.col(id_col), F.col(url_col), F.col("__page"), F.col("cut")],
                     [field(id_col, pages.schema[id_col].dataType), field(url_col, pages.schema[url_col].dataType),
                      field("text", STRING), field("n_chars", LONG)], run)
