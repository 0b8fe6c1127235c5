"""The registered queries of this subpackage and their SQL.

Each query applies its operator, with production parameters, to its whole
table.  ``ORACLE_SQL`` has DuckDB SQL where SQL can express the result; the
other queries are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (budget_mix, bwt_repeats, filter_audit, line_crf, line_spread, lsh_forest, preference, source_divergence,
               spaced_seeds, style_tree, token_counts, toxic_segments, warc)
from .common import Scratch, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: near-duplicate class, links, copies."""
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back by the salvage reader."""
    scratch = Scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), scratch.path("archives"))
    records = warc.whole(warc.read(spark, scratch.path("archives"), payloads=False))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token counts of every whole text under the public byte-level vocabulary."""
    return token_counts.token_counts(spark, table(spark, sf_dir, "documents"),
                                     tokenizer or tokenizer_path("byte_bpe_50k.json"))


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        import sys

        sys.path.append("/opt/tokenizers")
        sys.path.append("/opt")
        import public_tokenizers
    return str(public_tokenizers.path(name))


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; the fit sees no held-out label."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxic_segments.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted",
                         "n_segments")


def op5_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to source targets: words taken of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # The text's digest stands in for it where rows with one id and one size are ordered.
    sized = docs.select("doc_id", "source", F.md5("text").alias("digest"), budget_mix.words(F.col("text")).alias("n"))
    return budget_mix.mix(sized, size=F.col("n")).select("doc_id", "size", "source_size", "target", "taken")


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-labelling verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return line_crf.quality(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 as chosen and rejected, with loss masks as text."""
    pairs = preference.format_pairs(table(spark, sf_dir, "conversations"))
    mask = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["first"], x["end"])), ",")
    return pairs.withColumns({"chosen_mask": mask("chosen_mask"), "rejected_mask": mask("rejected_mask")})


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark overlaps of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spaced_seeds.mark(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op9_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings that also start in an earlier document."""
    return bwt_repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document as cross-site boilerplate."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = line_spread.clean(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders: what each step keeps, removes and finds removed, per language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return style_tree.extract(spark, table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources compared with each other and with their language, over the kept terms."""
    return source_divergence.audit(spark, table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_warc_salvage, op3_token_counts, op4_toxic_segments, op5_budget_mix, op6_line_crf,
    op7_preference_format, op8_spaced_seeds, op9_bwt_repeats, op10_line_spread,
    op11_filter_audit, op12_style_tree, op13_source_divergence)}

# -- SQL ------------------------------------------------------------------------

_SPACE = r"[^\x20\x09-\x0D]"

_OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, strlen(body) AS n, sha1(body) AS hex, max(page_id) OVER (PARTITION BY sha1(body)) AS winner FROM p),
b AS (  -- base 32 of the 20 digest bytes, five bits at a time
  SELECT page_id, n, winner,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(hex || '00', CAST(1 + 2 * (i * 5 // 8) AS BIGINT), 4))::BIGINT
        >> CAST(11 - (i * 5 % 8) AS BIGINT)) & 31)::BIGINT), 1)), 'string_agg', '') AS digest
  FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to
FROM b"""

_OP7 = r"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
         role, text,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head,
         replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT pair_id FROM t),
both_sides AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.k, b.k) AS k,
         a.k IS NOT NULL AND b.k IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role
           AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b
    ON a.pair_id = b.pair_id AND a.k = b.k),
c AS (
  SELECT pair_id, CAST(coalesce(min(k) FILTER (NOT same) - 1, max(k)) AS INTEGER) AS n_common
  FROM both_sides GROUP BY pair_id),
r AS (
  SELECT t.*, n_common,
         coalesce(sum(length(head || body)) OVER (PARTITION BY t.pair_id, side ORDER BY k
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_all
  FROM t JOIN c USING (pair_id)),
s AS (
  SELECT pair_id, side, n_common,
         coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k <= n_common), '') AS prompt,
         coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k > n_common), '') AS rest,
         coalesce(sum(length(head || body)) FILTER (k <= n_common), 0) AS skip
  FROM r GROUP BY pair_id, side, n_common),
m AS (
  SELECT r.pair_id, r.side,
         string_agg(CAST(before_all - skip + length(head) AS BIGINT)::VARCHAR || '-'
           || CAST(before_all - skip + length(head) + length(body) AS BIGINT)::VARCHAR, ',' ORDER BY k) AS mask
  FROM r JOIN s ON r.pair_id = s.pair_id AND r.side = s.side
  WHERE r.k > r.n_common AND r.role = 'assistant' GROUP BY r.pair_id, r.side)
SELECT i.pair_id, c.n_common, coalesce(a.prompt, b.prompt, '') AS prompt,
       coalesce(a.rest, '') AS chosen, coalesce(b.rest, '') AS rejected,
       coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask,
       x.mask IS NOT NULL AND y.mask IS NOT NULL AND a.rest <> b.rest AS usable
FROM ids i JOIN c USING (pair_id)
LEFT JOIN s a ON a.pair_id = i.pair_id AND a.side = 0 LEFT JOIN s b ON b.pair_id = i.pair_id AND b.side = 1
LEFT JOIN m x ON x.pair_id = i.pair_id AND x.side = 0 LEFT JOIN m y ON y.pair_id = i.pair_id AND y.side = 1"""

#: Lines that count, with their place; shared with the pipeline's SQL.
LINE_SPREAD_SQL = """
{p}l AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS site, i, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {docs})),
{p}b AS (
  SELECT line FROM {p}l WHERE length(line) >= %d AND regexp_matches(line, '%s')
  GROUP BY line HAVING count(DISTINCT site) >= %d),
{p}c AS (
  SELECT l.doc_id, count(*) AS n_lines, count(b.line) AS n_cut,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (b.line IS NULL), '') AS short
  FROM {p}l l LEFT JOIN {p}b b ON l.line = b.line GROUP BY l.doc_id),
{p}r AS (
  SELECT d.*, c.n_lines, c.n_cut > 0 AS cut, c.n_cut, c.short
  FROM {docs} d LEFT JOIN {p}c c USING (doc_id))""" % (
    line_spread.MIN_CHARS, _SPACE, line_spread.MIN_SITES)

_OP10 = "WITH " + LINE_SPREAD_SQL.format(p="x", docs="documents") + """
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(CASE WHEN cut THEN n_cut ELSE 0 END AS BIGINT) AS n_removed,
       sha256(CASE WHEN cut THEN short ELSE text END) AS kept_sha256
FROM xr"""

_OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
          100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 10 * length(d.t),
          regexp_matches(d.t, '[#$%&*|]'), coalesce(d.doc_id > least, false)] AS fails
  FROM d JOIN first ON d.t = first.t LEFT JOIN flags ON d.doc_id = flags.doc_id),
cells AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
o AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT part, good, toxic, fails, n, ks, k AS step, ks[k] AS f,
         list_bool_or(list_transform(ks[1:k - 1], lambda x: fails[x])) AS gone
  FROM cells, o, l),
r AS (
  SELECT part, array_to_string(list_transform(ks, lambda x: chr(64 + x)), '') AS filter_order, step, f,
         sum(CASE WHEN NOT coalesce(gone, false) AND NOT fails[f] THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT coalesce(gone, false) AND fails[f] THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN coalesce(gone, false) AND fails[f] THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails[f] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN good AND NOT coalesce(gone, false) AND fails[f] THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN toxic AND NOT coalesce(gone, false) AND fails[f] THEN n ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r"""

_OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
o AS (SELECT lang, source, r, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= %d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5) // (total + 5 * v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (total + 5 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)
  JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM g GROUP BY lang) USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang AS s0, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS s FROM p x JOIN p y
               ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL)
    ON s0 = a.lang AND s1 = a.source AND s2 = b.source),
above AS (
  SELECT p.lang, source, term AS item, p - q AS value,
         row_number() OVER (PARTITION BY p.lang, source ORDER BY p - q DESC, term) AS rank
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(rank AS INTEGER) FROM above WHERE rank <= %d""" % (
    source_divergence.MIN_DOCS, source_divergence.TOP_TERMS)

ORACLE_SQL = {"op11_filter_audit": _OP11, "op13_source_divergence": _OP13, "op2_warc_salvage": _OP2, "op7_preference_format": _OP7, "op10_line_spread": _OP10}
