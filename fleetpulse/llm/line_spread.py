"""Line dedup by distinct-site spread (operator 10).

Per line hash, a HyperLogLog sketch of the sites that show the line is built
map-side and merged by the aggregation, so a line that stands in a third of
all documents costs one small sketch per task.  A sketch decides alone where
it is clear: estimates up to ``min_sites / BAND`` are not boilerplate, those from
``min_sites * BAND`` on are.  Lines between get an exact distinct count.

Lines are what ``\\n`` separates.  A line counts when it has at least
``min_chars`` characters and one that is not ASCII white space; its identity
is a 128-bit hash of its bytes.  A boilerplate line is removed wherever it
stands; a document of nothing else becomes empty.

Defined cases: null text has 0 lines and stays null; empty text is one empty
line, never removed; a null site is a site of its own; rows that repeat a
doc_id are handled row by row; a null doc_id is kept.  Only the named
columns are read; other columns of the input pass through ``clean``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG, Scratch, field, map_arrow, quoted

MIN_SITES = 10
MIN_CHARS = 5
BAND = 2.0
SKETCH_LG_K = 10


def _lines(df: DataFrame, text_col: str, site_col: str, min_chars: int) -> DataFrame:
    """site, h1, h2 of every line that counts."""
    line = F.explode(F.split(F.col(text_col), "\n", -1))
    return (df.select(F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("n"))
                      .alias("site"), line.alias("line"))
            .where(_counts("line", min_chars))
            .select("site", *_hashes("line")))


def _counts(line: str, min_chars: int):
    return (F.length(line) >= min_chars) & F.col(line).rlike(r"[^\x20\x09-\x0D]")


def _hashes(line: str) -> list:
    return [F.xxhash64(F.col(line)).alias("h1"), F.xxhash64(F.lit("2"), F.col(line)).alias("h2")]


def boilerplate_lines(df: DataFrame, text_col: str = "text", site_col: str = "source",
                      min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2 of the lines that at least ``min_sites`` distinct sites show."""
    lines = _lines(df, text_col, site_col, min_chars)
    spread = (lines.groupBy("h1", "h2")
              .agg(F.hll_sketch_agg("site", F.lit(SKETCH_LG_K)).alias("sketch"))
              .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("about")))
    clear = spread.where(F.col("about") >= min_sites * BAND).select("h1", "h2")
    near = spread.where((F.col("about") > min_sites / BAND) & (F.col("about") < min_sites * BAND))
    # The exact count is distinct (line, site) pairs first: partial aggregation
    # leaves a few rows per task for a hot line, not one per document.
    exact = (lines.groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
             .where(F.col("sites") >= min_sites).select("h1", "h2"))
    return clear.unionByName(exact)


def clean(df: DataFrame, text_col: str = "text", site_col: str = "source",
          min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, max_share: float = 1.0,
          boilerplate: DataFrame | None = None) -> DataFrame:
    """``df`` with boilerplate lines cut out of the text, plus ``n_lines`` and ``n_removed``.

    Line hashes (not texts) meet the boilerplate set in a sort-merge join,
    whose hot keys AQE splits.  ``max_share`` below 1 leaves a text whole that
    would lose more than this share of its characters; a caller that removes
    near copies afterwards needs that, or a text copied to ``min_sites`` sites would vanish
    from all of them.  What to cut comes back per distinct text: a
    row is known by a hash of its whole text, and copies share one answer.
    """
    # Written tables meet the lines and the rows as plain shuffles, whose hot
    # lines and hot texts AQE can split.
    scratch = Scratch(df.sparkSession, "line-spread")
    if boilerplate is None:
        boilerplate = scratch.write(
            boilerplate_lines(df, text_col, site_col, min_sites, min_chars), "boilerplate")
    names = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    at = names.index(text_col)
    rows = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)])
    text = F.col(f"c{at}")
    rows = rows.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit("2"), text)})
    hit = (rows.select("k1", "k2", F.explode(F.split(text, "\n", -1)).alias("line"))
           .where(_counts("line", min_chars)).select("k1", "k2", *_hashes("line"))
           .join(boilerplate, ["h1", "h2"], "left_semi")
           .groupBy("k1", "k2").agg(F.collect_set("h1").alias("cut")))
    hit = scratch.write(hit, "hit")
    joined = rows.join(hit, ["k1", "k2"], "left").select(
        *rows.columns[:-2], "cut",
        F.when(F.col("cut").isNotNull(), F.transform(F.split(text, "\n", -1), lambda x: F.xxhash64(x))).alias("h"))

    def run(batches):
        for b in batches:
            cut, hashes = b.column(len(names)), b.column(len(names) + 1)
            out, total, removed = [], [], []
            for t, bad, h in zip(b.column(at).to_pylist(), cut.to_pylist(), hashes.to_pylist(),
                                 strict=True):
                n, k = (t.count("\n") + 1 if t is not None else 0), 0
                if bad:
                    bad = set(bad)
                    lines = t.split("\n")
                    keep = [x for x, y in zip(lines, h, strict=True)
                            if y not in bad or len(x) < min_chars]
                    short = "\n".join(keep)
                    if len(t) - len(short) <= max_share * len(t):
                        t, k = short, n - len(keep)
                out.append(t)
                total.append(n)
                removed.append(k)
            yield [*b.columns[:at], pa.array(out, b.schema.field(at).type),
                   *b.columns[at + 1:len(names)], pa.array(total, pa.int64()),
                   pa.array(removed, pa.int64())]

    fields = [*rows.schema.fields[:-2], field("n1", LONG), field("n2", LONG)]
    return map_arrow(joined, joined.columns, fields, run).toDF(*names, "n_lines", "n_removed")
