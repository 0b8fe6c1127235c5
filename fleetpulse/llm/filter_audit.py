"""Filter interaction audit by higher-order SQL folds (operator 11).

Five filters judge every whole text; a document's failures are a five-bit
mask.  Documents are counted into cells (part, mask, good, toxic), at most
128 per part, and only the cells meet the 120 filter orders: each cell folds
over the constant array of orders with ``transform`` and, along one order,
``aggregate``, which gives 600 structs (order x step) weighted by the cell's
count.  The structs of a part are merged by summing equal positions.

The filters (failure conditions, words are runs of characters other than
ASCII white space): A fewer than 100 words; B distinct words below 80 % of
the words; C more than 10 % of the code points in ``[A-Z]``; D any of
``#$%&*|``; E the text is that of a smaller doc_id anywhere in the table.

Scale: one scan makes narrow rows (id, part, mask, digest); E joins them to
the digests that stand under two ids or more, one row each, so a hot text
splits by rows; the rest is two partial aggregations.

Defined cases: a null text is empty (A fails, B and C do not: 0 < 0); a null
lang is the empty string; a row without doc_id never fails E, makes no other
row fail it and has no label; rows under one repeated doc_id are counted one
by one; repeated label rows count as 1 where any of them says 1; other
columns are not read; an empty table has no part and no row.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part, mask of A to D, digest of the text; one row per input row."""
    base = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    words = F.regexp_extract_all("t", F.lit(f"({WORD_PATTERN})"), F.lit(1))
    capitals = F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    seen = base.select("id", "part", F.unhex(F.md5("t")).alias("digest"),
                       F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("u"),
                       (100 * capitals.cast("long") > 10 * F.length("t").cast("long")).alias("c"),
                       F.col("t").rlike(r"[#$%&*|]").alias("d"))
    bit = lambda cond, k: F.when(cond, F.lit(1 << k)).otherwise(F.lit(0))
    mask = (bit(F.col("n") < 100, 0) + bit(100 * F.col("u").cast("long") < 80 * F.col("n").cast("long"), 1)
            + bit(F.col("c"), 2) + bit(F.col("d"), 3))
    return seen.select("id", "part", "digest", mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all five filters), good, toxic, n: the documents of each combination."""
    rows = failures(docs)
    shared = (docs.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), F.col("doc_id").alias("id"))
              .groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
              .where("least < most").select("digest", "least"))
    flags = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
             .where("good OR toxic"))
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    joined = rows.join(shared, "digest", "left").join(flags, "id", "left")
    return joined.groupBy("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"),
                          F.coalesce("good", F.lit(False)).alias("good"),
                          F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.count(F.lit(1)).alias("n"))


def fold_sql() -> str:
    """A cell's 600 structs, order by order and step by step, as one SQL expression."""
    orders = "array(" + ", ".join("array(" + ", ".join(str(1 << FILTERS.index(f)) for f in o) + ")"
                                  for o in ORDERS) + ")"
    weigh = lambda cond: f"if({cond}, n, 0L)"
    fails, first = "(mask & bit) <> 0", "(mask & bit) <> 0 AND NOT acc.gone"
    step = ("named_struct("
            f"'kept', {weigh('NOT acc.gone AND (mask & bit) = 0')}, 'removed', {weigh(first)}, "
            f"'redundant', {weigh(fails + ' AND acc.gone')}, 'unique_fails', {weigh('mask = bit')}, "
            f"'good_lost', {weigh('good AND ' + first)}, 'toxic_lost', {weigh('toxic AND ' + first)})")
    empty = "array()"
    typed = ("CAST(" + empty + " AS array<struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">>)")
    return (f"flatten(transform({orders}, o -> aggregate(o, named_struct('gone', false, 'steps', {typed}), "
            f"(acc, bit) -> named_struct('gone', acc.gone OR {fails}, 'steps', concat(acc.steps, array({step}))), "
            f"acc -> acc.steps)))")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the module text; 600 rows per part.

    ``shapley`` is the step's filter's ``removed`` over all orders.
    """
    folded = cells(docs, labels).select("part", F.posexplode(F.expr(fold_sql())).alias("at", "s"))
    merged = folded.groupBy("part", "at").agg(*[F.sum(f"s.{m}").alias(m) for m in MEASURES])
    names = F.array(*map(F.lit, ORDERS))
    placed = merged.select("part", F.element_at(names, (F.expr("at div 5") + 1).cast("int")).alias("filter_order"),
                           F.expr("CAST(at % 5 + 1 AS INT)").alias("step"), *MEASURES)
    placed = placed.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    total = placed.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return placed.join(total, ["part", "filter"]).select("part", "filter_order", "step", *MEASURES, "shapley")
