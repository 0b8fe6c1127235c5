"""Mixing sources to target weights by subset-sum budget fitting (operator 5).

Sources get word targets from weights.  A target holds some whole epochs of
its source, and a remaining budget smaller than the source.  For that budget
the documents of a source are counted by exact length; a share of every
length is taken outright and a seeded pass adds one more of each, again and
again over the documents that still fit, until the rest is at most ``WINDOW``
words; a bounded-knapsack dynamic program over the remaining counts then finds
the selection whose sum is the rest, or the nearest below.  Where more than
``WINDOW`` words are missing and only longer documents remain, one of them
replaces shorter ones.
The documents of each length are then chosen by a seeded hash of their whole
row, so the order of the rows, a repeated or a missing id and a repeated task
change nothing.

Nothing is gathered per document: the program sees one row per length, and
the choice among n equal lengths is made over ``CELLS`` hash cells with a
window of at most that many rows; only the cell on the boundary is ranked.

Defined cases: null text has size 0; documents of size 0 are taken 0 words;
a null source is a source of its own, last in order; a source without words
has target 0; rows that repeat an id are rows of their own, and only wholly
equal rows are exchangeable; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Scratch, quoted

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 41
CELLS = 4096
WINDOW = 65_536


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def subset(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """Bounded knapsack: how many of each size, the sum being the largest reachable
    one that is at most ``budget``.  Reachable sums are the bits of an integer."""
    whole = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i, (s, c) in enumerate(zip(sizes, counts, strict=True)):
        if reach >> budget & 1:
            break
        c, k = min(c, budget // s) if s else 0, 1
        while c > 0:  # counts in powers of two
            k = min(k, c)
            steps.append((i, k, k * s, reach))
            reach |= (reach << (k * s)) & whole
            c, k = c - k, 2 * k
    at, take = reach.bit_length() - 1, [0] * len(sizes)
    for i, k, total, before in reversed(steps):
        if not before >> at & 1:
            take[i] += k
            at -= total
    return take


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """Documents to take of each size (> 0) so that their words are near ``budget``."""
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.copy()
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((sizes * take).sum())
    order = np.random.default_rng(seed).permutation(len(sizes))
    while left > WINDOW:
        before = left
        for i in order.tolist():  # one more of each length, in seeded order, while it fits
            if left <= WINDOW:
                break
            if take[i] < counts[i] and sizes[i] <= left:
                take[i] += 1
                left -= int(sizes[i])
        if left == before:
            break
        # Lengths that did not fit are out: a share again of those that do.
        free = np.where(sizes <= left, counts - take, 0)
        total = max(left, int((sizes * free).sum()))
        if total:
            more = np.array([int(c) * left // total for c in free.tolist()], np.int64)
            take += more
            left -= int((sizes * more).sum())
    rest = [i for i in order.tolist() if take[i] < counts[i] and sizes[i] <= left]
    more = subset([int(sizes[i]) for i in rest], [int(counts[i] - take[i]) for i in rest], min(left, WINDOW))
    take[rest] += np.array(more, np.int64)
    left = budget - int((sizes * take).sum())
    longer = sizes[(take < counts) & (sizes > left)]
    if left > WINDOW and len(longer):  # one longer document for shorter ones given back
        size = longer.min()
        short = sizes < size
        held = int((sizes * take)[short].sum())
        if held >= size - left:
            swap = take + (sizes == size)
            swap[short] = fit_budget(sizes[short], take[short], held - int(size - left), seed)
            if (sizes * swap).sum() > (sizes * take).sum():
                take = swap
    return take


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS, scratch: Scratch | None = None) -> DataFrame:
    """src, no_src, source_size, target from one row per source.

    The weight depends on a source's place in order; a range-partitioned sort
    and the partitions' row counts give it without one task seeing all
    sources.  A target is ``min(level * weight, max_epochs * size)``; each
    round over the sources raises the level until no more excess is left.
    """
    scratch = scratch or Scratch(sources.sparkSession, "targets")
    placed = scratch.write(
        sources.orderBy("no_src", "src").withColumn("at", F.monotonically_increasing_id()), "sources")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for p in sorted(sizes):
        starts[p], total = total, total + sizes[p]
    rank = place + (F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv])[part]
                    if starts else F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    rows = placed.select("src", "no_src", "source_size", weight.alias("w"))
    cap = F.col("source_size") * F.lit(max_epochs)
    budget = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        above = F.col("w") * F.lit(level) > cap if level >= 0 else F.lit(False)
        r = rows.agg(F.sum(F.when(above, cap).otherwise(0.0)).alias("capped"),
                     F.sum(F.when(above, 0.0).otherwise(F.col("w"))).alias("w")).first()
        raised = (budget - r["capped"]) / r["w"] if r["w"] else level
        if raised <= level:
            break
        level = raised
    return rows.select("src", "no_src", "source_size",
                       F.least(F.col("w") * F.lit(max(level, 0.0)), cap).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED, size: Column | None = None) -> DataFrame:
    """``df`` plus size, source_size, target and taken (words, repeats counted);
    ``taken / size`` is how often a document enters the mix."""
    scratch = Scratch(df.sparkSession, "mix")
    fresh = ("size", "source_size", "target", "taken")
    names = [c for c in df.columns if c not in fresh]
    # All columns that can be hashed, and which of them are null: xxhash64 passes over nulls.
    plain = [quoted(f.name) for f in df.schema.fields if f.name in names and "map<" not in f.dataType.simpleString()]
    whole = [*plain, *[c.isNull() for c in plain]]
    rows = df.select(
        *[quoted(c).alias(f"c{i}") for i, c in enumerate(names)],
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("no_src"), (words(F.col(text_col)) if size is None else size).alias("size"),
        F.xxhash64(F.lit(seed), *whole).alias("u"), F.xxhash64(F.lit(~seed), *whole).alias("u2"))
    rows = rows.withColumn("cell", F.shiftrightunsigned("u", 64 - CELLS.bit_length() + 1).cast("int"))
    key = ["no_src", "src", "size"]
    cells = scratch.write(rows.groupBy(*key, "cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    lengths = cells.groupBy(*key).agg(F.sum("n").alias("n"))
    sources = lengths.groupBy("no_src", "src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goal = scratch.write(targets(sources, weights, share, max_epochs, scratch), "goal")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        """Documents to take beyond whole epochs, per length of one source."""
        target, total = float(pdf["target"].iloc[0]), int(pdf["source_size"].iloc[0])
        epochs = min(int(target // total), int(max_epochs)) if total else 0
        pdf = pdf.sort_values("size")
        sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        live = sizes > 0
        take = np.zeros(len(sizes), np.int64)
        take[live] = fit_budget(sizes[live], counts[live], round(target - epochs * total), seed)
        return pdf.assign(epochs=epochs, k=take)[["no_src", "src", "size", "source_size", "target", "epochs", "k"]]

    picks = (lengths.join(goal, ["no_src", "src"]).groupBy("no_src", "src").applyInPandas(
        choose, "no_src boolean, src string, size long, source_size long, target double, epochs int, k long"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("cell")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = scratch.write(
        cells.join(picks, key).withColumn("quota", F.least(F.greatest(F.col("k") - before, F.lit(0)), F.col("n")))
        .select(*key, "cell", "n", "quota", "epochs", "source_size", "target"), "quota")
    joined = rows.join(quota, [*key, "cell"])
    rank = F.row_number().over(Window.partitionBy(*key, "cell").orderBy("u", "u2"))
    copies = F.col("epochs") + F.when(F.col("quota") >= F.col("n"), 1).when(F.col("quota") == 0, 0) \
        .otherwise((F.col("rank") <= F.col("quota")).cast("int"))
    return joined.withColumn("rank", rank).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "size", "source_size", "target",
        (copies * F.col("size")).cast("long").alias("taken"))
