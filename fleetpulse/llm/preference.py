"""Preference formatting (operator 7).

Two conversations, chosen and rejected, become one training pair.  Their
longest common prefix of turns (same role and text) is rendered once, as the
prompt; what follows in each is its completion, with a loss mask: the
half-open character ranges of the completion that are trained on, which are
the texts and closing markers of assistant turns.

One shuffle (turns to their pair) and built-in expressions only.  A
conversation is one training example and is held by one task; pairs are
not grouped any further, so a first turn or a whole conversation that a
third of all rows share makes no large group.

Defined cases: a null text is empty, a null role renders as ``unknown``; the
template's opening marker inside a text is broken up, so a text cannot open
a turn; turns with equal numbers are ordered by role, then text (nulls
first), and repeated rows stay; a pair with one side has no common turn and
``usable`` is false; so is it when a completion has nothing to train on, or
the two are equal; rows with a null conversation id belong to no pair and
are left out; a very long conversation costs in proportion to its length (one
task holds it); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "<|end|>\n"


def render(turn: Column) -> Column:
    """``<|role|>`` line, the text, closing marker."""
    return F.concat(_header(turn), _body(turn))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit(OPEN), F.lit("< |")), F.lit(CLOSE))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    equal = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])
                       & x.isNotNull() & y.isNotNull())
    first = F.array_position(equal, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(equal)).cast("int")


def completion(turns: Column) -> Column:
    """struct(text, spans): the rendered turns and the trained character ranges."""
    # The fold sees lengths only; the text is joined once.
    sizes = F.transform(turns, lambda t: F.struct(F.length(_header(t)).alias("head"), F.length(_body(t)).alias("body"),
                                                  (t["role"] == "assistant").alias("trained")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,end:int>>").alias("spans"))

    def step(acc, size):
        first = acc["at"] + size["head"]
        span = F.struct(first.alias("first"), (first + size["body"]).alias("end"))
        return F.struct(
            (first + size["body"]).alias("at"),
            F.when(size["trained"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.struct(F.array_join(F.transform(turns, render), "").alias("text"),
                    F.aggregate(sizes, start, step, lambda acc: acc["spans"]).alias("spans"))


def format_pairs(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", pair: Column | None = None, side: Column | None = None) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected (texts), chosen_mask, rejected_mask
    (arrays of ranges), usable.

    ``pair`` and ``side`` (true: chosen) say which pair a conversation belongs to;
    by default conversations 2k (chosen) and 2k + 1 (rejected) make pair k.
    """
    conv = F.col(conv_col).cast("long")
    pair = F.floor(conv / 2).cast("long") if pair is None else pair
    side = F.pmod(conv, F.lit(2)) == 0 if side is None else side
    row = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    sides = (turns.select(pair.alias("pair_id"), side.alias("chosen"), row.alias("row"))
             .where("pair_id IS NOT NULL")
             .groupBy("pair_id")
             .agg(F.array_sort(F.collect_list(F.when(F.col("chosen"), F.col("row")))).alias("a"),
                  F.array_sort(F.collect_list(F.when(~F.col("chosen"), F.col("row")))).alias("b")))
    cut = sides.withColumn("n_common", common_turns(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(F.col(c), F.col("n_common") + 1, F.size(c))
    done = cut.select(
        "pair_id", "n_common",
        F.array_join(F.transform(F.slice("a", F.lit(1), F.col("n_common")), render), "").alias("prompt"),
        completion(rest("a")).alias("c"), completion(rest("b")).alias("r"))
    return done.select(
        "pair_id", "n_common", "prompt", F.col("c.text").alias("chosen"), F.col("r.text").alias("rejected"),
        F.col("c.spans").alias("chosen_mask"), F.col("r.spans").alias("rejected_mask"),
        ((F.size("c.spans") > 0) & (F.size("r.spans") > 0) & (F.col("c.text") != F.col("r.text"))).alias("usable"))
