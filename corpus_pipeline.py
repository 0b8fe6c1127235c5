"""The corpus pipeline: five stages over ``documents``, each judged on what the one before kept.

1. toxicity          toxic documents go
2. line dedup        cross-site boilerplate lines are cut out of the texts
3. n-gram Jaccard    one document of each near-duplicate class stays
4. decontamination   documents that overlap a benchmark item go
5. source mixing     the rest is mixed to source targets

Every stage but the last returns the columns of ``documents``; the last one
returns the documents the mix takes, with size, source_size, target, taken
and copies.  Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import budget_mix, line_spread, lsh_forest, spaced_seeds, toxic_segments
from fleetpulse.llm.common import Scratch, quoted, table

#: A text with more than this share of its characters in lines of other sites is a copy.
COPY_SHARE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic.  A kept row is its input row; no join."""
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels"))
    wide = toxic_segments.score(docs.select(F.struct("*").alias("row"), "text"), model)
    return wide.where("predicted = 0").select("row.*")


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their boilerplate lines; n_chars follows the text.

    A text that is mostly lines of other sites is a copy, exact or near, and the next
    stage keeps one of its group: cut here, none would be left.
    """
    table(spark, sf_dir, "documents")
    out = line_spread.clean(docs, max_share=COPY_SHARE)
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", chars).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class.

    Rows without an id stay; equal rows are one document and stay or go
    together; of different texts under one doc_id each is judged on its own.
    """
    table(spark, sf_dir, "documents")
    classes = lsh_forest.keyed(docs.select("doc_id", "text"))
    gone = classes.where("doc_id <> class_id").select(
        F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"])
    return docs.join(gone, same, "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    wide = spaced_seeds.mark(docs.select(F.struct("*").alias("row"), "text"), table(spark, sf_dir, "benchmark"))
    return wide.where("NOT contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with how often."""
    table(spark, sf_dir, "documents")
    mixed = budget_mix.mix(docs).where("taken > 0")
    return mixed.withColumn("copies", F.expr("taken div size"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", cut_boilerplate), ("ngram_jaccard_join", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("source_mixing", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs


#: Trained scores and similarity joins have no SQL form; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None
