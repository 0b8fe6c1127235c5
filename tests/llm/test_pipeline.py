"""The pipeline's stages: what goes, what stays, and odd rows."""

import brute
import corpus_pipeline as P
from conftest import SF001
from fleetpulse.llm.common import Scratch, table


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = table(spark, SF001, "documents")
    scratch, kept = Scratch(spark, "test-pipeline"), {}
    frame, names = docs, list(docs.columns)
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in frame.collect()}
        frame = scratch.write(stage(spark, frame, SF001), name)
        kept[name] = {r.doc_id: r for r in frame.collect()}
        assert set(kept[name]) <= set(before)
        if name != P.STAGES[-1][0]:
            assert frame.columns == names
        if name == "toxicity":
            toxic = {r.doc_id for r in table(spark, SF001, "labels").where("toxic = 1").collect()}
            clean = {r.doc_id for r in table(spark, SF001, "labels").where("toxic = 0").collect()}
            gone = set(before) - set(kept[name])
            assert len(gone & toxic) >= 0.6 * len(toxic & set(before)) and len(gone & clean) <= 0.05 * len(clean)
        if name == "line_dedup":
            assert set(before) == set(kept[name])
            assert all(r.text == before[i].text or len(r.text) < len(before[i].text) for i, r in kept[name].items())
        if name == "ngram_jaccard_join":
            classes = brute.near_duplicates([(i, r.text) for i, r in before.items()])
            assert set(kept[name]) == {i for i, (c, _) in classes.items() if i == c}
        if name == "benchmark_decontamination":
            items = [r.text for r in table(spark, SF001, "benchmark").collect()]
            assert not any(x in r.text for r in kept[name].values() for x in items)
    assert all(r.taken == r.copies * r.size and 1 <= r.copies <= 2 for r in kept["source_mixing"].values())
    run = {(r.doc_id, r.taken) for r in P.run(spark, SF001).collect()}
    assert run == {(i, r.taken) for i, r in kept["source_mixing"].items()}


def test_odd_rows_and_empty_documents(spark):
    docs = table(spark, SF001, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (2, "a b", None, "s", 3), (2, "a b", None, "s", 3),
         (3, "a b", "en", "t", 3)], docs.schema).selectExpr("*", "1 AS score", "'x' AS size", "2 AS class_id",
                                        "3 AS `a.b`", "'m' AS __mark", "'k' AS __k1")
    for rows, n in ((odd, 4), (odd.limit(0), 0)):
        frame = rows
        for _, stage in P.STAGES[:-1]:
            frame = stage(spark, frame, SF001)
            assert frame.columns == rows.columns
        assert frame.count() == n   # the copy with doc_id 3 goes
        assert P.mix_sources(spark, frame, SF001).count() <= n


def test_a_different_text_under_a_repeated_id_stays(spark):
    docs = table(spark, SF001, "documents")
    one, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = spark.createDataFrame([(4, one, "en", "s", 1), (5, one, "en", "s", 1), (5, other, "en", "s", 1),
                                  (None, one, "en", "s", 1)], docs.schema)
    left = P.drop_near_duplicates(spark, rows, SF001).collect()
    assert {(r.doc_id, r.text) for r in left} == {(4, one), (5, other), (None, one)}
