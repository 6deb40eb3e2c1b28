import os
from collections import Counter

import corpus_pipeline
from tempolith.llm import decontaminate, language
from tests.llm.helpers import awkward, frame, words
from tests.llm.test_minhash import brute as near_brute


def build(spark, folder, rows, tests, clash=False):
    frame(spark, rows, clash).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(tests, "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    return folder


def test_each_stage_on_awkward_rows(spark, tmp_path):
    import random
    item = " ".join(words(random.Random(8), 30))
    rows = awkward() + [(900, "before it " + item + " after it", "en", "a", 0)]
    folder = build(spark, str(tmp_path), rows, [(1, item), (2, None)], clash=True)
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)

    books = language.learn(docs.filter(~language.F.coalesce(language.held_out(), language.F.lit(False))).select("doc_id", "text", "lang"))
    judge = language.Judge(books)
    out = steps["language"](spark, docs, folder)
    want = Counter(r[0] for r in rows if not judge.of(r[1])[2])
    assert out.columns == columns and Counter(r.doc_id for r in out.collect()) == want

    out = steps["near_duplicates"](spark, docs, folder)
    assert out.columns == columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({c for _, _, c, _ in near_brute(rows)})

    out = steps["decontamination"](spark, docs, folder)
    assert out.columns == columns and Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in rows if r[0] != 900)

    out = steps["mixing"](spark, docs, folder)
    assert out.columns == columns and max(Counter((r.doc_id, r.text) for r in out.collect()).values()) <= 4

    out = steps["sharding"](spark, docs, folder)
    assert set(out.columns) == set(columns) | {"slot"} and out.count() == len(rows)


def test_pipeline_runs_through_and_on_nothing(spark, tmp_path):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    tests = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert out.count() > 0 and set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    assert decontaminate.contaminated(out, tests).count() == 0
    folder = build(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
