"""The pipeline's stages against plain versions, each on its own input."""

import corpus_pipeline
from trialbook.llm import mixing
from trialbook.session import stage

from test_small_tables import lowered, plain_components, plain_exact

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()] if name != "packing" else None
        out = stage(step(spark, docs, FOLDER), "step")
        if name != "packing":
            assert out.columns == docs.columns
            kept[name] = (before, [tuple(r) for r in out.select("doc_id", "text").collect()])
        last, docs = docs, out
    before, after = kept["exact dedup"]
    assert sorted(i for i, _ in after) == sorted(max(v) for v in plain_exact(before).values())
    before, after = kept["near dedup"]
    assert sorted(i for i, _ in after) == sorted({c for *_, c in plain_components(before)})
    before, after = kept["mixing"]
    assert set(after) == set(before)
    assert len(after) == mixing.draw(spark.createDataFrame([], "doc_id long, text string, source string"), most_repeats=2.0).count() + last.count()
    ends = docs.groupBy("sequence_id").sum("length").toDF("sequence_id", "n").collect()
    assert max(r["n"] for r in ends) <= 1024
    assert docs.filter("piece = 0").count() == last.count()
    assert all(lowered(t) for _, t in after)
