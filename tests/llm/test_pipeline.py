"""The pipeline's stages on planted cases."""

import random

import corpus_pipeline
from tests.llm.test_operators import DOCS, make_docs, sentence


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    clean = [sentence(rng, 150) for _ in range(40)]
    item = sentence(rng, 40)
    passage = sentence(rng, 60)
    texts = clean + [clean[0] + " " + rng.choice(["ba", "zu"])] + [clean[1]] * 3 + [sentence(rng, 60) + " " + item, sentence(rng, 90) + " " + passage, passage + " " + sentence(rng, 90)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (None, "no id here", "en", "s", 10), (None, item, "en", "s", 10), (2, sentence(rng, 120), "en", "s", 3)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == corpus_pipeline.COLUMNS
    ids = lambda name: {r.doc_id for r in seen[name]}
    assert ids("quality_filter") == {r[0] for r in rows}
    near = ids("near_duplicates")
    assert {0, 40} & near == {40} and len({1, 41, 42, 43} & near) == 1 and set(range(2, 40)) < near
    kept = {r.doc_id: r.text for r in seen["repeated_passages"]}
    assert passage not in kept[45] and passage not in kept[46] and kept[5] == texts[5]
    assert 44 not in ids("decontamination") and set(range(2, 40)) < ids("decontamination")
    # rows that share a doc_id but not a text both stay; a contaminated row without doc_id goes
    assert sum(r.doc_id == 2 for r in seen["near_duplicates"]) == 2 and sum(r.doc_id == 2 for r in seen["byte_bpe"]) == 2
    assert item in {r.text for r in seen["repeated_passages"]} and item not in {r.text for r in seen["decontamination"]}
    assert all(r.n_tokens > 0 for r in seen["byte_bpe"] if r.doc_id in range(2, 40))


def test_runs_on_edge_cases(spark, tmp_path):
    spark.createDataFrame(make_docs(), DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0  # without labels no score reaches the threshold
