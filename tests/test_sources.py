"""Sources, sinks and streams."""

from pyspark.sql import functions as F

from colloquy.sources import io
from colloquy.streaming import monitor


def test_kept_and_rejected(spark, tmp_path):
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "id long, t string")
    why = F.when(F.col("t") == "bad", F.array(F.lit("is_bad"))).otherwise(F.array().cast("array<string>"))
    io.write_kept_and_rejected(df, why, str(tmp_path / "kept"), str(tmp_path / "out"))
    kept = io.read_json_lines(spark, str(tmp_path / "kept"), "id long, t string", "*.json*")
    assert [(r.id, r.t) for r in kept.collect()] == [(1, "good")]
    assert spark.read.json(str(tmp_path / "out")).first().reasons == ["is_bad"]


def test_bad_lines(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.jsonl").write_text('{"id": 1}\nnot json\n')
    rows = io.read_json_lines(spark, str(tmp_path), "id long").collect()
    assert {(r.id, r["_bad"]) for r in rows} == {(1, None), (None, "not json")}
    assert io.read_lines(spark, str(tmp_path)).count() == 2


def test_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(1, "en"), (2, "de"), (3, "en")], "id long, lang string")
    io.write_partitioned(df, "lang", str(tmp_path / "p"))
    assert sorted((r.id, r.lang) for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [(1, "en"), (2, "de"), (3, "en")]
    assert io.stringify_nested(df.select(F.array("id").alias("a"))).dtypes == [("a", "string")]
    assert "| id | lang |" in io.markdown(df)


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, source string")
    df.write.parquet(str(tmp_path / "in"))
    stream = monitor.read_stream(spark, str(tmp_path / "in"), df.schema)
    q = monitor.resume(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    q = monitor.resume(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    counts = monitor.counts_by(df, "source")
    targets = spark.createDataFrame([("a", 4), ("c", 1)], "source string, target long")
    assert sorted((r.source, r.n, r.pct) for r in monitor.progress(counts, targets, "source").collect()) == [("a", 2, 50.0), ("b", 1, 100.0), ("c", 0, 0.0)]
