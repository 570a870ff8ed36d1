"""Label records, joins and scans on small rows."""

from pyspark.sql import functions as F

from colloquy.operators import joins, scans, taxonomy


def test_validated(spark):
    df = spark.createDataFrame([(["a", "x", "b", "c"], "hard", ["t"], "none", "single_turn")], "domain array<string>, complexity string, tool_category array<string>, tool_requirement string, mode string")
    r = taxonomy.validated(df, {"domain": (["a", "b", "c"], 2)}, {"complexity": ["easy"]}).first()
    assert r.domain == ["a", "b"] and r.complexity is None and sorted(r.dropped) == ["complexity=hard", "domain=c", "domain=x"]
    fixed = df.select(taxonomy.tool_requirement(F.col("tool_requirement"), F.col("tool_category"), F.col("mode"))).first()[0]
    assert fixed == "optional"


def test_interaction_mode(spark):
    rows = [("single_turn", "[USER]: a\n[ASSISTANT]: b\n[USER]: c"), ("multi_turn", "[USER]: a"), ("multi_turn", "[USER]: User: a\nAssistant: b\nUser: c"), ("agentic_loop", "[USER]: a")]
    df = spark.createDataFrame(rows, "mode string, text string")
    assert [r[0] for r in df.select(taxonomy.interaction_mode(F.col("mode"), F.col("text"))).collect()] == ["multi_turn", "single_turn", "multi_turn", "agentic_loop"]


def test_clustering(spark):
    df = spark.createDataFrame([("a", 1), ("A", 2), ("b", 3)], "v string, n long")
    out = joins.clustered(df, lambda d: d.select("v", F.lower("v").alias("target")), "v", "n", 2)
    assert sorted(map(tuple, out.collect())) == [("a", 3), ("b", 3)]


def test_phrases_and_unseen(spark):
    df = spark.createDataFrame([(1, "The Cat sat"), (2, None)], "id long, t string")
    phrases = spark.createDataFrame([("cat", "animal"), ("sat", "verb")], "phrase string, label string")
    assert sorted(r.label for r in joins.phrases_in(df, "t", phrases).collect()) == ["animal", "verb"]
    fresh = joins.unseen(spark.createDataFrame([(1, "k"), (2, "m"), (3, "m")], "id long, h string"), spark.createDataFrame([("k",)], "h string"), "h", "id")
    assert [r.id for r in fresh.collect()] == [2]


def test_scans(spark):
    df = spark.createDataFrame([("aaab",), ("",), ("ab " * 70,)], "t string")
    assert [r[0] for r in df.select(scans.max_char_run(F.col("t"))).collect()] == [3, 0, 1]
    assert [r[0] for r in df.select(scans.loop_score(F.col("t"))).collect()] == [0, 0, 63]
    chat = spark.createDataFrame([([("user", "Write about the following text:"), ("assistant", "Please provide the text")],)], "messages array<struct<role:string,content:string>>")
    r = scans.counted(chat, scans.chat_flags(F.col("messages"))).first()
    assert r.dangling_colon == 1 and r.answer_lacks_context == 1 and r.deictic_prompt == 1
