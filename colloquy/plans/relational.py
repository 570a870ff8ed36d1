"""Queries over labels, embeddings, events and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import embeddings, evaluation, stats
from ..streaming import monitor
from .registry import query

#: Predicted quality of the evaluation queries: a text rule that both engines compute alike.
_PREDICTED = "CASE WHEN length(regexp_replace(text, '[^A-Z]', '', 'g')) * 5 < length(text) THEN 1 ELSE 0 END"


def _judged(t):
    rule = F.when(F.length(F.regexp_replace("text", "[^A-Z]", "")) * 5 < F.length("text"), 1).otherwise(0)
    return t("documents").join(t("labels"), "doc_id").select("doc_id", "source", F.col("quality").alias("truth"), rule.alias("predicted"), F.length("text").alias("size"))


_JUDGED = f"(SELECT d.doc_id, d.source, quality AS truth, {_PREDICTED} AS predicted, length(text) AS size FROM documents d JOIN labels l USING (doc_id))"
_CLASSES = f"""c AS (SELECT label, count(*) FILTER (truth = label AND predicted = label) AS tp, count(*) FILTER (truth <> label AND predicted = label) AS fp, count(*) FILTER (truth = label AND predicted <> label) AS fn
FROM {_JUDGED}, (SELECT unnest([0, 1]) AS label) GROUP BY label)"""


@query(f"WITH {_CLASSES} SELECT CAST(label AS VARCHAR) AS label, tp, fp, fn, round(1.0 * tp / greatest(tp + fp, 1), 6) AS precision, round(1.0 * tp / greatest(tp + fn, 1), 6) AS recall, round(2.0 * tp / greatest(2 * tp + fp + fn, 1), 6) AS f1 FROM c WHERE tp + fp + fn > 0")
def per_class_f1(t):
    pairs = _judged(t).select(F.array(F.col("truth").cast("string")).alias("truth"), F.array(F.col("predicted").cast("string")).alias("predicted"))
    return evaluation.per_class(pairs)


@query(
    f"""WITH {_CLASSES}, f AS (SELECT *, round(2.0 * tp / greatest(2 * tp + fp + fn, 1), 6) AS f1 FROM c)
SELECT round(2.0 * sum(tp) / greatest(2 * sum(tp) + sum(fp) + sum(fn), 1), 6) AS micro_f1, round(avg(f1), 6) AS macro_f1, count(*) FILTER (f1 = 0) AS zero_classes, (SELECT round(avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END), 6) FROM {_JUDGED}) AS exact FROM f"""
)
def micro_macro_f1(t):
    pairs = _judged(t).select(F.array(F.col("truth").cast("string")).alias("truth"), F.array(F.col("predicted").cast("string")).alias("predicted"))
    return evaluation.summary(pairs)


@query(
    f"""SELECT threshold, count(*) FILTER (score >= threshold) AS kept, round(1.0 * count(*) FILTER (score >= threshold AND truth = 1) / greatest(count(*) FILTER (score >= threshold), 1), 6) AS precision,
round(1.0 * count(*) FILTER (score >= threshold AND truth = 1) / greatest(sum(truth), 1), 6) AS recall FROM (SELECT truth, least(CAST(size AS DOUBLE) / 5000, 1.0) AS score FROM {_JUDGED}), (SELECT unnest([0.1, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS threshold) GROUP BY threshold"""
)
def threshold_sweep(t):
    scores = _judged(t).select("truth", F.least(F.col("size").cast("double") / 5000, F.lit(1.0)).alias("score"))
    return evaluation.sweep(scores, [0.1, 0.25, 0.5, 0.75, 1.0])


@query(f"SELECT truth, predicted, count(*) AS n FROM {_JUDGED} WHERE truth <> predicted GROUP BY ALL ORDER BY n DESC, truth, predicted LIMIT 10")
def confusion_topk(t):
    return evaluation.confusion(_judged(t), 10)


@query(f"SELECT source, count(*) AS n, round(avg(CASE WHEN truth <> predicted THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM {_JUDGED} GROUP BY source HAVING count(*) >= 10")
def error_rate_by_source(t):
    wrong = (F.col("truth") != F.col("predicted")).cast("double")
    return _judged(t).groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg(wrong), 6).alias("error_rate")).where("n >= 10")


@query(f"SELECT CAST(floor(place * 10) AS INTEGER) AS tenth, count(*) AS n, round(avg(CASE WHEN truth <> predicted THEN 1.0 ELSE 0.0 END), 6) AS risk FROM (SELECT *, percent_rank() OVER (ORDER BY size, doc_id) AS place FROM {_JUDGED}) WHERE place < 1 GROUP BY 1")
def risk_coverage(t):
    return evaluation.risk_coverage(_judged(t).withColumn("wrong", (F.col("truth") != F.col("predicted")).cast("double")), ["size", "doc_id"], "wrong")


@query("SELECT labels, count(*) AS n FROM (SELECT doc_id, list_filter([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END, 'any'], lambda x: x IS NOT NULL)[1:2] AS l, array_to_string(l, ',') AS labels FROM labels) GROUP BY labels")
def label_cap2(t):
    every = F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic"), F.lit("any")))
    return t("labels").groupBy(F.array_join(evaluation.cap_labels(every), ",").alias("labels")).agg(F.count("*").alias("n"))


@query("SELECT size, count(*) AS n FROM (SELECT quality + toxic AS size FROM labels) GROUP BY size")
def label_cardinality(t):
    return t("labels").groupBy((F.col("quality") + F.col("toxic")).alias("size")).agg(F.count("*").alias("n"))


@query("SELECT valid, count(*) AS n FROM (SELECT array_to_string(list_filter([source, lang], lambda x: x IN ('en', 'fr', 'src1', 'src2')), ',') AS valid FROM documents) GROUP BY valid")
def enum_validate(t):
    valid = evaluation.valid_labels(F.array("source", "lang"), ["en", "fr", "src1", "src2"])
    return t("documents").groupBy(F.array_join(valid, ",").alias("valid")).agg(F.count("*").alias("n"))


@query("SELECT quality = toxic AS agree, count(*) AS n FROM labels GROUP BY 1")
def agreement(t):
    return t("labels").groupBy((F.col("quality") == F.col("toxic")).alias("agree")).agg(F.count("*").alias("n"))


_CENTROIDS = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT label AS class, pos, avg(x) AS m FROM e GROUP BY ALL),
s AS (SELECT vec_id, e.label AS truth, class, sum(x * m) / sqrt(sum(x * x) * sum(m * m)) AS cosine FROM e JOIN c USING (pos) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(cosine, 6) DESC, class) AS rank FROM s)"""


@query(f"WITH {_CENTROIDS} SELECT truth, class AS label, count(*) AS n FROM r WHERE rank = 1 GROUP BY ALL")
def centroid_top1(t):
    v = t("embeddings")
    return embeddings.nearest_centroids(v, embeddings.centroids(v), 1).groupBy("truth", "label").agg(F.count("*").alias("n"))


@query(f"WITH {_CENTROIDS} SELECT truth, count(*) AS n, count(*) FILTER (class = truth) AS hits FROM r WHERE rank <= 2 GROUP BY truth")
def centroid_top2(t):
    v = t("embeddings")
    found = embeddings.nearest_centroids(v, embeddings.centroids(v), 2)
    return found.groupBy("truth").agg(F.count("*").alias("n"), F.count_if(F.col("label") == F.col("truth")).alias("hits"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def domain_rollup(t):
    return t("lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("qty"))


@query("SELECT coalesce(l_linestatus, 'TOTAL') AS mode, count(*) FILTER (l_returnflag = 'A') AS \"A\", count(*) FILTER (l_returnflag = 'N') AS \"N\", count(*) FILTER (l_returnflag = 'R') AS \"R\" FROM lineitem GROUP BY ROLLUP (l_linestatus)")
def dataset_pivot(t):
    flag = F.col("l_returnflag")
    aggregates = [F.count_if(flag == x).alias(x) for x in "ANR"]
    return stats.with_total(t("lineitem"), "l_linestatus", aggregates).withColumnRenamed("l_linestatus", "mode")


@query("SELECT coalesce(c_custkey, o_custkey) AS custkey, count(o_orderkey) AS n_orders, CASE WHEN c_custkey IS NULL THEN 'orders_only' WHEN count(o_orderkey) = 0 THEN 'customer_only' ELSE 'both' END AS side FROM customer FULL JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, o_custkey")
def files_meta_full_outer(t):
    counts = t("orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    both = t("customer").join(counts, F.expr("c_custkey = o_custkey"), "full")
    side = F.when(F.col("c_custkey").isNull(), "orders_only").when(F.coalesce("n", F.lit(0)) == 0, "customer_only").otherwise("both")
    return both.select(F.coalesce("c_custkey", "o_custkey").alias("custkey"), F.coalesce("n", F.lit(0)).alias("n_orders"), side.alias("side"))


@query("SELECT event_type, count(*) AS n, target, round(100.0 * count(*) / target, 2) AS pct FROM events, (SELECT 3000 AS target) GROUP BY event_type, target")
def source_progress_vs_target(t):
    counts = monitor.counts_by(t("events"), "event_type")
    return monitor.progress(counts, counts.select("event_type", F.lit(3000).alias("target")), "event_type")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(t):
    return monitor.tumbling(t("events"), "ts", "1 hour", ["event_type"]).drop("total")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, s"""
)
def session_windows(t):
    return monitor.sessions(t("events"), "ts", "30 minutes", "user_id")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def grouped_means(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.round(F.avg("value"), 4).alias("mean"))


@query("SELECT doc_id, concat_ws(';', CASE WHEN quality = 0 THEN 'low' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS reason, NOT (quality = 0 OR toxic = 1) AS ok FROM labels")
def flag_sets(t):
    from ..operators.joins import flagged

    labels = t("labels").select("doc_id", "quality", "toxic")
    return flagged(labels.select("doc_id"), "doc_id", {"low": labels.where("quality = 0"), "toxic": labels.where("toxic = 1")}).select("doc_id", "reason", "ok")


@query("SELECT coalesce(CAST(quality AS VARCHAR), 'Untraced') AS quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def lookup_with_default(t):
    from ..operators.joins import lookup

    labels = t("labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return lookup(t("documents").select("doc_id"), labels, "doc_id", "quality", "Untraced").groupBy("quality").agg(F.count("*").alias("n"))


@query("SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS label FROM embeddings UNION ALL SELECT 1000000, 5")
def upserted(t):
    from ..operators.joins import upsert

    base = t("embeddings").select("vec_id", "label")
    changes = base.where("vec_id % 7 = 0").withColumn("label", F.lit(-1)).unionByName(base.sparkSession.createDataFrame([(1_000_000, 5)], "vec_id long, label int"))
    return upsert(base, changes, "vec_id")


@query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN a.doc_id IS NULL THEN 'no_left' WHEN b.doc_id IS NULL THEN 'no_right' WHEN a.v = b.v THEN 'equal' ELSE 'different' END AS state FROM (SELECT doc_id, n_chars AS v FROM documents WHERE lang IS NOT NULL) a FULL JOIN (SELECT doc_id, 1000 * (quality + toxic) AS v FROM labels) b ON a.doc_id = b.doc_id) GROUP BY state")
def state_check(t):
    from ..operators.joins import reconciled

    left = t("documents").where("lang is not null").select("doc_id", F.col("n_chars").alias("v"))
    right = t("labels").select("doc_id", (1000 * (F.col("quality") + F.col("toxic"))).alias("v"))
    return reconciled(left, right, "doc_id", "v").groupBy("state").agg(F.count("*").alias("n"))


@query("SELECT lang, count(*) FILTER (length(text) > 0) AS before, count(*) FILTER (length(text) > 1000) AS given, count(*) FILTER (length(text) > 5000) AS after FROM documents GROUP BY lang")
def aligned_counts(t):
    from ..operators.joins import aligned

    docs = t("documents").withColumn("n", F.length("text"))
    count = lambda least: docs.where(F.col("n") > least).groupBy("lang").agg(F.count("*").alias("v"))
    return aligned({"before": count(0), "given": count(1000), "after": count(5000)}, ["lang"], "v")


@query("SELECT CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'web' WHEN source IN ('src4', 'src5') THEN 'books' ELSE source END AS source, count(*) AS n FROM documents GROUP BY 1")
def mapping_chain(t):
    from ..operators.joins import relabelled

    counts = t("documents").groupBy("source").agg(F.count("*").alias("n"))
    spark = counts.sparkSession
    first = spark.createDataFrame([("src1", "www"), ("src2", "www"), ("src3", "web"), ("src4", "books"), ("src5", "books")], "source string, target string")
    second = spark.createDataFrame([("www", "web")], "source string, target string")
    return relabelled(relabelled(counts, first, "source", "n"), second, "source", "n")


@query("SELECT CASE WHEN source IN ('src1', 'src2') THEN 'web' WHEN source = 'src7' THEN 'code' ELSE '__GAP__' END AS category, count(DISTINCT source) AS n_values, sum(n_chars) AS volume FROM documents GROUP BY 1")
def taxonomy_coverage(t):
    from ..operators.taxonomy import coverage

    docs = t("documents").select("source", "n_chars")
    mapping = docs.sparkSession.createDataFrame([("src1", "web"), ("src2", "web"), ("src7", "code")], "source string, category string")
    return coverage(docs, "source", mapping, "category", "n_chars")


@query(
    r"""SELECT lang, count(*) AS n_rows, count(*) FILTER (length(text) < 20) AS tiny, count(*) FILTER (length(text) > 0 AND CAST(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) < 0.3) AS low_alnum,
count(*) FILTER (regexp_matches(text, '[!-/:-@\[-`{-~]{40,}')) AS punctuation_run FROM documents GROUP BY lang"""
)
def quality_scan(t):
    from ..operators.scans import counted, text_flags

    flags = text_flags(F.col("text"))
    return counted(t("documents"), {n: flags[n] for n in ("tiny", "low_alnum", "punctuation_run")}, ["lang"])


@query(
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM w WHERE len(w) >= 60),
m AS (SELECT doc_id, max(c) AS score FROM (SELECT doc_id, g, count(*) AS c FROM g GROUP BY ALL) GROUP BY doc_id) SELECT doc_id, score FROM m WHERE score >= 6"""
)
def loop_scores(t):
    from ..operators.scans import loop_score

    return t("documents").select("doc_id", loop_score(F.col("text")).cast("long").alias("score")).where("score >= 6")


@query()
def context_probes(t):
    """How many chats each context probe flags."""
    from ..functions import messages as M
    from ..operators.scans import chat_flags, counted

    return counted(M.from_turns(t("conversations")), chat_flags(F.col("messages")))


@query()
def needle_search(t):
    """The first rows of each string column of documents that hold a needle."""
    from ..operators.scans import needles

    return needles(t("documents"), "src7")


@query(
    """WITH s AS (SELECT vec_id, label, embedding FROM embeddings), p AS (SELECT a.vec_id, a.label = b.label AS same, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM s a JOIN s b ON b.vec_id = a.vec_id + 1)
SELECT same, count(*) AS n, round(avg(cosine), 4) AS mean FROM p GROUP BY same"""
)
def pair_relatedness(t):
    v = t("embeddings").select("vec_id", "label", "embedding")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("label").alias("other"), F.col("embedding").alias("e2"))
    pairs = v.join(after, "vec_id").select((F.col("label") == F.col("other")).alias("same"), F.round(embeddings.cosine(F.col("embedding"), F.col("e2")), 6).alias("cosine"))
    return pairs.groupBy("same").agg(F.count("*").alias("n"), F.round(F.avg("cosine"), 4).alias("mean"))
