"""Queries over documents, pages and the benchmark."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, labelling, pii, sampling, stats
from .registry import query

_KEY = r"md5(lower(regexp_replace(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')))"
_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


@query(f"SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, {_KEY} AS k FROM documents) GROUP BY k")
def exact_dup_first_wins(t):
    return dedup.first_wins(t("documents"), dedup.text_key(F.col("text")), "doc_id").select("doc_id")


@query(f"WITH k AS (SELECT doc_id, source, {_KEY} AS k FROM documents), f AS (SELECT k, min(doc_id) AS m, arg_min(source, doc_id) AS first_place FROM k GROUP BY k) SELECT source, first_place, count(*) AS n FROM k JOIN f USING (k) WHERE doc_id <> m GROUP BY ALL")
def dup_provenance(t):
    return dedup.provenance(t("documents"), dedup.text_key(F.col("text")), "doc_id", "source")


@query(f"SELECT source, count(*) AS n, count(DISTINCT k) AS n_distinct, count(*) - count(DISTINCT k) AS n_repeated FROM (SELECT source, {_KEY} AS k FROM documents) GROUP BY source")
def dup_count_by_source(t):
    keyed = t("documents").select("source", dedup.text_key(F.col("text")).alias("k"))
    each = keyed.groupBy("source", "k").agg(F.count("*").alias("c"))
    return each.groupBy("source").agg(F.sum("c").alias("n"), F.count("*").alias("n_distinct"), (F.sum("c") - F.count("*")).alias("n_repeated"))


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1a\x1c-\x1f]') OR length(text) - length(replace(text, chr(65533), '')) >= 3")
def control_char_docs(t):
    from ..operators.rules import CONTROL

    c = F.col("text")
    return t("documents").where(c.rlike(CONTROL) | (F.regexp_count(c, F.lit("�")) >= 3)).select("doc_id")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?:\.\s){30,}\.|\.{200,}')")
def dot_run(t):
    from ..operators.rules import DOTS

    return t("documents").where(F.col("text").rlike(DOTS)).select("doc_id")


@query()
def char_run(t):
    """Documents with one letter 25 times in a row."""
    return t("documents").where(T.char_run(F.col("text"), 25)).select("doc_id")


@query()
def word_loop(t):
    """Documents with one word ten times in a row."""
    return t("documents").where(T.word_loop(F.col("text"), 10)).select("doc_id")


@query(
    rf"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents), g AS (SELECT doc_id, unnest(range(1, len(w) - 8)) AS pos, w FROM w WHERE len(w) >= 150),
c AS (SELECT doc_id, array_to_string(w[pos:pos + 9], ' ') AS gram, count(*) AS times, min(pos) AS pos FROM g GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY times DESC, pos) AS k FROM c)
SELECT doc_id, times FROM r WHERE k = 1 AND times >= 12 AND len(list_filter(string_split(gram, ' '), lambda x: regexp_matches(x, '\p{{L}}'))) >= 5"""
)
def repetition_loop_10gram(t):
    return dedup.phrase_loops(t("documents"), "doc_id", "text")


@query(
    rf"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, len(w) AS n, CASE WHEN len(w) >= 20 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END AS g FROM w)
SELECT doc_id, CASE WHEN n < 20 THEN 0.0 ELSE round(1 - CAST(len(list_distinct(g)) AS DOUBLE) / len(g), 6) END AS ratio FROM g"""
)
def repetition_ratio_3gram(t):
    return t("documents").select("doc_id", F.round(T.repetition_ratio(F.col("text")), 6).alias("ratio"))


@query(r"SELECT doc_id, round(CAST(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS DOUBLE) / greatest(length(text), 1), 6) AS ratio FROM documents")
def alnum_ratio(t):
    c = F.col("text")
    return t("documents").select("doc_id", F.round(T.alnum_count(c) / F.greatest(F.length(c), F.lit(1)), 6).alias("ratio"))


@query("SELECT CASE WHEN n <= 100 THEN '0-100' WHEN n <= 1000 THEN '101-1000' WHEN n <= 5000 THEN '1001-5000' ELSE '>5000' END AS bucket, count(*) AS n_rows, sum(n) AS chars, round(100.0 * count(*) / (SELECT count(*) FROM documents), 4) AS pct_rows FROM (SELECT length(text) AS n FROM documents) GROUP BY 1")
def length_buckets(t):
    counted = t("documents").select(F.length("text").alias("n")).groupBy(stats.bucket(F.col("n"), [100, 1000, 5000]).alias("bucket")).agg(F.count("*").alias("n_rows"), F.sum("n").alias("chars"))
    return counted.withColumn("pct_rows", stats.share(counted, "n_rows"))


@query("SELECT lang, quantile_disc(length(text), 0.5) AS p50, quantile_disc(length(text), 0.9) AS p90, quantile_disc(length(text), 0.99) AS p99, max(length(text)) AS largest FROM documents GROUP BY lang")
def length_percentiles(t):
    return stats.percentiles(t("documents").select("lang", F.length("text").alias("n")), "lang", "n", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query(
    r"""SELECT source, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS email_any,
count(*) FILTER (regexp_matches(text, '\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}')) AS phone_any, count(*) FILTER (regexp_matches(text, '(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})')) AS secret_any FROM documents GROUP BY source"""
)
def pii_flags(t):
    c = F.col("text")
    return t("documents").groupBy("source").agg(F.count_if(c.rlike(pii.EMAIL_ANY)).alias("email_any"), F.count_if(c.rlike(pii.PHONE_ANY)).alias("phone_any"), F.count_if(c.rlike(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}")).alias("secret_any"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g')) AS text_md5 FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')")
def pii_email_redact(t):
    c = F.col("text")
    return t("documents").where(c.rlike(pii.EMAIL_ANY)).select("doc_id", F.md5(F.regexp_replace(c, pii.EMAIL_ANY, "<EMAIL>")).alias("text_md5"))


@query()
def pii_guarded_redact(t):
    """Documents that the guarded redaction changes, and the figures of what it found."""
    c = F.col("text")
    found = t("documents").select("doc_id", "text", pii.redact(c).alias("redacted"), F.size(pii.emails(c)).alias("n_emails"), F.size(pii.phones(c)).alias("n_phones"), F.size(pii.cards(c)).alias("n_cards"))
    return found.where("redacted <> text").select("doc_id", "n_emails", "n_phones", "n_cards", F.md5("redacted").alias("text_md5"))


@query()
def pii_reserved_emails(t):
    """Documents in which guarded addresses were replaced by reserved ones."""
    out = t("documents").select("doc_id", "text", pii.replace_emails("text").alias("replaced"))
    return out.where("replaced <> text").select("doc_id", F.md5("replaced").alias("text_md5"))


_IPS = r"""WITH ips AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS ip FROM documents),
o AS (SELECT doc_id, ip, list_transform(string_split(ip, '.'), lambda x: CAST(x AS INTEGER)) AS o FROM ips)"""


@query(
    _IPS
    + """ SELECT doc_id, ip FROM o WHERE len(list_filter(o, lambda x: x > 255)) = 0 AND NOT (o[1] IN (0, 10, 127) OR o[1] >= 224 OR (o[1] = 100 AND o[2] BETWEEN 64 AND 127) OR (o[1] = 169 AND o[2] = 254)
 OR (o[1] = 172 AND o[2] BETWEEN 16 AND 31) OR (o[1] = 192 AND o[2] = 168) OR (o[1] = 192 AND o[2] = 0 AND o[3] IN (0, 2)) OR (o[1] = 198 AND o[2] IN (18, 19)) OR (o[1] = 198 AND o[2] = 51 AND o[3] = 100) OR (o[1] = 203 AND o[2] = 0 AND o[3] = 113))"""
)
def pii_ip_public(t):
    found = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"), F.lit(0))).alias("ip"))
    fine = F.forall(F.split("ip", r"\."), lambda x: x.cast("int") <= 255)
    return found.where(fine & pii.is_public_ip(F.col("ip"))).select("doc_id", "ip")


@query(
    r"""WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b[0-9]{16}\b')) AS num FROM documents),
s AS (SELECT doc_id, num, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1 THEN (CASE WHEN 2 * CAST(num[i] AS INTEGER) > 9 THEN 2 * CAST(num[i] AS INTEGER) - 9 ELSE 2 * CAST(num[i] AS INTEGER) END) ELSE CAST(num[i] AS INTEGER) END)) AS total FROM d)
SELECT doc_id, num, total % 10 = 0 AS valid FROM s"""
)
def pii_luhn(t):
    found = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[0-9]{16}\b"), F.lit(0))).alias("num"))
    return found.select("doc_id", "num", F.call_function("luhn_check", F.col("num")).alias("valid"))


@query(
    r"""SELECT CASE WHEN text IS NULL OR length(text) = 0 THEN 'unknown' WHEN CAST(length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS DOUBLE) / length(text) < 0.3 THEN 'no_natural_language'
WHEN lang IS NULL THEN 'unknown' WHEN CAST(length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS DOUBLE) / length(text) < 0.5 THEN 'uncertain' ELSE lang END AS bucket, count(*) AS n FROM documents GROUP BY 1"""
)
def lang_bucket_distribution(t):
    c = F.col("text")
    share = T.alpha_count(c) / F.greatest(F.length(c), F.lit(1))
    return t("documents").groupBy(labelling.language_bucket(c, F.col("lang"), share).alias("bucket")).agg(F.count("*").alias("n"))


_KEYWORD_CASES = " ".join("WHEN regexp_matches(lower(text), '" + "|".join(k) + f"') THEN '{name}'" for name, k in labelling.KEYWORDS)


@query(f"SELECT CASE {_KEYWORD_CASES} ELSE '{labelling.NO_KEYWORD}' END AS category, count(*) AS n FROM documents GROUP BY 1")
def keyword_fallback_domain(t):
    return t("documents").groupBy(labelling.keyword_category(F.col("text")).alias("category")).agg(F.count("*").alias("n"))


@query(
    """WITH k AS (SELECT unnest(['the', 'idiot', 'email', 'license', 'copyright']) AS phrase), h AS (SELECT doc_id, phrase FROM documents JOIN k ON contains(lower(text), phrase))
SELECT phrase, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM h) WHERE r <= 5"""
)
def keyword_target_sample(t):
    phrases = F.array(*map(F.lit, ["the", "idiot", "email", "license", "copyright"]))
    hits = t("documents").select("doc_id", F.explode(F.filter(phrases, lambda p: F.contains(F.lower("text"), p))).alias("phrase"))
    return sampling.per_group(hits, "phrase", "doc_id", 5).select("phrase", "doc_id")


@query(r"SELECT doc_id FROM documents WHERE length(text) < 160 AND regexp_matches(text, '(?i)(?:following|below|given)\s+(?:text|passage|snippet)s?\s*:?\s*$')")
def prompt_missing_payload(t):
    from ..operators.rules import MISSING_PAYLOAD

    return t("documents").where((F.length("text") < 160) & F.col("text").rlike(MISSING_PAYLOAD)).select("doc_id")


_RULES = [(r"^src(1|2|3)$", "Web"), (r"^src1\d$", "Books"), (r"[05]$", "Code")]


@query("SELECT CASE WHEN regexp_matches(source, '^src(1|2|3)$') THEN 'Web' WHEN regexp_matches(source, '^src1[0-9]$') THEN 'Books' WHEN regexp_matches(source, '[05]$') THEN 'Code' ELSE 'Other / Mixed' END AS domain, count(*) AS n FROM documents GROUP BY 1")
def source_rules_domain(t):
    return t("documents").groupBy(labelling.by_rules(F.col("source"), _RULES, "Other / Mixed").alias("domain")).agg(F.count("*").alias("n"))


@query(r"SELECT doc_id, md5(replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '__label__', '')) AS text_md5 FROM documents")
def clean_text(t):
    return t("documents").select("doc_id", F.md5(T.clean(F.col("text"))).alias("text_md5"))


@query("SELECT doc_id, text = any_value(text) OVER () AS same FROM documents WHERE text IN (SELECT text FROM benchmark)")
def decontam_equal(t):
    """Documents equal to a test item, the form of decontamination by equality."""
    hit = t("documents").join(t("benchmark").select("text").distinct(), "text", "left_semi")
    return hit.select("doc_id", F.lit(True).alias("same"))


@query("SELECT count(*) AS n_kept, sum(length(d.text)) AS chars FROM documents d WHERE trim(d.text) NOT IN (SELECT trim(text) FROM benchmark)")
def decontam_anti(t):
    items = t("benchmark").select(F.trim("text").alias("k")).distinct()
    return t("documents").withColumn("k", F.trim("text")).join(items, "k", "left_anti").agg(F.count("*").alias("n_kept"), F.sum(F.length("text")).alias("chars"))


@query(
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w FROM documents),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM w),
v AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w FROM benchmark),
b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM v)
SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (g) GROUP BY doc_id, item_id"""
)
def decontam_ngram_overlap(t):
    def grams(df, key):
        w = T.words(F.lower("text"))
        hashed = T.let(w, lambda x: F.array_distinct(F.transform(F.when(F.size(x) >= 8, F.sequence(F.lit(1), F.size(x) - 7)).otherwise(F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice(x, i, 8)))))
        return df.select(key, F.explode(hashed).alias("g"))

    # distinct within each row, so nothing is to be made distinct after the join
    return grams(t("documents"), "doc_id").join(grams(t("benchmark"), "item_id"), "g").groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))


@query("SELECT quality, toxic, count(*) AS n, count(DISTINCT source) AS n_sources FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality, toxic")
def labels_left(t):
    return t("documents").join(t("labels"), "doc_id", "left").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"))


@query("SELECT phrase, count(*) AS n FROM documents JOIN (SELECT unnest(['idiot', 'token =', 'mit license', 'example.com']) AS phrase) ON contains(lower(text), phrase) GROUP BY phrase")
def phrase_contains_join(t):
    from ..operators.joins import phrases_in

    docs = t("documents").select("text")
    phrases = docs.sparkSession.createDataFrame([(p, p) for p in ("idiot", "token =", "mit license", "example.com")], "phrase string, label string")
    return phrases_in(docs, "text", phrases).groupBy("phrase").agg(F.count("*").alias("n"))


_SHUFFLED = "md5(CAST(doc_id AS VARCHAR)), doc_id"


@query(f"SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_SHUFFLED}) AS r FROM documents) WHERE r <= 7")
def reservoir_per_source(t):
    return sampling.per_group(t("documents"), "source", "doc_id", 7).select("source", "doc_id")


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 10")
def cap_per_source(t):
    return dedup.cap_by_key(t("documents"), ["source"], ["doc_id"], 10).select("source", "doc_id")


@query(f"SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_SHUFFLED}) AS r FROM documents) ORDER BY r, source LIMIT 50")
def round_robin(t):
    return sampling.round_robin(t("documents"), "source", "doc_id", 50).select("source", "doc_id")


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM documents) WHERE r % 10 = 0")
def systematic_every_k(t):
    return sampling.systematic(t("documents"), "source", "doc_id", 10).select("source", "doc_id")


@query("SELECT is_validation, count(*) AS n, sum(doc_id) AS ids FROM (SELECT doc_id, CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 4) AS INTEGER) < 9830 AS is_validation FROM documents) GROUP BY 1")
def train_val_split(t):
    return sampling.split(t("documents"), "doc_id", 0.15).groupBy("is_validation").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT lang, n * least(25, greatest(1, CAST(ceil(400.0 / n) AS BIGINT))) AS n_out FROM c")
def oversample_rare(t):
    return sampling.oversampled(t("documents"), "lang").groupBy("lang").agg(F.count("*").alias("n_out"))


@query("SELECT quality, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS r FROM labels) WHERE r <= 3")
def examples_per_label(t):
    return dedup.cap_by_key(t("labels"), ["quality"], ["doc_id"], 3).select("quality", "doc_id")


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS r FROM c) SELECT CASE WHEN r <= 5 THEN source ELSE '(all others)' END AS source, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1")
def top_plus_others(t):
    return stats.top_and_others(t("documents"), "source", 5)


@query(f"WITH k AS (SELECT lang, doc_id, {_KEY} AS k FROM documents), f AS (SELECT min(doc_id) AS doc_id FROM k GROUP BY k) SELECT lang, count(*) AS before, count(f.doc_id) AS after, round(100.0 * count(f.doc_id) / count(*), 4) AS pct_kept FROM k LEFT JOIN f ON k.doc_id = f.doc_id GROUP BY lang")
def before_after_dedup(t):
    docs = t("documents").select("doc_id", "lang", dedup.text_key(F.col("text")).alias("k"))
    first = docs.groupBy("k").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(1).alias("kept"))
    both = docs.join(first, "doc_id", "left").groupBy("lang").agg(F.count("*").alias("before"), F.count("kept").alias("after"))
    return both.withColumn("pct_kept", F.round(100.0 * F.col("after") / F.col("before"), 4))


@query("SELECT lang, count(DISTINCT source) AS n_sources, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY lang")
def paths_listagg(t):
    return t("documents").groupBy("lang").agg(F.countDistinct("source").alias("n_sources"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("SELECT lang, source, count(*) AS n, CAST(grouping(lang, source) AS INTEGER) AS level FROM documents GROUP BY GROUPING SETS ((lang), (lang, source))")
def hierarchy_counts(t):
    return stats.hierarchy(t("documents"), ["lang", "source"])


@query(
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang, length(regexp_extract(url, '\?(.*?)(?:#|$)', 1)) > 0 AS has_query FROM pages"""
)
def url_source_parse(t):
    u = F.col("url")
    return t("pages").select("page_id", F.regexp_extract(u, r"^https?://([^/]+)", 1).alias("host"), F.regexp_extract(u, r"^https?://[^/]+/([a-z]{2})/", 1).alias("lang"), (F.length(F.regexp_extract(u, r"\?(.*?)(?:#|$)", 1)) > 0).alias("has_query"))


@query("SELECT count(*) FILTER (contains(html, '<article>')) AS article, count(*) FILTER (contains(html, '<nav>')) AS nav, count(*) FILTER (contains(html, '</html>')) AS closed, count(*) AS n FROM pages")
def template_detect(t):
    h = F.col("html")
    return t("pages").agg(F.count_if(h.contains("<article>")).alias("article"), F.count_if(h.contains("<nav>")).alias("nav"), F.count_if(h.contains("</html>")).alias("closed"), F.count("*").alias("n"))


@query("SELECT lang, source, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY lang), 4) AS pct FROM documents GROUP BY lang, source")
def pct_of_total(t):
    counted = t("documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return counted.withColumn("pct", stats.share(counted, "n", within=["lang"]))


@query("SELECT lang, rank() OVER (ORDER BY n DESC) AS domain_rank, n FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def ranked_groups(t):
    counted = t("documents").groupBy("lang").agg(F.count("*").alias("n"))
    return counted.select("lang", F.rank().over(W.orderBy(F.desc("n"))).cast("long").alias("domain_rank"), "n")


@query("SELECT 'documents' AS side, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'labels', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def set_differences(t):
    a, b = t("documents").select("doc_id"), t("labels").select("doc_id")
    count = lambda x, y, name: x.join(y, "doc_id", "left_anti").distinct().agg(F.lit(name).alias("side"), F.count("*").alias("n"))
    return count(a, b, "documents").unionByName(count(b, a, "labels"))
