"""N-gram Jaccard join: grouped prefix join over word shingles.

Documents with equal shingle sets collapse to one representative. A fixed-size
count sketch over the whole corpus orders shingles from rare to frequent; of a
set of n, only the n - ceil(t * n) + 1 rarest (its prefix) can be needed to meet
every partner. Representatives with the same prefix and size form one group;
groups meet on prefix shingles, pairs are filtered by size, position and an exact
upper bound on the overlap, then expanded to members and verified on whole sets.

Large groups of near copies never become all pairs: sets that agree in some band of
least hashes are first compared side by side, which joins such groups into
components, and only pairs that then still lie in different components are
compared one by one. Two documents are in one component if and only if a chain of
verified links joins them. Shingles are compared by 64-bit hashes, so the result is
that of the shingles themselves unless two of a compared pair collide.

Defined cases: null and empty texts have no shingles, link with nothing and are
their own component; a text with fewer than k words is one shingle; a text of any
length is read whole, by one task; documents of equal size and similarity tie by
doc_id; rows that share a doc_id are one document, in the component of each of its
texts, and each returns a row; a null doc_id takes the component of the documents
with an equal set, else null; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textblocks as tb
from .staging import Stages, components, keep_shared

#: Counters of the frequency sketch (2**20): its size never grows with the corpus.
SKETCH_BITS = 20
SKETCH_PART = 1 << 14
#: Bands of least hashes that find first links, and least hashes in each.
BANDS, BAND = 16, 8
#: Buckets of the overlap bound kept for each representative.
BOUND_BUCKETS = 128
#: Parts in which neighbours of a band are found, and sets before it that a set is held against.
BAND_SALTS, BEFORE = 8, 8
#: Words of the parity bitmap of a set. Sets that differ in d shingles have bitmaps that differ in d bits at most.
PARITY_WORDS = 4
PARITY = [f"m{i}" for i in range(PARITY_WORDS)]


def _shingle_stream(batches: Iterator[pa.RecordBatch], k: int):
    """(batch, first row, row sets' hashes with repeats) for each chunk of rows."""
    for batch in batches:
        buf, off = tb.as_bytes(batch.column("text"))
        for i, j in tb.chunks(off):
            local = off[i : j + 1] - off[i]
            words, rows = tb.word_hashes(buf[off[i] : off[j]], local)
            yield batch, i, j, words, tb.grams(words, k), rows


def _row_grams(words: np.ndarray, all_grams: np.ndarray, a: int, b: int, k: int) -> np.ndarray:
    if b - a >= k:
        return all_grams[a : b - k + 1]
    return np.array([tb.whole(words[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64)


def shingle_levels(docs: DataFrame, k: int) -> np.ndarray:
    """log2 of each sketch counter over all shingles of all documents, as bytes."""

    def count(batches):
        total = None
        for _, i, j, words, g, rows in _shingle_stream(batches, k):
            if total is None:
                total = np.zeros(1 << SKETCH_BITS, np.int64)
            # grams across row ends are counted as well: they only blur the order
            total += np.bincount((g >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        if total is not None:
            parts = range(0, len(total), SKETCH_PART)
            yield pa.RecordBatch.from_pydict({"part": pa.array([p // SKETCH_PART for p in parts], pa.int32()), "counts": pa.array([zlib.compress(total[p : p + SKETCH_PART].astype(np.int32).tobytes(), 1) for p in parts], pa.binary())})

    def add(key, group):
        total = np.zeros(SKETCH_PART, np.int64)
        for x in group.column("counts"):
            total += np.frombuffer(zlib.decompress(x.as_py()), np.int32)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "level": pa.array([np.frexp(total)[1].astype(np.uint8).tobytes()], pa.binary())})

    rows = docs.select("text").mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, level binary").collect()  # 1 MB, whatever the corpus
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for part, level in rows:
        levels[part * SKETCH_PART : (part + 1) * SKETCH_PART] = np.frombuffer(bytes(level), np.uint8)
    return levels


def bound_bytes(s: np.ndarray) -> bytes:
    """How many of the set's shingles fall in each bucket (255: at least that)."""
    return np.minimum(np.bincount((s & np.uint64(BOUND_BUCKETS - 1)).astype(np.int64), minlength=BOUND_BUCKETS), 255).astype(np.uint8).tobytes()


def parity_words(s: np.ndarray) -> np.ndarray:
    """For each bucket whether the set has an odd number of shingles there, as 64-bit words."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_EDGES = np.array([(i << 64) // (BANDS * BAND) for i in range(BANDS * BAND)], np.uint64)


def band_hashes(s: np.ndarray) -> np.ndarray:
    """One hash for each band: of the least shingle hash at or after each of its edges."""
    if not len(s):
        return np.zeros(0, np.uint64)
    least = s[np.searchsorted(s, _EDGES) % len(s)].reshape(BANDS, BAND)
    return tb.mix((tb.mix(least) * (2 * np.arange(BAND, dtype=np.uint64) + np.uint64(1))).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _signatures(docs: DataFrame, k: int, percent: int, levels) -> DataFrame:
    """doc_id, n, 128-bit signature of the set, of the prefix, the prefix, the bound."""

    def run(batches):
        level = levels.value
        for batch, i, j, words, g, rows in _shingle_stream(batches, k):
            out = {c: [] for c in ("n", "s1", "s2", "p")}
            prefixes, bounds, bands, parity = [], [], [], []
            for r in range(j - i):
                s = tb.distinct(_row_grams(words, g, rows[r], rows[r + 1], k))
                n = len(s)
                rank = level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort((rank.astype(np.uint64) << np.uint64(58)) | (tb.mix(s) >> np.uint64(6)), kind="stable")
                prefix = s[order[: n - -(-percent * n // 100) + 1]] if n else s
                out["n"].append(n)
                out["s1"].append(int(np.add.reduce(tb.mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) if n else 0)
                out["s2"].append(int(np.add.reduce(tb.mix(s ^ np.uint64(0x14057B7EF767814F))).view(np.int64)) if n else 0)
                out["p"].append(int(np.add.reduce(tb.mix(prefix)).view(np.int64)) if n else 0)
                prefixes.append(prefix)
                bounds.append(bound_bytes(s))
                bands.append(band_hashes(s))
                parity.append(parity_words(s))
            parity = np.stack(parity)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[i:j].cast(pa.int64()), pa.array(out["n"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in ("s1", "s2", "p")), tb.list_array(prefixes), pa.array(bounds, pa.binary()), tb.list_array(bands), *(pa.array(np.ascontiguousarray(x)) for x in parity.T)],
                ["doc_id", "n", "s1", "s2", "p", "prefix", "bound", "bands", *PARITY],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n int, s1 long, s2 long, p long, prefix array<long>, bound binary, bands array<long>" + "".join(f", {m} long" for m in PARITY))


def _overlap_needed(a: str, b: str, percent: int):
    """Smallest overlap of two sets of sizes a and b with that similarity."""
    return F.expr(f"cast(ceil({percent}D * ({a} + {b}) / {100 + percent}) as int)")


def _bounded(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of representatives whose bitmaps and buckets leave room for the overlap."""

    @F.pandas_udf("boolean")
    def possible(x, y, needed):
        if not len(x):
            return needed.astype(bool)
        x, y = (np.frombuffer(b"".join(map(bytes, c)), np.uint8).reshape(-1, BOUND_BUCKETS) for c in (x, y))
        low = np.minimum(x, y)
        import pandas as pd

        return pd.Series((low.sum(axis=1, dtype=np.int64) >= needed.to_numpy()) | (low == 255).any(axis=1))

    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bound").alias(f"bound_{c}"), *(F.col(m).alias(f"{m}_{c}") for m in PARITY))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    apart = " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in PARITY)
    joined = joined.where(F.expr(apart) <= F.expr("n_a + n_b") - 2 * _overlap_needed("n_a", "n_b", percent))
    return joined.where(possible("bound_a", "bound_b", _overlap_needed("n_a", "n_b", percent))).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the similarity.

    The texts of all a that share one b come after b's own text in one sorted
    stream; only b's set and one batch are in memory. A b with very many partners
    is salted: each salt gets its own copy of b's text.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(64)).cast("int")).select("a", "b", "salt")
    heads = salted.select("b", "salt").distinct()
    rows = (
        texts.join(salted.withColumnRenamed("a", "doc_id"), "doc_id")
        .select("b", "salt", F.lit(1).alias("kind"), F.col("doc_id").alias("a"), "text")
        .unionByName(texts.join(heads.withColumn("doc_id", F.col("b")), "doc_id").select("b", "salt", F.lit(0).alias("kind"), F.col("doc_id").alias("a"), "text"))
    )

    def run(batches):
        head, own = None, None
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            b, salt, kind, a = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("b", "salt", "kind", "a"))
            left, right = [], []
            for i, j in tb.chunks(off):
                words, at = tb.word_hashes(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                g = tb.grams(words, k)
                for r in range(j - i):
                    s = tb.distinct(_row_grams(words, g, at[r], at[r + 1], k))
                    if kind[i + r] == 0:
                        head, own = (b[i + r], salt[i + r]), s
                    elif head == (b[i + r], salt[i + r]):
                        shared = len(s) + len(own) - len(tb.distinct(np.concatenate([s, own])))
                        if len(s) and 100 * shared >= percent * (len(s) + len(own) - shared):
                            left.append(a[i + r])
                            right.append(b[i + r])
            yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return rows.repartition("b", "salt").sortWithinPartitions("b", "salt", "kind").mapInArrow(run, "a long, b long")


def _neighbours(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that stand near each other, by size, among the sets with an equal band.

    A set is paired with the nearest of the BEFORE sets before it whose size and
    bitmap leave room for the overlap. Sets of one size stand in another order in each
    band, so that a set meets others there. A band that very many sets share is dealt
    out: neighbours are found in each of BAND_SALTS parts of it, and then among the
    first BEFORE sets of its parts.
    """
    salted = F.pmod(F.xxhash64("doc_id"), F.lit(BAND_SALTS)).cast("int").alias("salt")
    rows = reps.select("doc_id", "n", *PARITY, F.explode("bands").alias("band"), salted)
    rows = rows.select("band", "salt", F.struct("n", F.xxhash64("doc_id", "band").alias("turn"), "doc_id", *PARITY).alias("x"))

    def beside(df: DataFrame, keys: list[str]) -> DataFrame:
        order = W.partitionBy(*keys).orderBy("x")
        placed = df.select("x", *(F.lag("x", i).over(order).alias(f"p{i}") for i in range(1, BEFORE + 1)))

        def room(p: str):
            apart = " + ".join(f"bit_count(x.{m} ^ {p}.{m})" for m in PARITY)
            return F.expr(f"100 * {p}.n >= {percent} * x.n") & (F.expr(apart) <= F.expr(f"x.n + {p}.n") - 2 * _overlap_needed("x.n", f"{p}.n", percent))

        near = F.coalesce(*(F.when(room(f"p{i}"), F.col(f"p{i}.doc_id")) for i in range(1, BEFORE + 1)))
        return placed.select(F.col("x.doc_id").alias("a"), near.alias("b")).where("b is not null")

    firsts = rows.withColumn("rank", F.row_number().over(W.partitionBy("band", "salt").orderBy("x"))).where(F.col("rank") <= BEFORE)
    return beside(rows, ["band", "salt"]).unionByName(beside(firsts, ["band"])).distinct()


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    docs: doc_id, text. Two documents link when the Jaccard similarity of their
    sets of distinct k-word shingles is at least percent / 100. Each intermediate
    table is deleted after its last reader.
    """
    spark: SparkSession = docs.sparkSession
    stages = Stages(spark, alike=True)
    levels = spark.sparkContext.broadcast(shingle_levels(docs, k))
    signatures = stages.keep(_signatures(docs, k, percent, levels), "signatures")
    # the least doc_id of each set; the rest of its row follows from the set
    first = F.min(F.struct("doc_id", "p", "prefix", "bands", "bound", *PARITY)).alias("first")
    reps = stages.keep(signatures.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(first).select("n", "s1", "s2", "first.*"), "reps")
    same = stages.keep(reps.select("n", "s1", "s2", F.col("doc_id").alias("rep")), "sets")
    signed = stages.keep(signatures.select("doc_id", "n", "s1", "s2"), "signed")
    stages.drop(signatures)

    groups = reps.groupBy("n", "p").agg(F.min("doc_id").alias("gid"), (F.count("*") > 1).alias("several"))
    members = stages.keep(reps.select("doc_id", "n", "p").join(groups, ["n", "p"]).select("gid", "doc_id", "several"), "members")
    firsts = reps.join(members.where("gid = doc_id").select("doc_id"), "doc_id", "left_semi")
    postings = firsts.select(F.posexplode("prefix").alias("pos", "token"), F.col("doc_id").alias("gid"), "n")
    shared = stages.keep(keep_shared(postings, "token"), "shared")
    in_play = members.where("not several").join(shared, "gid", "left_semi").unionByName(members.where("several")).select("doc_id")
    in_play = stages.keep(in_play, "in-play")

    # first links: members with their group's first, groups in play with neighbours in bands of least hashes
    inner = members.where("gid <> doc_id").select(F.col("doc_id").alias("a"), F.col("gid").alias("b"))
    bounds = stages.keep(reps.select("doc_id", "n", "bands", "bound", *PARITY).join(in_play, "doc_id", "left_semi"), "bounds")
    stages.drop(reps)
    near = stages.keep(_bounded(_neighbours(bounds, percent).unionByName(inner).distinct(), bounds, percent), "near")
    texts = stages.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(in_play, "doc_id", "left_semi"), "texts")
    links = stages.keep(_verified(near, texts, k, percent), "links")
    first = stages.keep(components(stages, links), "first")

    # cross pass: what shares a shingle but not yet a component, pair by pair
    labelled = stages.keep(members.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("gid", "doc_id", F.coalesce("component", "doc_id").alias("component")), "labelled")
    of_group = stages.keep(labelled.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), (F.count("*") == 1).alias("alone")), "groups")
    mixed = shared.join(of_group, "gid").groupBy("token").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least <> most").select("token")
    open_ = stages.keep(shared.join(mixed, "token", "left_semi"), "open")
    stages.drop(shared)
    parity = bounds.select(F.col("doc_id").alias("gid"), *PARITY)
    tagged = stages.keep(open_.join(of_group.join(parity, "gid"), "gid").select("token", "gid", "n", "pos", "lo", "hi", "alone", *PARITY), "tagged")
    stages.drop(open_)
    x, y = tagged.alias("x"), tagged.alias("y")
    crossed = x.join(y, F.expr(f"x.token = y.token and (x.n, x.gid) < (y.n, y.gid) and 100 * x.n >= {percent} * y.n and not (x.lo = x.hi and x.lo = y.lo and y.lo = y.hi)"))
    apart = " + ".join(f"bit_count(x.{m} ^ y.{m})" for m in PARITY)
    # the bitmaps are of a group's first set and say nothing of other members
    crossed = crossed.where(F.expr("not (x.alone and y.alone)") | (F.expr(apart) <= F.expr("x.n + y.n") - 2 * _overlap_needed("x.n", "y.n", percent)))
    # of a pair that reaches the similarity, the first common shingle leaves room for the overlap behind it
    crossed = crossed.where(F.expr("least(x.n - x.pos, y.n - y.pos)") >= _overlap_needed("x.n", "y.n", percent))
    group_pairs = stages.keep(crossed.select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h")).distinct(), "group-pairs")
    stages.drop(tagged)
    inside = labelled.join(of_group.where("lo <> hi").select("gid"), "gid", "left_semi")
    inside = inside.alias("u").join(inside.alias("v"), F.expr("u.gid = v.gid and u.doc_id > v.doc_id and u.component <> v.component")).select(F.col("u.doc_id").alias("a"), F.col("v.doc_id").alias("b"))
    u, v = labelled.alias("u"), labelled.alias("v")
    pairs = group_pairs.join(u, F.expr("g = u.gid")).join(v, F.expr("h = v.gid and u.component <> v.component")).select(F.col("u.doc_id").alias("a"), F.col("v.doc_id").alias("b")).unionByName(inside).distinct()
    pairs = stages.keep(_bounded(pairs, bounds, percent), "pairs")
    stages.drop(group_pairs, bounds, labelled, of_group)
    links = links.unionByName(stages.keep(_verified(pairs, texts, k, percent), "cross-links"))
    stages.drop(texts, pairs)
    final = stages.keep(components(stages, links), "components")

    linked = same.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    result = signed.join(linked, ["n", "s1", "s2"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    result = stages.keep(result, "result")
    stages.only("result")
    return result
