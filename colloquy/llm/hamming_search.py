"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are lengthened by one component so that the largest inner product is the
smallest angle, then rotated (iterative quantisation, fitted on a bounded sample)
and cut to sign bits. Codes split into SUBSTRINGS bytes, each with its own index
from byte value to rows. Of a code within Hamming distance r of a query, one
substring differs in at most r // SUBSTRINGS bits (in one less for all but the
first r % SUBSTRINGS + 1 of them), so probing the buckets that near in every index
retrieves every code within r. What is retrieved within r is ranked by the exact
inner product of the original vectors, in double precision.

The radius is the one within which a fitting sample finds RECALL of its true
neighbours. For a query that finds fewer than k rows within it over all shards, it
grows in steps of SUBSTRINGS bits, up to all bits, until each shard gives k rows or
all it has. Rows are dealt to shards and queries to blocks of bounded size; each
shard meets each block once. A vector that very many rows share takes part with
its k + 1 smallest ids, which are all that any result can show.

Defined cases: vectors null, empty, zero, or with null or non-finite components take
no part, as query or candidate; equal scores are in order of vec_id; an empty table
gives an empty result; vectors of another length than a query's are no
candidates of it; a null vec_id takes no part; extra columns are ignored; a repeated
vec_id is one candidate for each different vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ship
from .staging import Stages

#: Vectors that the rotation and radius are fitted on, at most.
SAMPLE_ROWS = 4_000
#: Bits of a code: SUBSTRINGS bytes.
SUBSTRINGS = 16
BITS = 8 * SUBSTRINGS
#: Share of true neighbours that the sample finds within the radius.
RECALL = 0.97
SHARD_ROWS = 20_000
BLOCK_QUERIES = 512

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Index:
    """The fitted code and the search in one shard."""

    def __init__(self, sample: np.ndarray, k: int, longest: float):
        """longest: the greatest length of all vectors that will be searched, in the sample or not."""
        d = sample.shape[1]
        self.longest = longest
        rng = np.random.default_rng(3)
        x = self._unit(sample)
        self.mean = np.zeros(d + 1)
        turns = []
        for _ in range(-(-BITS // (d + 1))):
            turn, _ = np.linalg.qr(rng.standard_normal((d + 1, d + 1)))
            for _ in range(8 if len(x) > d else 0):  # rotate towards the corners of the cube
                u, _, vt = np.linalg.svd(x.T @ np.sign(x @ turn))
                turn = u @ vt
            turns.append(turn)
        self.turn = np.concatenate(turns, axis=1)[:, :BITS]
        self.radius = BITS
        if len(x) > k + 1:
            asked = x[:: max(1, len(x) // 300)]
            asked = np.concatenate([asked[:, :-1], np.zeros((len(asked), 1))], axis=1)
            near = np.argpartition(-(asked @ x.T), k, axis=1)[:, : k + 1]
            codes, own = self._bits(x), self._bits(asked)
            apart = np.array([[_POPCOUNT[own[q] ^ codes[c]].sum() for c in row] for q, row in enumerate(near)])
            self.radius = int(np.quantile(apart, RECALL))

    def _unit(self, v: np.ndarray) -> np.ndarray:
        """One more component, so that every vector has the longest one's length."""
        rest = np.sqrt(np.maximum(self.longest**2 - (v**2).sum(axis=1), 0))
        return np.concatenate([v, rest[:, None]], axis=1)

    def _bits(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.turn > 0, axis=1)

    def code(self, v: np.ndarray, query: bool) -> np.ndarray:
        return self._bits(np.concatenate([v, np.zeros((len(v), 1))], axis=1) if query else self._unit(v))

    def _retrieved(self, codes: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
        """For each query, which rows the buckets hold that are probed for this radius."""
        near, extra = divmod(radius, SUBSTRINGS)
        hits = np.zeros((len(asked), len(codes)), bool)
        values = np.arange(256)
        for s in range(SUBSTRINGS):
            reach = near if s <= extra else near - 1
            if reach < 0:
                continue
            bucket = np.argsort(codes[:, s], kind="stable")  # the index of this substring: rows by bucket
            bounds = np.searchsorted(codes[bucket, s], np.arange(257))
            for value in np.unique(asked[:, s]):
                probes = np.flatnonzero(_POPCOUNT[values ^ value] <= reach)
                found = np.concatenate([bucket[bounds[p] : bounds[p + 1]] for p in probes])
                retrieved = np.zeros(len(codes), bool)
                retrieved[found] = True
                hits[asked[:, s] == value] |= retrieved
        return hits

    def search(self, ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, widen: bool):
        """(place of the query, vec_id, score) of at most k nearest found rows of each query.

        widen: let the radius of a query grow until it finds k rows, or all there are.
        """
        codes, asked = self.code(rows, False), self.code(queries, True)
        wide, own = codes.view(np.uint64), asked.view(np.uint64)
        out = []
        left, radius = np.arange(len(queries)), self.radius
        while len(left):
            again = []
            for q, hit in zip(left.tolist(), self._retrieved(codes, asked[left], radius)):
                c = np.flatnonzero(hit)
                c = c[np.bitwise_count(wide[c] ^ own[q]).sum(axis=1) <= radius]
                c = c[ids[c] != query_ids[q]]
                if widen and radius < BITS and len(c) < k and len(c) < (ids != query_ids[q]).sum():
                    again.append(q)
                    continue
                score = (rows[c] * queries[q]).sum(axis=1)
                if len(c) > k:  # all that tie with the k-th are still there
                    c, score = (x[score >= np.partition(score, -k)[-k]] for x in (c, score))
                best = np.lexsort((ids[c], -score))[:k]
                out.append((np.full(len(best), q), ids[c[best]], score[best]))
            left, radius = np.array(again, np.int64), min(BITS, radius + SUBSTRINGS)
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>), d of vectors that take part."""
    v = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    return v.where(fine).withColumn("d", F.size("v"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vec_id divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors)
    same = W.partitionBy("v").orderBy("vec_id")
    rows_kept = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    sizes = {r.d: r.n for r in rows.groupBy("d").agg(F.count("*").alias("n")).collect()}  # one row for each length of vector
    found = None
    for d, n in sorted(sizes.items()):
        part = _of_length(rows_kept.where(F.col("d") == d), rows.where((F.col("d") == d) & (F.pmod("vec_id", F.lit(every)) == 0)), d, n, k, every)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_length(rows: DataFrame, queries: DataFrame, d: int, n: int, k: int, every: int) -> DataFrame:
    spark = rows.sparkSession
    sample = rows.where(F.shiftrightunsigned(F.xxhash64("vec_id", F.lit(5)), 1) <= (2**63 - 1) * min(SAMPLE_ROWS, n) // max(n, 1)).select("v").limit(2 * SAMPLE_ROWS)
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0
    fitted = np.array([r[0] for r in sample.collect()]).reshape(-1, d)
    fitted = fitted[np.lexsort(fitted.T)] if len(fitted) else fitted
    index = Index(fitted, k, float(np.sqrt(longest)))
    shared = spark.sparkContext.broadcast(index)
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n // (every * BLOCK_QUERIES)))
    queries = queries.select("vec_id", "v", F.xxhash64("v").alias("form"))  # a repeated vec_id asks with each of its vectors
    if shards == 1:
        return _search(rows, queries, shared, d, k, 1, blocks, True).drop("form")
    stages = Stages(spark)
    found = stages.keep(_search(rows, queries, shared, d, k, shards, blocks, False), "found")
    full = found.groupBy(F.col("query_id").alias("vec_id"), "form").count().where(F.col("count") >= k)
    few = stages.keep(queries.join(full, ["vec_id", "form"], "left_anti"), "few")
    if asking := few.count():
        more = _search(rows, few, shared, d, k, shards, -(-asking // BLOCK_QUERIES), True)
        found = found.join(few.select(F.col("vec_id").alias("query_id"), "form"), ["query_id", "form"], "left_anti").unionByName(more)
    return found.drop("form")


def _search(rows: DataFrame, queries: DataFrame, shared, d: int, k: int, shards: int, blocks: int, widen: bool) -> DataFrame:
    """query_id, form, vec_id, score: the k nearest found rows of each query in each shard."""
    all_of = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    left = rows.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"), all_of(blocks, "block"))
    right = queries.select(F.col("vec_id").alias("query_id"), "form", F.col("v").alias("asked"), F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(blocks)).cast("int").alias("block"), all_of(shards, "shard"))

    def matrix(column) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return np.asarray(column.flatten()).reshape(-1, d).astype(np.float64)

    def run(key, a, b):
        if not a.num_rows or not b.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "form": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, form = b.column("query_id").to_numpy(), b.column("form").to_numpy()
        q, v, s = shared.value.search(a.column("vec_id").to_numpy(), matrix(a.column("v")), ids, matrix(b.column("asked")), k, widen)
        return pa.table({"query_id": pa.array(ids[q], pa.int64()), "form": pa.array(form[q], pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "query_id long, form long, vec_id long, score double")
