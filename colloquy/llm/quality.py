"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's features are its weighted words (hashed) and trigrams of character classes
(how it is written, whatever its language) with a few shares such as repeated words. Labelled texts of
a bounded sample (SAMPLE_PER_CLASS) span a latent space by truncated singular
value decomposition; their vectors are broadcast (their number is fixed), and every
document's exact cosine with every one of them is computed in blocks. The NEIGHBOURS
nearest vote with their similarity, each class weighted back to its share of all
labelled rows.

Defined cases: null and empty texts are scored like any other, by their zero
vector's neighbours at similarity 0: the share of label 1; without labels every
score is 0.5; a text of any length is read whole; of neighbours that tie at the last
place any may vote, the same ones for equal texts; a null quality or doc_id is not
learned from; repeated rows each return a row; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import textblocks as tb
from .language import held_out

#: Labelled texts of each class that the space is fitted on and that vote.
SAMPLE_PER_CLASS = 1_500
NEIGHBOURS = 15
DIMENSIONS = 48
THRESHOLD = 0.7

#: Character classes: 0 space, 1 line end, 2 lower case, 3 upper case, 4 digit, 5 beyond ASCII, and kinds of punctuation.
_CLASS = np.full(256, 15, np.uint8)
for _kind, _chars in enumerate([" \t", "\n\r\v\f", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"]):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _kind
_CLASS[128:] = 5
for _kind, _chars in zip(range(6, 15), [".", ",", "!", "?", "\"'`", "()[]{}<>", "|/\\", "*#&%$@^~_+=", "-:;"]):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _kind
TRIGRAMS = 16**3
#: Slots of the hashed words; with the sample they bound what the driver holds (some 60 MB).
WORD_BITS = 10
TERMS = TRIGRAMS + (1 << WORD_BITS)
SHARES = 8


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of trigram and word counts (damped, each of length 1) and shares for each row at off."""
    kinds = _CLASS[buf].astype(np.int64)
    codes = kinds[:-2] * 256 + kinds[1:-1] * 16 + kinds[2:] if len(kinds) > 2 else np.zeros(0, np.int64)
    words, rows = tb.word_hashes(buf, off)
    lines = buf == 10
    out = np.zeros((len(off) - 1, TERMS + SHARES), np.float32)
    for r in range(len(off) - 1):
        a, b = off[r], off[r + 1]
        n = b - a
        if not n:
            continue
        counts = np.log1p(np.bincount(codes[a : max(a, b - 2)], minlength=TRIGRAMS))
        out[r, :TRIGRAMS] = counts / max(np.sqrt(np.square(counts).sum()), 1e-9)
        tally = np.bincount(kinds[a:b], minlength=16)
        w = words[rows[r] : rows[r + 1]]
        if len(w):
            times = np.log1p(np.bincount((w >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=TERMS - TRIGRAMS))
            out[r, TRIGRAMS:TERMS] = times / np.sqrt(np.square(times).sum())
        repeated = 1 - len(tb.distinct(w)) / len(w) if len(w) else 0
        pairs = tb.grams(w, 3)
        looped = 1 - len(tb.distinct(pairs)) / len(pairs) if len(pairs) else 0
        letters = tally[2] + tally[3] + tally[5]
        out[r, TERMS:] = (tally[3] / max(letters, 1), tally[4] / n, tally[6:16].sum() / n, tally[13] / n, repeated, looped, lines[a:b].sum() / n, np.log1p(n) / 20)
    return out


class Voter:
    """The latent space and the labelled vectors in it."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, shares: dict[int, float]):
        """rows: features of the sample; they are weighted in place, so that the driver holds them once."""
        self.share = shares.get(1, 0.5) if shares else 0.5
        self.labels = labels.astype(np.float32)
        if not len(rows):
            return
        present = (rows[:, :TERMS] > 0).sum(axis=0)
        self.weights = np.ones(rows.shape[1], np.float32)
        self.weights[:TERMS] = np.log((1 + len(rows)) / (1 + present))
        self.weights[TERMS:] = 2.0
        x = rows
        x *= self.weights
        self.mean = x.mean(axis=0)
        x -= self.mean
        rng = np.random.default_rng(7)
        y = x @ rng.standard_normal((x.shape[1], min(DIMENSIONS + 16, len(x)))).astype(np.float32)
        for _ in range(3):
            y, _ = np.linalg.qr(x @ (x.T @ y))
        _, _, axes = np.linalg.svd(y.T @ x, full_matrices=False)
        axes = np.ascontiguousarray(axes[:DIMENSIONS].T.astype(np.float32))
        self.vectors = self._unit(x @ axes)
        self.axes, self.origin = self.weights[:, None] * axes, self.mean @ axes
        present = {c: max(1, int((labels == c).sum())) for c in (0, 1)}
        self.votes = np.array([shares.get(int(c), 0) / present[int(c)] for c in labels], np.float32)
        self.votes /= max(self.votes.mean(), 1e-9)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        vectors = self._unit(rows @ self.axes - self.origin)
        vectors[~rows.any(axis=1)] = 0
        out = np.empty(len(rows))
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(rows), 512):
            cosine = vectors[a : a + 512] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** 4 * self.votes[near]
            total = weight.sum(axis=1)
            out[a : a + 512] = np.where(total > 1e-9, (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-9), self.share)
        return np.clip(out, 0, 1)


def _feature_rows(batches, extra: list[str]):
    for batch in batches:
        buf, off = tb.as_bytes(batch.column("text"))
        for i, j in tb.chunks(off):
            for a in range(i, j, 512):  # 20 KB of features a row
                b = min(a + 512, j)
                yield [batch.column(c)[a:b] for c in extra], features(buf[off[a] : off[b]], off[a : b + 1] - off[a])


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Voter:
    """Learn labels.quality from labelled documents that are not held out."""
    ship(docs.sparkSession)
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    counts = {q: n for q, n in known.groupBy("quality").count().collect()}
    total = sum(counts.values())
    chosen = None
    for q in counts:
        part = known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return Voter(np.zeros((0, TERMS + SHARES), np.float32), np.zeros(0, int), {})

    def run(batches):
        for (quality,), rows in _feature_rows(batches, ["quality"]):
            yield pa.RecordBatch.from_arrays([quality, pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary())], ["quality", "features"])

    # at most two samples' ids; of rows that share a doc_id one text is learned from
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = sorted((q, bytes(f)) for q, f in sample.select("quality", "text").mapInArrow(run, "quality int, features binary").collect())
    rows, quality = np.empty((len(found), TERMS + SHARES), np.float32), np.array([q for q, _ in found])
    for i in range(len(found)):
        rows[i] = np.frombuffer(zlib.decompress(found[i][1]), np.float32)
        found[i] = None
    return Voter(rows, quality, {q: n / total for q, n in counts.items()})


def score(docs: DataFrame, voter: Voter, threshold: float = THRESHOLD, keep: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs; with keep, all of docs' columns and these."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(voter)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs if keep else docs.select("doc_id", "text")
    added = ["held_out", "score", "predicted"]
    names = [c for c in docs.columns if c not in added and (keep or c != "text")]
    marked = docs.select(*dict.fromkeys([*names, "text"]), held_out().alias("held_out"))

    def run(batches):
        v = shared.value
        for columns, rows in _feature_rows(batches, [*names, "held_out"]):
            s = v.score(rows)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], [*names, *added])

    schema = marked.select(*names, "held_out").schema.add("score", "double").add("predicted", "integer")
    return marked.mapInArrow(run, schema)
