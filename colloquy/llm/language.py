"""Language identification by words first, then shorter and shorter n-grams.

A word that the model knows scores its log frequency in each language. An unseen
word scores, for each of its characters, the longest n-gram of characters (4 down
to 1) ending there that the model knows. The model is fitted on a bounded sample of
the labelled documents of each language (SAMPLE_PER_LANGUAGE), with all their words;
prediction reads every word of every text.

Defined cases: null text, or text without any letter, is "und" with score 0; so
is every text when there is nothing to learn from; a text of any length is read
whole; languages that tie are taken in order of their names; a null doc_id is not
held out and not learned from; repeated rows each return a row; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import textblocks as tb
from .unitcache import ragged

#: Labelled documents of each language that the model is fitted on, at most (expected number).
SAMPLE_PER_LANGUAGE = 1_500
#: Characters of the longest n-grams.
LONGEST = 4


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id's text leaves 2 when divided by 4 (null: not)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _characters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each UTF-8 character of the words at off as a number (its bytes), and the words' offsets in characters."""
    head = (buf & 0xC0) != 0x80
    head[off[:-1][np.diff(off) > 0]] = True
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(buf)))
    code = buf[at].astype(np.uint64)
    for k in range(1, 4):
        more = size > k
        code[more] |= buf[at[more] + k].astype(np.uint64) << np.uint64(8 * k)
    return code, np.searchsorted(at, off)


def _grams(code: np.ndarray, off: np.ndarray):
    """(hashes of the n-grams that end at each character, whether the word is that long) for n = 1 to LONGEST."""
    place = np.arange(len(code)) - np.repeat(off[:-1], np.diff(off))
    total = np.zeros(len(code), np.uint64)
    for n in range(1, LONGEST + 1):
        total[n - 1 :] += tb.mix(code[: len(code) - n + 1] + np.uint64(n << 40))
        yield tb.mix(total + np.uint64(n)), place >= n - 1


class Model:
    def __init__(self, languages: list[str], counts: pa.Table | None):
        """counts: lang, size (0: a word, else the characters of an n-gram), key (its hash), n; one row for each."""
        self.languages = languages
        if not languages:
            return
        language = np.searchsorted(np.array(languages), counts.column("lang").to_numpy().astype(str))
        size, key, times = (counts.column(c).to_numpy() for c in ("size", "key", "n"))
        tables = []
        for n in range(LONGEST + 1):
            mine = np.flatnonzero(size == n)
            keys, of = np.unique(key[mine].view(np.uint64), return_inverse=True)
            table = np.zeros((len(keys), len(languages)))
            table[of, language[mine]] = times[mine]
            tables.append((keys, self._log(table).astype(np.float32)))
        self.keys, self.word_scores = tables[0]
        self.gram_keys, self.gram_scores = [t[0] for t in tables[1:]], [t[1] for t in tables[1:]]

    @classmethod
    def of_words(cls, languages: list[str], words: list[tuple[str, bytes, int]]) -> Model:
        """The model of (language, word, count)."""
        parts = []
        for name in languages:
            mine = [(w, n) for x, w, n in words if x == name]
            buf, ends = np.frombuffer(b"".join(w for w, _ in mine), np.uint8), np.cumsum([0, *(len(w) for w, _ in mine)])
            keys = tb.span_hashes(buf, ends[:-1], ends[1:])
            parts.append(tallies(name, buf, ends[:-1], ends[1:], keys, np.array([n for _, n in mine], np.int64)))
        return cls(languages, pa.Table.from_batches(parts).group_by(["lang", "size", "key"]).aggregate([("n", "sum")]).rename_columns(["lang", "size", "key", "n"]))

    @staticmethod
    def _marked(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters of the words with a mark at both ends, and the words' offsets."""
        inner, off = ragged(buf, starts, ends - starts)
        marked = np.full(len(inner) + 2 * len(starts), 3, np.uint8)
        wide = off + 2 * np.arange(len(off))
        marked[np.arange(len(inner)) + 1 + 2 * np.repeat(np.arange(len(starts)), np.diff(off))] = inner
        marked[wide[:-1]] = 2
        return _characters(marked, wide)

    @staticmethod
    def _log(counts: np.ndarray) -> np.ndarray:
        total = counts.sum(axis=0, keepdims=True)
        return np.log(counts + 0.5) - np.log(total + 0.5 * max(1, (counts.sum(axis=1) > 0).sum()))

    def unseen(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Backed-off scores of words that are not known."""
        if not len(starts):
            return np.zeros((0, len(self.languages)), np.float32)
        code, wide = self._marked(buf, starts, ends)
        total = np.zeros((len(code), len(self.languages)), np.float32)
        open_ = np.ones(len(code), bool)
        for keys, scores, (grams, long) in reversed(list(zip(self.gram_keys, self.gram_scores, _grams(code, wide)))):
            use = np.flatnonzero(open_ & long)
            at = np.minimum(np.searchsorted(keys, grams[use]), max(len(keys) - 1, 0))
            known = keys[at] == grams[use] if len(keys) else np.zeros(len(use), bool)
            total[use[known]] = scores[at[known]]
            open_[use[known]] = False
        return np.add.reduceat(total, wide[:-1], axis=0)

    def score(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log scores of the rows at off in each language, and their numbers of words."""
        low = tb.lower_latin(buf)
        starts, ends, rows = tb.word_spans(low, off, tb.NOT_LETTER)
        keys, first, inverse = np.unique(tb.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        scores = np.zeros((len(keys), len(self.languages)), np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        scores[known] = self.word_scores[at[known]]
        new = np.flatnonzero(~known)
        scores[new] = self.unseen(low, starts[first[new]], ends[first[new]])
        out = np.zeros((len(off) - 1, len(self.languages)))
        for k in range(len(self.languages)):
            running = np.concatenate([[0.0], np.cumsum(scores[inverse, k], dtype=np.float64)])
            out[:, k] = running[rows[1:]] - running[rows[:-1]]
        return out, np.diff(rows)


def tallies(language: str, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """lang, size, key, n of the words at starts (their hashes are keys), met ``times`` times, and of their n-grams."""
    code, wide = Model._marked(buf, starts, ends)
    weights = np.repeat(times, np.diff(wide))
    found = [(keys, times)]
    for grams, some in _grams(code, wide):
        known, at = np.unique(grams[some], return_inverse=True)
        found.append((known, np.bincount(at, weights[some], len(known)).astype(np.int64)))
    sizes = np.repeat(np.arange(len(found), dtype=np.int32), [len(k) for k, _ in found])
    key, n = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    return pa.RecordBatch.from_pydict({"lang": pa.array([language] * len(key), pa.string()), "size": pa.array(sizes), "key": pa.array(key.view(np.int64)), "n": pa.array(n, pa.int64())})


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from text and lang of documents that are not held out, ``sample`` of each language at most."""
    ship(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = known.groupBy("lang").count().collect()  # one row for each language
    if not counts:
        return Model([], None)
    limits = F.create_map(*(F.lit(x) for lang, n in counts for x in (lang, (2**63 - 1) * min(sample, n) // n)))
    known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) <= F.element_at(limits, F.col("lang")))

    def count(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            buf, off = tb.as_bytes(batch.column("text"))
            for i, j in tb.chunks(off):
                low = tb.lower_latin(buf[off[i] : off[j]])
                starts, ends, rows = tb.word_spans(low, off[i : j + 1] - off[i], tb.NOT_LETTER)
                hashes = tb.span_hashes(low, starts, ends)
                names, of = np.unique(langs[i:j].astype(str), return_inverse=True)
                of = np.repeat(of, np.diff(rows))
                for k, name in enumerate(names):
                    mine = np.flatnonzero(of == k)
                    keys, first, times = np.unique(hashes[mine], return_index=True, return_counts=True)
                    first = mine[first]
                    yield tallies(str(name), low, starts[first], ends[first], keys, times)

    counted = known.select("text", "lang").mapInArrow(count, "lang string, size int, key long, n long").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # hashes and counts of the sample's words and n-grams
    return Model(sorted(set(table.column("lang").unique().to_pylist())), table)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of docs."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            for i, j in tb.chunks(off):
                part, local = buf[off[i] : off[j]], off[i : j + 1] - off[i]
                label = np.full(j - i, "und", object)
                score = np.zeros(j - i)
                if m.languages:
                    total, words = m.score(part, local)
                    total = total / np.sqrt(np.maximum(words, 1))[:, None]
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    best = total.argmax(axis=1)
                    some = words > 0
                    ascii_letters = np.concatenate([[0], np.cumsum((part | 32) - 97 < 26)])
                    for r in np.flatnonzero(some & (ascii_letters[local[1:]] == ascii_letters[local[:-1]])):
                        some[r] = any(c.isalpha() for c in part[local[r] : local[r + 1]].tobytes().decode("utf-8", "replace"))
                    label[some] = np.array(m.languages, object)[best[some]]
                    score[some] = (odds.max(axis=1) / odds.sum(axis=1))[some]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], batch.column("held_out")[i:j], pa.array(label, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
