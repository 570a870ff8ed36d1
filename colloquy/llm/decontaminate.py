"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every n-gram of a test item is a seed. A choice of the rarest would lose copies:
n-grams that no document holds are rarest of all, and beside a whole copy the
n-grams that an edited copy keeps are the more frequent ones. Where several seeds
of one item meet a document, the passage around them is aligned to the item word by
word (match +2, mismatch -1, gap -1), so that paraphrased and edited copies score
high as well. A document is contaminated by an item if the best local alignment
reaches ``ratio`` of the item's score against itself; a copy that keeps fewer than
``least_seeds`` of the item's n-grams is not met.

Items are taken in blocks of at most BLOCK_ITEMS, so what a task holds never grows
with the number of items; more items mean more passes.

Defined cases: null and empty texts, and items without words, match nothing; an
item shorter than n words is one seed; a text of any length is read whole, by one
task; of passages that tie, the first is reported; repeated rows each report; a null
doc_id is reported as null; extra columns are ignored; without documents the result
is empty, and without items no document is contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import textblocks as tb

#: Items whose n-grams one pass holds.
BLOCK_ITEMS = 20_000
#: Words of an alignment matrix row handled at once.
WIDEST = 1 << 20


def _words(texts: list[str | None]) -> list[np.ndarray]:
    buf, off = tb.as_bytes(pa.array(texts, pa.string()))
    low = tb.lower_latin(buf)
    starts, ends, rows = tb.word_spans(low, off - off[0] if len(off) else off, tb.NOT_ALNUM)
    h = tb.span_hashes(low, starts, ends)
    return [h[a:b] for a, b in zip(rows, rows[1:])]


class Seeds:
    """Seeds of a block of items: sorted n-gram hashes, and the items and places of each."""

    def __init__(self, ids: list, texts: list[str | None], n: int):
        self.n = n
        kept = [(i, w) for i, w in zip(ids, _words(texts)) if len(w)]
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        grams, item, place = [], [], []
        for k, w in enumerate(self.words):
            g = tb.grams(w, n) if len(w) >= n else np.zeros(0, np.uint64)
            grams.append(g)
            item.append(np.full(len(g), k))
            place.append(np.arange(len(g)))
        grams, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (grams, item, place))
        self._sort(grams.astype(np.uint64), item, place)
        #: Items shorter than n words, by their whole sequence.
        self.short = [(k, w) for k, w in enumerate(self.words) if len(w) < n]

    def _sort(self, grams, item, place) -> None:
        order = np.lexsort((place, item, grams))
        self.grams, self.item, self.place = grams[order], item[order], place[order]
        self.keys, self.first, counts = np.unique(self.grams, return_index=True, return_counts=True)
        self.size = counts
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in g that hold a key, and which key."""
        at = np.flatnonzero(self.filter[(g >> np.uint64(44)).astype(np.int64)])
        key = np.searchsorted(self.keys, g[at])
        ok = key < len(self.keys)
        ok[ok] = self.keys[key[ok]] == g[at[ok]]
        return at[ok], key[ok]


def align(item: np.ndarray, passages: list[np.ndarray]) -> list[tuple[int, int]]:
    """Best local alignment score of item against each passage, and the word where it ends.

    One matrix row at a time for all passages: a run of gaps along a row is a
    running maximum of score plus position.
    """
    out: list[tuple[int, int]] = []
    a = 0
    while a < len(passages):
        b, width = a + 1, len(passages[a])
        while b < len(passages) and max(width, len(passages[b])) * (b - a + 1) <= WIDEST:
            width = max(width, len(passages[b]))
            b += 1
        block = np.zeros((b - a, width), np.uint64)
        filled = np.zeros((b - a, width), bool)
        for r, p in enumerate(passages[a:b]):
            block[r, : len(p)] = p
            filled[r, : len(p)] = True
        column = np.arange(width, dtype=np.int32)
        above = np.zeros((b - a, width + 1), np.int32)
        best = np.zeros((b - a, width), np.int32)
        for w in item:
            row = above[:, :-1] + np.where((block == w) & filled, 2, -1)
            np.maximum(row, above[:, 1:] - 1, out=row)
            np.maximum(row, 0, out=row)
            row = np.maximum.accumulate(row + column, axis=1) - column
            above[:, 1:] = row
            np.maximum(best, row, out=best)
        at = best.argmax(axis=1) if width else np.zeros(b - a, int)
        out.extend((int(best[r, c]), int(c)) if width else (0, 0) for r, c in enumerate(at))
        a = b
    return out


def _document_words(buf: np.ndarray, off: np.ndarray):
    low = tb.lower_latin(buf)
    starts, ends, rows = tb.word_spans(low, off, tb.NOT_ALNUM)
    return tb.span_hashes(low, starts, ends), rows


def _contained(words: np.ndarray, rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows that hold the whole short sequence w."""
    at = np.flatnonzero(words[: len(words) - len(w) + 1] == w[0]) if len(words) >= len(w) else np.zeros(0, np.int64)
    for k in range(1, len(w)):
        at = at[words[at + k] == w[k]]
    row = np.searchsorted(rows, at, "right") - 1
    return np.unique(row[at + len(w) <= rows[row + 1]])


def _matches(s: Seeds, batch: pa.RecordBatch, ratio: float, least_seeds: int):
    """(row, item, score, seeds, end word) of each contaminated row of the batch."""
    buf, off = tb.as_bytes(batch.column("text"))
    for i, j in tb.chunks(off):
        words, rows = _document_words(buf[off[i] : off[j]], off[i : j + 1] - off[i])
        at, key = s.hits(tb.grams(words, s.n))
        row = np.searchsorted(rows, at, "right") - 1
        inside = at + s.n <= rows[row + 1]
        at, key, row = at[inside], key[inside], row[inside]
        # each hit with every item and place of its n-gram
        sizes = s.size[key]
        where = np.arange(sizes.sum()) + np.repeat(s.first[key] - (np.cumsum(sizes) - sizes), sizes)
        row, at, item, place = np.repeat(row, sizes), np.repeat(at, sizes), s.item[where], s.place[where]
        order = np.lexsort((at, row, item))
        row, at, item, place = row[order], at[order], item[order], place[order]
        starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))) if len(row) else []
        waiting: dict[int, list[tuple[int, int, int, int, int]]] = {}
        for a, b in zip(starts, [*starts[1:], len(row)]):
            length = len(s.words[item[a]])
            have = len(np.unique(place[a:b]))
            if have < min(least_seeds, length - s.n + 1):
                continue
            slack = length // 2 + s.n
            left, right = np.sort(at[a:b] - place[a:b] - slack), np.sort(at[a:b] - place[a:b] + length + slack)
            cut = np.flatnonzero(left[1:] > right[:-1]) + 1
            for u, v in zip([0, *cut], [*cut, b - a]):
                lo, hi = max(int(left[u]), int(rows[row[a]])), min(int(right[v - 1]), int(rows[row[a] + 1]))
                waiting.setdefault(int(item[a]), []).append((int(row[a]), lo, hi, have, int(rows[row[a]])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k, spans in waiting.items():
            spans.sort(key=lambda x: x[2] - x[1])
            for (r, lo, _, have, base), (score, end) in zip(spans, align(s.words[k], [words[lo:hi] for _, lo, hi, _, _ in spans])):
                if score > best.get((r, k), (0, 0, 0))[0]:
                    best[r, k] = (score, have, lo + end - base)
        for k, w in s.short:
            for r in _contained(words, rows, w):
                best[int(r), k] = (2 * len(w), 1, -1)
        for (r, k), (score, have, end) in sorted(best.items()):
            if score >= ratio * 2 * len(s.words[k]):
                yield i + r, k, score, have, end


def _blocks(items: DataFrame, n: int):
    """The items' seeds, BLOCK_ITEMS of them at most at a time."""
    blocks = max(1, -(-items.count() // (BLOCK_ITEMS // 2)))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text").collect()  # a block
        yield Seeds([r[0] for r in rows], [r[1] for r in rows], n)


def contaminated(docs: DataFrame, items: DataFrame, n: int = 3, ratio: float = 0.5, least_seeds: int = 2) -> DataFrame:
    """doc_id, item_id, score, ratio, n_seeds, end_word of each contaminated document and item.

    docs: doc_id, text; items: item_id, text.
    """
    sc = docs.sparkSession.sparkContext
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def one(seeds) -> DataFrame:
        def match(batches):
            s = seeds.value
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                out = {c: [] for c in ("doc_id", "item_id", "score", "ratio", "n_seeds", "end_word")}
                for r, k, score, have, end in _matches(s, batch, ratio, least_seeds):
                    for c, v in zip(out, (ids[r], s.ids[k], score, score / (2 * len(s.words[k])), have, end)):
                        out[c].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32()))], list(out))

        return docs.mapInArrow(match, "doc_id long, item_id long, score int, ratio double, n_seeds int, end_word int")

    found = None
    for seeds in _blocks(items, n):
        part = one(sc.broadcast(seeds))
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, items: DataFrame, n: int = 3, ratio: float = 0.5, least_seeds: int = 2) -> DataFrame:
    """The rows of docs, whatever their doc_id, that no item contaminates: a scan without a shuffle."""
    sc = docs.sparkSession.sparkContext
    ship(docs.sparkSession)

    def one(seeds):
        def keep(batches):
            s = seeds.value
            for batch in batches:
                fine = np.ones(batch.num_rows, bool)
                fine[[r for r, *_ in _matches(s, batch, ratio, least_seeds)]] = False
                yield batch.filter(pa.array(fine))

        return keep

    for seeds in _blocks(items, n):
        docs = docs.mapInArrow(one(sc.broadcast(seeds)), docs.schema)
    return docs
