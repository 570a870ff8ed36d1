"""Token-ID output: frequency-ranked ids, byte-aligned lengths in control bytes.

A block holds whole documents in order. Its layout, all little-endian:

    magic "FRB1", then int64 documents, ids, distinct ids, data bytes
    uint32 x distinct   the ids, from most to least frequent (ties: smaller id)
    int64 x documents   doc_id;  uint8 x documents  1 where doc_id is null
    int64 x documents   ids of each document
    uint8 x ceil(ids/4) control bytes: four 2-bit lengths less one, first lowest
    uint8 x data bytes  each id's rank in as many bytes as its length

Blocks are carried as rows of a Parquet folder, which every store that Spark
reaches can hold. Readers look control bytes up in a table of lengths.

Defined cases: a null text is empty and has only the end id; documents are in
ascending doc_id, null first, equal ids ordered by text, so repeated rows follow each
other; a text of any length is read whole and lies in one block; extra columns are
ignored; an empty table gives no blocks and an empty result.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textblocks as tb
from .staging import Stages, shuffle_width
from .unitcache import UnitCache

MAGIC = b"FRB1"
#: Lengths of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack(doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One block of documents' ids."""
    distinct, inverse, times = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((distinct, -times))
    rank = np.empty(len(distinct), np.uint32)
    rank[order] = np.arange(len(distinct), dtype=np.uint32)
    values = rank[inverse]
    sizes = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    control[: len(values)] = sizes - 1
    control = (control.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    at = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(4):
        has = sizes > k
        data[at[has] + k] = (values[has] >> np.uint32(8 * k)) & np.uint32(0xFF)
    head = np.array([len(doc_ids), len(ids), len(distinct), len(data)], "<i8")
    return b"".join([MAGIC, head.tobytes(), distinct[order].astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), counts.astype("<i8").tobytes(), control.tobytes(), data.tobytes()])


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, nulls, counts and ids of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, n, distinct, size = (int(x) for x in np.frombuffer(block, "<i8", 4, 4))
    at = 36

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, kind, count, at)
        at += out.nbytes
        return out

    table, doc_ids, nulls, counts = take("<u4", distinct), take("<i8", docs), take("u1", docs), take("<i8", docs)
    control, data = take("u1", -(-n // 4)), take("u1", size)
    sizes = LENGTHS[control].ravel()[:n]
    where = np.cumsum(sizes) - sizes
    padded = np.append(data, np.zeros(4, np.uint8)).astype(np.uint32)
    values = padded[where]
    for k in range(1, 4):
        if (has := sizes > k).any():
            values = values | np.where(has, padded[np.minimum(where + k, len(data))] << np.uint32(8 * k), np.uint32(0))
    return doc_ids, nulls.astype(bool), counts, table[values] if n else np.zeros(0, np.uint32)


def lower_ascii_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """buf with words of ASCII only in lower case, as the tokenizer puts them itself."""
    high = np.concatenate([[0], np.cumsum(buf >= 128)])
    wide = np.flatnonzero(high[ends] > high[starts])
    low = tb.LOWER[buf]
    mark = np.zeros(len(buf) + 1, np.int32)
    mark[starts[wide]] += 1
    mark[ends[wide]] -= 1
    keep = np.cumsum(mark)[:-1] > 0
    low[keep] = buf[keep]
    return low


class WordTokenizer:
    """A tokenizers-library file, called once for each distinct word.

    Its normaliser and splitter never join text across ASCII white space, so the
    ids of a text are those of its words; nor do they depend on what follows a run of
    ASCII letters, nor on the case of ASCII words. Words that hold an added token, in
    any case, go to the library whole and as they are.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.added = [t.content.lower().encode() for t in self.library.get_added_tokens_decoder().values()]
        self.cache = UnitCache(self.tokenize)

    def tokenize(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [u.decode("utf-8", "replace") for u in units]
        ids, counts = [], []
        for a in range(0, len(texts), 5000):
            for e in self.library.encode_batch_fast(texts[a : a + 5000], add_special_tokens=False):
                ids.extend(e.ids)
                counts.append(len(e.ids))
        return np.array(ids, np.uint32), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def holding_added(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The words that hold an added token in any case."""
        text, words = tb.LOWER[buf].tobytes(), []
        for token in self.added:
            at = text.find(token)
            while at >= 0:
                words.append(int(np.searchsorted(starts, at, "right")) - 1)
                at = text.find(token, int(ends[words[-1]]))
        return np.unique(np.array(words, np.int64))

    def encode(self, buf: np.ndarray, off: np.ndarray):
        """(first row, last row, ids, each row's offset into them) for chunks of the rows at off."""
        spans, parts = list(tb.chunks(off)), []
        for i, j in spans:
            part, local = buf[off[i] : off[j]], off[i : j + 1] - off[i]
            starts, ends, _ = tb.word_spans(part, local)
            low = lower_ascii_words(part, starts, ends)
            whole = self.holding_added(part, starts, ends)
            for w in whole:
                low[starts[w] : ends[w]] = part[starts[w] : ends[w]]
            cut = np.flatnonzero(tb.ASCII_LETTER[part[:-1]] & tb.ASCII_OTHER[part[1:]]) + 1
            cut = cut[~np.isin(cut, local)]  # where one text ends and the next begins is no cut within a word
            cut = cut[~np.isin(np.searchsorted(starts, cut, "right") - 1, whole)]
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
            parts.append((low, starts, ends, np.searchsorted(starts, local)))
        for (i, j), (ids, at), part in zip(spans, self.cache.encode([p[:3] for p in parts]), parts):
            yield i, j, ids, at[part[3]]


@lru_cache(maxsize=2)
def load(vocabulary: str) -> WordTokenizer:
    return WordTokenizer(vocabulary)


def write_token_files(docs: DataFrame, path: str, out: str, end_id: int = 1) -> None:
    """Encode docs in ascending doc_id order and write blocks to the folder ``out``.

    path: a tokenizer file that the driver can open; workers get its content.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    Stages(spark)  # ships the package

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words, shard, block, start = load(vocabulary.value), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            keys = batch.column("doc_id").cast(pa.int64())
            nulls = np.asarray(keys.is_null())
            keys = keys.fill_null(0).to_numpy()
            rows = []
            for i, j, ids, at in words.encode(buf, off):
                counts = np.diff(at) + 1
                ends = np.insert(ids, at[1:], end_id)
                rows.append({"shard": shard, "block": block, "start": start, "n_ids": len(ends), "payload": pack(keys[i:j], nulls[i:j], counts, ends)})
                block, start = block + 1, start + len(ends)
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, "shard int, block int, start long, n_ids long, payload binary").write.option("compression", "none").parquet(out)


def read_token_files(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids array<int>) of each document in the folder."""
    blocks = spark.read.schema("shard int, block int, start long, n_ids long, payload binary").parquet(out)
    totals = sorted(blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())  # one row for each file
    starts, before = [], 0
    for shard, n in totals:
        starts.append((shard, before))
        before += n
    offsets = spark.createDataFrame(starts, "shard int, before long")

    def run(batches):
        for batch in batches:
            for before, start, payload in zip(*(batch.column(c) for c in ("before", "start", "payload"))):
                doc_ids, nulls, counts, ids = unpack(payload.as_py())
                ends = np.cumsum(counts)
                begins = ends - counts
                raw = ids.astype("<u4").tobytes()
                columns = [
                    pa.array(doc_ids, pa.int64(), mask=nulls),
                    pa.array(begins + before.as_py() + start.as_py(), pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.join(F.broadcast(offsets), "shard").select("before", "start", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
