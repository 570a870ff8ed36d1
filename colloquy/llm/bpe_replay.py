"""Byte-level BPE by merge replay over the distinct pieces of many texts.

Texts are cut into units at white space, each distinct unit is split by the
tokenizer's pattern, and all distinct pieces that a worker has not met are
encoded together: an inverted index leads from a token pair to its positions in
all those pieces, and merges are applied in rank order, each touching only its
neighbours. Ids are then gathered for every text and decoded by table lookup.

Defined cases: a null text is empty and has no ids; special tokens' strings are
ordinary text; a text of any length is read whole, by one task; ties of rank cannot
be, for ranks are distinct; repeated rows each return a row; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import textblocks as tb
from .unitcache import UnitCache, ragged

#: UTF-8 of white space that does not separate words here; texts with it are split whole.
RARE_WHITE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

#: Bytes of distinct pieces replayed together.
REPLAY_BYTES = 4 << 20


class MergeReplay:
    """Encodes and decodes with the ranks of one vocabulary file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.cuts = r"\s+(?!\S)" in pattern and r"\p{L}" in pattern
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        size = max(ranks.values()) + 1
        self.pieces = [b""] * size
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(ranks[p[:i]] << 32 | ranks[p[i:]], r) for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks]
        table = np.array(sorted(merges), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = table[:, 0].copy(), table[:, 1].astype(np.int32)
        #: Tokens whose merge with a neighbour comes before their own in rank.
        self.overtaken = np.zeros(size, bool)
        for side in (self.pair_keys >> 32, self.pair_keys & 0xFFFFFFFF):
            self.overtaken[side[self.pair_ranks < side]] = True
        self.cache = UnitCache(self.tokenize)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two tokens, -1 if there is none."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1).astype(np.int32)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all pieces and their offsets; all merges of all pieces in rank order.

        token: the token that starts at a byte, or -1 at a piece's end and inside a
        token; pair: rank of the merge that starts there; after, before: the
        neighbouring tokens' places. index: from each rank to the places of its pairs.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        n = int(ends[-1]) + 1 if len(pieces) else 0
        token = np.full(n + 1, -1, np.int32)
        token[:n] = self.bytes[np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)[:n]]
        token[ends] = -1
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        pair = np.full(n + 1, -1, np.int32)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(places: np.ndarray) -> None:
            ranks = pair[places]
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                rank = int(ranks[a])
                if rank in index:
                    index[rank].append(places[a:b])
                else:
                    index[rank] = [places[a:b]]
                    heapq.heappush(heap, rank)

        pair[:n] = self.ranks_of(token[:n], token[1:])
        some = np.flatnonzero(pair >= 0).astype(np.int32)
        if len(some):
            note(some)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            at = places[0] if len(places) == 1 else np.concatenate(places)
            at = at[pair[at] == rank]
            if len(at) > 1:
                at.sort()
                at = at[np.append(True, at[1:] != at[:-1])]
                if self.overtaken[rank]:  # another merge may come first in a piece: only its first place now
                    word = np.searchsorted(ends, at)
                    first = np.append(True, word[1:] != word[:-1])
                    if not first.all():
                        index[rank] = [at[~first]]
                        heapq.heappush(heap, rank)
                        at = at[first]
                else:
                    touching = after[at[:-1]] == at[1:]
                    if touching.any():  # of pairs that share a token the left one goes first
                        heads = np.append(True, ~touching)
                        i = np.arange(len(at))
                        at = at[(i - np.maximum.accumulate(np.where(heads, i, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            token[at] = rank
            token[gone] = -1
            pair[gone] = -1
            beyond = after[gone]
            after[at] = beyond
            before[beyond] = at
            prev = before[at]
            prev = prev[prev >= 0]
            touched = np.concatenate([at, prev])
            right = after[touched]
            pair[touched] = np.where(right <= n, self.ranks_of(token[touched], token[np.minimum(right, n)]), -1)
            touched = touched[pair[touched] >= 0]
            if len(touched):
                note(touched)
        keep = token[:n] >= 0
        total = np.zeros(n + 1, np.int64)
        np.cumsum(keep, out=total[1:])
        off = np.zeros(len(pieces) + 1, np.int64)
        off[1:] = total[ends + 1] if len(pieces) else []
        return token[:n][keep].astype(np.uint32), off

    def tokenize(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the units, and their offsets."""
        find, number, order, counts = self.pattern.findall, {}, [], []
        for u in units:
            pieces = find(u.decode("utf-8", "replace"))
            counts.append(len(pieces))
            order.extend([number.setdefault(p, len(number)) for p in pieces])
        pieces = [p.encode() for p in number]
        sizes = np.ones(len(pieces), np.int64)
        starts = np.zeros(len(pieces), np.int64)
        flat = [np.array([self.ranks.get(p, 0) for p in pieces], np.uint32)]
        starts[:] = np.arange(len(pieces))
        unseen = [i for i, p in enumerate(pieces) if p not in self.ranks]
        a = 0
        while a < len(unseen):  # as many pieces as REPLAY_BYTES hold, and one at least
            b, held = a, 0
            while b < len(unseen) and (b == a or held + len(pieces[unseen[b]]) < REPLAY_BYTES):
                held += len(pieces[unseen[b]])
                b += 1
            ids, off = self.replay([pieces[i] for i in unseen[a:b]])
            starts[unseen[a:b]] = off[:-1] + sum(map(len, flat))
            sizes[unseen[a:b]] = np.diff(off)
            flat.append(ids)
            a = b
        order = np.array(order, np.int64)
        ids, off = ragged(np.concatenate(flat), starts[order], sizes[order])
        return ids, off[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def unit_starts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Starts of stretches that the pattern splits alike in and out of context.

        Where the pattern is not one of letter runs and of white space that joins what
        follows (its ``\\s+(?!\\S)`` and ``\\p{L}``), a text is a single stretch.

        White space joins what follows only by its last character, so a text may
        be cut where white space begins and before its last character; and where a run
        of ASCII letters ends, which every alternative of the pattern respects.
        """
        cut = np.zeros(len(buf), bool)
        heads = off[:-1][np.diff(off) > 0]
        if not self.cuts:
            cut[heads] = True
            return np.flatnonzero(cut)
        white = tb.WHITE[buf]
        cut[1:] = white[1:] & ~white[:-1]
        cut[:-1] |= white[:-1] & ~white[1:]
        cut[1:] |= tb.ASCII_LETTER[buf[:-1]] & tb.ASCII_OTHER[buf[1:]]
        ends = off[1:][np.diff(off) > 0] - 1
        cut[ends] = cut[ends] & np.where(ends > 0, ~white[ends - 1], True)  # white space at the very end stays whole
        for m in RARE_WHITE.finditer(buf.tobytes()):
            row = np.searchsorted(off, m.start(), "right") - 1
            cut[off[row] : off[row + 1]] = False
        cut[heads] = True
        return np.flatnonzero(cut)

    def encode(self, buf: np.ndarray, off: np.ndarray):
        """(first row, last row, ids, each row's offset into them) for chunks of the rows at off."""
        spans, parts = list(tb.chunks(off)), []
        for i, j in spans:
            part, local = buf[off[i] : off[j]], off[i : j + 1] - off[i]
            starts = self.unit_starts(part, local) if len(part) else np.zeros(0, np.int64)
            parts.append((part, starts, np.append(starts[1:], len(part))[: len(starts)], np.searchsorted(starts, local)))
        for (i, j), (ids, at), part in zip(spans, self.cache.encode([p[:3] for p in parts]), parts):
            yield i, j, ids, at[part[3]]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and each id's offset into them."""
        ids = ids.astype(np.int64)
        return ragged(self.flat, self.begins[ids], self.sizes[ids])


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def load(ranks: bytes, pattern: str) -> MergeReplay:
    """ranks: the content of a vocabulary file."""
    return MergeReplay({base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids array<int>) of each row of docs.

    path: a vocabulary of ranks that the driver can open; workers get its content.
    """
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        bpe = load(ranks.value, pattern)
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            for i, j, ids, at in bpe.encode(buf, off):
                text, ends = bpe.decode(ids)
                raw, data = ids.astype("<u4").tobytes(), text.tobytes()
                rows, spans = at.tolist(), ends[at].tolist()
                columns = [
                    batch.column("doc_id")[i:j].cast(pa.int64()),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(rows, rows[1:])], pa.string()),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(spans, spans[1:])], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
