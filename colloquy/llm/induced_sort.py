"""Suffix order and common prefixes of a shard by external induced sorting.

Left-most S suffixes are named by their substrings, ranked by pairing names over
doubling distances, and seed two inductions: L suffixes from small symbols to
large, then S suffixes from large to small. Each induction is a priority queue
keyed by (symbol, order of arrival); since arrival order is already rank order,
the queue is one first-in-first-out file per symbol. Entries carry the suffix and
its common prefix with the entry before, so common prefixes are induced together
with the order: that of two neighbours in a queue is one more than the least one
between their sources. Queues spill to disk beyond SPILL_ENTRIES.

Order and common prefixes are exact up to ``depth`` symbols, which is all that
finding repeats of that length needs.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np

#: Entries that all queues of one sort hold in memory.
SPILL_ENTRIES = 8 << 20
#: Largest number of entries processed at once.
BATCH = 1 << 20
#: Symbols that one 63-bit key holds, and the bits of each.
PACK, BITS = 7, 9
END = (1 << BITS) - 1


class Queues:
    """A queue of (suffix, common prefix) for each symbol, on disk beyond a size."""

    def __init__(self, symbols: int, folder: Path, limit: int):
        self.folder, self.limit, self.held = folder, limit, 0
        self.chunks: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(symbols)]
        self.files: list[Path | None] = [None] * symbols
        self.size = [0] * symbols
        folder.mkdir()

    def push(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        self.chunks[symbol].append((places, common))
        self.size[symbol] += len(places)
        self.held += len(places)
        if self.held > self.limit:
            for s, parts in enumerate(self.chunks):
                if parts:
                    self.files[s] = self.files[s] or self.folder / f"{s}"
                    with self.files[s].open("ab") as f:
                        for p, c in parts:
                            block = np.empty(len(p), [("p", np.uint32), ("c", np.uint16)])
                            block["p"], block["c"] = p, c
                            f.write(block.tobytes())
                    self.chunks[s] = []
            self.held = 0

    def batches(self, symbol: int):
        """All entries in order of arrival, those that come meanwhile included; leaves them in place."""
        done, chunk, on_disk = 0, 0, 0  # entries given, chunks in memory given, entries on disk when last seen
        while done < self.size[symbol]:
            flushed = self.files[symbol].stat().st_size // 6 if self.files[symbol] else 0
            if flushed != on_disk:
                on_disk, chunk = flushed, 0  # what was in memory is on disk now
            if done < on_disk:
                block = np.fromfile(self.files[symbol], [("p", np.uint32), ("c", np.uint16)], BATCH, offset=6 * done)
                p, c = block["p"], block["c"]
            else:
                parts, n = [], 0
                while chunk < len(self.chunks[symbol]) and n < BATCH:
                    parts.append(self.chunks[symbol][chunk])
                    n += len(parts[-1][0])
                    chunk += 1
                p, c = parts[0] if len(parts) == 1 else (np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))
            done += len(p)
            yield p, c

    def all(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts = list(self.batches(symbol))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.uint16)
        return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


class _Least:
    """Least value of any range, by doubling windows."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of values[first : last + 1] for each range."""
        out = np.empty(len(first), self.levels[0].dtype)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            some = level == k
            table = self.levels[k]
            out[some] = np.minimum(table[first[some]], table[last[some] - (1 << int(k)) + 1])
        return out


def pack(text: np.ndarray) -> np.ndarray:
    """The PACK symbols that start at each place as one number."""
    padded = np.concatenate([text, np.zeros(PACK, text.dtype)]).astype(np.int64)
    out = np.zeros(len(text), np.int64)
    for k in range(PACK):
        out = (out << BITS) | padded[k : k + len(text)]
    return out


def common_prefix(packed: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Symbols, up to depth, that the suffixes at a and b share."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    a, b = a.astype(np.int64), b.astype(np.int64)
    at = 0
    while len(live) and at < depth:
        inside = (a[live] + at < len(packed)) & (b[live] + at < len(packed))
        live = live[inside]
        x = packed[a[live] + at] ^ packed[b[live] + at]
        differ = x != 0
        where = live[differ]
        out[where] = at + PACK - 1 - (np.frexp(x[differ].astype(np.float64))[1] - 1) // BITS
        live = live[~differ]
        at += PACK
        out[live] = at
    return np.minimum(out, depth)


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Rank of each row of keys (first most significant), equal rows equal, from 1."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def _seeds(text: np.ndarray, packed: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Left-most S places in the order of their suffixes, exact up to depth."""
    lengths = np.diff(np.append(starts, len(text) - 1)) + 1
    rank = np.ones(len(starts), np.int64)
    step = 0
    live = np.arange(len(starts))
    while len(live):  # name each substring, PACK symbols at a time; one that has ended comes after one that goes on
        at = starts[live] + step * PACK
        key = np.where(at < len(text), packed[np.minimum(at, len(text) - 1)], 0)
        left = lengths[live] - step * PACK
        short = left < PACK
        cut = BITS * (PACK - np.maximum(left[short], 0))
        key[short] = (key[short] >> cut << cut) | ((np.int64(1) << cut) - 1)
        full = np.full(len(starts), (1 << (BITS * PACK)) - 1, np.int64)
        full[live] = key
        rank = _dense(rank, full)
        live = live[left > PACK]
        if len(live):
            counts = np.bincount(rank)
            live = live[counts[rank[live]] > 1]
        step += 1
    span = 1
    while 2 * span < depth and rank.max(initial=0) < len(rank):
        later = np.zeros(len(rank), np.int64)
        later[:-span] = rank[span:]
        rank = _dense((rank << 32) | later)
        span *= 2
    return starts[np.argsort(rank, kind="stable")]


def suffix_order(text: np.ndarray, depth: int, limit: int = SPILL_ENTRIES, folder: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of text in order, and each one's common prefix with the one before (up to depth).

    text: symbols 1 to 510, small integers.
    """
    n = len(text) + 1
    text = np.append(text, 0).astype(np.uint16)
    if n == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = int(text.max()) + 1
    place = np.arange(n)
    change = np.append(text[1:] != text[:-1], True)
    following = np.minimum.accumulate(np.where(change, place, n)[::-1])[::-1]  # where the run of equal symbols ends
    small = np.zeros(n, bool)
    inner = following < n - 1
    small[inner] = text[following[inner]] < text[following[inner] + 1]
    small[n - 1] = True
    seed_at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    del place, change, following, inner
    packed = pack(text)
    seeds = _seeds(text, packed, seed_at, depth)
    seed_common = np.zeros(len(seeds), np.uint16)
    seed_common[1:] = common_prefix(packed, seeds[:-1], seeds[1:], depth)
    seed_off = np.searchsorted(text[seeds], np.arange(symbols + 1))
    root = Path(tempfile.mkdtemp(dir=folder))
    try:
        large, little = Queues(symbols, root / "l", limit), Queues(symbols, root / "s", limit)

        def induce(to: Queues, want_small: bool, p: np.ndarray, c: np.ndarray, since: np.ndarray) -> None:
            """Push the places before p of the wanted type. since: least common prefix after each queue's last source."""
            p = p.astype(np.int64)
            before = p - 1
            ok = np.flatnonzero((p > 0) & (small[before] == want_small))
            if not len(ok):
                np.minimum(since, c.min(), out=since)
                return
            target = text[before[ok]]
            order = np.argsort(target, kind="stable")
            source, target = ok[order], target[order]
            head = np.append(True, target[1:] != target[:-1])
            least = _Least(c)
            value = least.of(np.where(head, 0, np.append(0, source[:-1] + 1)), source)
            first = np.flatnonzero(head)
            value[first] = np.minimum(value[first], since[target[first]])
            value = np.minimum(value.astype(np.int64) + 1, depth).astype(np.uint16)
            np.minimum(since, c.min(), out=since)
            tail = np.append(first[1:] - 1, len(source) - 1)
            last = source[tail]
            rest = np.full(len(last), depth, np.uint16)
            more = last + 1 < len(c)
            rest[more] = least.of(last[more] + 1, np.full(more.sum(), len(c) - 1))
            since[target[first]] = rest
            for a, b in zip(first, tail + 1):
                to.push(int(target[a]), before[source[a:b]].astype(np.uint32), value[a:b])

        def runs(p: np.ndarray, c: np.ndarray):
            for a in range(0, len(p), BATCH):
                yield p[a : a + BATCH], c[a : a + BATCH]

        link = lambda a, b: common_prefix(packed, np.array([a]), np.array([b]), depth).astype(np.uint16)
        for s in range(symbols):
            since = np.zeros(symbols, np.uint16)
            last = -1
            for p, c in large.batches(s):
                induce(large, False, p, c, since)
                last = p[-1]
            p, c = seeds[seed_off[s] : seed_off[s + 1]], seed_common[seed_off[s] : seed_off[s + 1]].copy()
            if len(p):
                if s == 0:
                    since[:] = 0
                c[0] = link(last, p[0])[0] if last >= 0 else 0
                for q in runs(p, c):
                    induce(large, False, *q, since)
        for s in range(symbols - 1, -1, -1):
            since = np.zeros(symbols, np.uint16)
            last = -1
            for p, c in little.batches(s):
                induce(little, True, p, c, since)
                last = p[-1]
            p, c = large.all(s)
            if len(p):
                back = np.append(c[1:], np.uint16(0))[::-1].copy()  # with the entry after, from the last one on
                back[0] = link(last, p[-1])[0] if last >= 0 else 0
                for q in runs(p[::-1], back):
                    induce(little, True, *q, since)
        order, common = [], []
        for s in range(1, symbols):
            p, c = large.all(s)
            q, d = little.all(s)
            if len(q):
                q, d = q[::-1], np.append(np.uint16(0), d[::-1][:-1]) if len(d) > 1 else np.zeros(1, np.uint16)
                if len(p):
                    d = d.copy()
                    d[0] = link(p[-1], q[0])[0]
            if len(p):
                c = c.copy()
                c[0] = 0
            order += [p, q]
            common += [c, d]
        return np.concatenate(order).astype(np.int64), np.concatenate(common).astype(np.int64)
    finally:
        shutil.rmtree(root, ignore_errors=True)
