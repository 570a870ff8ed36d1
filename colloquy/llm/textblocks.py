"""Vectorised byte-level text primitives shared by the corpus operators.

Arrow string columns are viewed as one byte buffer plus row offsets; words and
hashes are then computed for whole chunks with numpy, never row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: White space that separates words: space and \t \n \v \f \r.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes outside letters, digits and multi-byte characters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False

#: Bytes outside letters and multi-byte characters.
NOT_LETTER = NOT_ALNUM.copy()
NOT_LETTER[48:58] = True

#: ASCII letters, and the other ASCII bytes that are no white space: a tokenizer's letter run ends between them.
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
ASCII_OTHER = ~ASCII_LETTER & ~WHITE
ASCII_OTHER[128:] = False

#: Bytes handled at once, so that temporaries stay near 100 MB.
CHUNK_BYTES = 3 << 20

#: Spans of more bytes than this are hashed one by one.
LONG_SPAN = 256

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (grown on demand)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1024)
        _powers.clear()
        for base in (_BASE, _BASE_INV):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=np.uint64))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xCA5A826395121157)
    return h ^ (h >> np.uint64(32))


def as_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"" if kind == pa.large_binary() else "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def chunks(off: np.ndarray, limit: int = 0) -> Iterator[tuple[int, int]]:
    """Row ranges of at most CHUNK_BYTES; a longer row is a range by itself."""
    limit = limit or CHUNK_BYTES
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of rows at ``off`` (off[0] == 0), and each row's word offsets.

    white: which byte values separate words.
    """
    n = len(off) - 1
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    white = white[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[1:] = white
    edge[off[off <= len(buf)]] = True
    starts = np.flatnonzero(~white & edge[:-1])
    edge[:-1] = white
    edge[-1] = True
    edge[off[off <= len(buf)]] = True  # edge[i]: a word that reaches i ends there
    ends = np.flatnonzero(~white & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    out = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_SPAN):  # a polynomial modulo 2**64 is weak on long regular spans
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return out


def lower_latin(buf: np.ndarray) -> np.ndarray:
    """Lower case of ASCII letters and of the Latin-1 letters of UTF-8."""
    buf = LOWER[buf]
    upper = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
    buf[upper] += 32
    return buf


def word_hashes(buf: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of rows ``off`` in order, and each row's word offsets."""
    if lower:
        buf = LOWER[buf]
    starts, ends, rows = word_spans(buf, off)
    return span_hashes(buf, starts, ends), rows


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each word (the last k - 1 have none)."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    factor = 1
    for j in range(k):
        factor = factor * _BASE % (1 << 64)
        total += words[j : j + m] * np.uint64(factor)
    return mix(total)


def whole(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence, for one shorter than a shingle."""
    return grams(words, len(words))[0] ^ np.uint64(len(words))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingle hashes; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([whole(words)], np.uint64)
    return distinct(grams(words, k))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def list_array(parts: list[np.ndarray], kind=None):
    """One Arrow list per array of ``parts``."""
    sizes = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=sizes[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, kind))
