"""Token ids by text unit: each distinct unit is tokenized once for each worker.

A unit is a stretch of text whose tokens do not depend on its surroundings. The
cache is a sorted array of unit hashes beside a ragged array of ids, so that
units of whole chunks are looked up and assembled with numpy.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import textblocks as tb

#: Units kept for each worker (about 90 MB); beyond that it starts anew.
CACHE_UNITS = 1 << 21


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices flat[starts : starts + sizes], one after another, and their offsets."""
    off = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=off[1:])
    return flat[np.arange(off[-1]) + np.repeat(starts - off[:-1], sizes)], off


class UnitCache:
    def __init__(self, tokenize: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        """tokenize: units to their flat ids and offsets."""
        self.tokenize = tokenize
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (buf, starts, ends): ids of its units in order, and each unit's offset into them.

        Units of all parts that are not known yet are tokenized together.
        """
        if len(self.keys) > CACHE_UNITS:
            self.clear()
        hashed, new_keys, new_units = [], [], []
        for buf, starts, ends in parts:
            keys, first, inverse = np.unique(tb.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
            hashed.append((keys, inverse.astype(np.int32)))
            missing = np.flatnonzero(~self._known(keys))
            if len(missing):
                data = buf.tobytes()
                new_keys.append(keys[missing])
                new_units.extend([data[s:e] for s, e in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist())])
        if new_units:
            keys, first = np.unique(np.concatenate(new_keys), return_index=True)
            ids, off = self.tokenize([new_units[i] for i in first.tolist()])
            where = np.searchsorted(self.keys, keys)
            self.starts = np.insert(self.starts, where, off[:-1] + len(self.ids))
            self.sizes = np.insert(self.sizes, where, np.diff(off))
            self.keys = np.insert(self.keys, where, keys)
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        out = []
        for keys, inverse in hashed:
            at = np.searchsorted(self.keys, keys)[inverse]
            out.append(ragged(self.ids, self.starts[at], self.sizes[at]))
        return out

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return known
