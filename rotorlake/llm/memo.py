"""A worker's memory of encoded parts of texts, kept in numpy arrays.

Parts are found by a 64-bit hash of their bytes. Equal parts are encoded once; the ids of a whole piece are put
together by array operations. The memory is emptied when it holds ``max_parts`` or ``max_bytes`` of ids, and parts
longer than ``LONG_PART`` are encoded each time and never kept; results do not depend on any of it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from rotorlake.llm import texts

MAX_PARTS = 2_500_000
MAX_BYTES = 128 << 20
#: Longest part, in bytes, that is remembered.
LONG_PART = 256


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... of each range, side by side."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


class Memo:
    """``learn`` takes new parts and gives their ids side by side and the number of ids of each."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], max_parts: int = MAX_PARTS) -> None:
        self.learn, self.max_parts = learn, max_parts
        self._clear()

    def _clear(self) -> None:
        self.count, self.used = 0, 0
        self.slots = np.full(1 << 17, -1, np.int32)
        self.keys = np.zeros(1 << 16, np.uint64)
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.uint32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        mask = np.uint64(len(self.slots) - 1)
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        slot = (h & mask).astype(np.int64)
        while len(left):
            held = self.slots[slot]
            same = (held >= 0) & (self.keys[held] == h[left])
            out[left[same]] = held[same]
            on = (held >= 0) & ~same
            left, slot = left[on], (slot[on] + 1) & int(mask)
        return out

    def _place(self, numbers: np.ndarray) -> None:
        mask = len(self.slots) - 1
        slot = (self.keys[numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            lost = self.slots[slot] != numbers
            numbers, slot = numbers[lost], (slot[lost] + 1) & mask

    def _add(self, h: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        n = self.count + len(h)
        if n > len(self.keys):
            room = max(n, 2 * len(self.keys)) - len(self.keys)
            self.keys, self.at, self.size = (np.concatenate([x, np.zeros(room, x.dtype)]) for x in (self.keys, self.at, self.size))
        if self.used + len(ids) > len(self.pool):
            room = max(self.used + len(ids), 2 * len(self.pool)) - len(self.pool)
            self.pool = np.concatenate([self.pool, np.zeros(room, np.uint32)])
        new = slice(self.count, n)
        self.keys[new], self.size[new] = h, sizes
        self.at[new] = self.used + np.cumsum(sizes) - sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        first, self.count = self.count, n
        if 2 * n > len(self.slots):
            self.slots, first = np.full(1 << (2 * n).bit_length() + 1, -1, np.int32), 0
        self._place(np.arange(first, n))

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts of ``data`` side by side, and the number of ids of each part."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        long = ends - starts > LONG_PART
        if long.any():
            return self._with_long(data, starts, ends, long)
        h = texts.hashed(data, starts, ends, fold=False)
        if self.count > self.max_parts or 4 * self.used > MAX_BYTES:
            self._clear()
        number = self._find(h)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, where = np.unique(h[missing], return_index=True)
            where = missing[where]
            raw = data.tobytes()
            ids, sizes = self.learn([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            self._add(new, ids, sizes)
            number[missing] = self._find(h[missing])
        sizes = self.size[number].astype(np.int64)
        return self.pool[ranges(self.at[number], sizes)], sizes

    def _with_long(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.zeros(len(starts), np.int64)
        short, sizes[~long] = self.ids(data, starts[~long], ends[~long])
        whole, sizes[long] = self.learn([data[a:b].tobytes() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)])
        out, first = np.empty(int(sizes.sum()), np.uint32), np.cumsum(sizes) - sizes
        out[ranges(first[~long], sizes[~long])] = short
        out[ranges(first[long], sizes[long])] = whole
        return out, sizes
