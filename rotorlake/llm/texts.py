"""Texts as flat byte arrays inside Arrow batches: pieces of bounded size, words and word hashes.

A *piece* is a run of rows whose texts total about ``PIECE_BYTES``; one longer text is a piece of its own. All
functions are pure and work on UTF-8 bytes, so they give the same result wherever a row is processed.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
SLICE_BYTES = 4 << 20

# The C library keeps freed memory for itself unless it is asked; other systems have no such call.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None

_rng = np.random.default_rng(20240607)
_BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_prime_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
PRIME = np.uint64((1 << 31) - 1)
#: Longest word that is hashed by sums of powers.
LONG_BYTES = 512


def _byte_class(separators: bytes) -> np.ndarray:
    table = np.ones(256, np.bool_)
    table[list(separators)] = False
    return table


#: Words between white space: bytes other than blank and 09-0D.
SPACED = _byte_class(b" \t\n\v\f\r")
#: Words of digits, letters and non-ASCII characters (once A-Z are lower-cased).
ALNUM = np.zeros(256, np.bool_)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_FOLDED_CODES = _BYTE_CODES[_LOWER]


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for ``n`` places."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same modulo a prime."""
    if len(_prime_powers[0]) < n:
        p = int(PRIME)
        for k, base in enumerate((_BASE % p, pow(_BASE, -1, p))):
            held = np.ones(1, np.uint64)
            while len(held) < n:  # as many again, times the next power
                held = np.concatenate([held, held * np.uint64(pow(base, len(held), p)) % PRIME])
            _prime_powers[k] = held
    return _prime_powers[0], _prime_powers[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return bounds - bounds[0], data[bounds[0] : bounds[-1]]


def pieces(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, text bounds and text bytes of each piece, in row order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds, data = flat(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + max_bytes, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(at, end - at), bounds[at : end + 1] - bounds[at], data[bounds[at] : bounds[end]]
            at = end
        del batch, bounds, data
        release()


def release() -> None:
    """Give freed memory back to the system: a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _cuts(data: np.ndarray, table: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Slices of at most ``max_bytes`` that end behind a separator; a longer word makes a longer slice."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + max_bytes)
        if end < n:
            back = np.flatnonzero(~table[data[at:end]])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(~table[data[end:]])
                end = end + int(ahead[0]) + 1 if len(ahead) else n
        yield at, end
        at = end


def words(bounds: np.ndarray, data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte behind the last of each word; no word reaches into the next text."""
    inside = np.empty(len(data) + 1, np.bool_)
    inside[:-1] = table[data]
    inside[-1] = False
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z lower-cased if ``fold``; a word has the same hash everywhere.

    Sums of powers are fast but have pairs of long words with one sum, which are easy to write; words beyond
    ``LONG_BYTES`` therefore get a hash without such structure.
    """
    up, down = powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((_FOLDED_CODES if fold else _BYTE_CODES)[data] * up[: len(data)], out=total[1:])
    out = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for k in np.flatnonzero(ends - starts > LONG_BYTES).tolist():
        own = data[starts[k] : ends[k]]
        out[k] = xxhash.xxh3_64_intdigest((lower(own) if fold else own).tobytes())
    return out


class Sequences:
    """Hashes of runs of a sequence of 64-bit hashes: sums of powers by two moduli, one of them prime."""

    def __init__(self, h: np.ndarray) -> None:
        up, self.down = powers(len(h) + 1)
        start = np.zeros(1, np.uint64)
        self.total = np.concatenate([start, np.cumsum(h * up[: len(h)], dtype=np.uint64)])
        up, self.prime_down = prime_powers(len(h) + 1)
        self.prime_total = np.concatenate([start, np.cumsum(mix(h) % PRIME * up[: len(h)] % PRIME, dtype=np.uint64)])

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The hash of each run from ``first`` up to ``last``; equal runs have equal hashes wherever they are."""
        whole = mix((self.total[last] - self.total[first]) * self.down[first] + (last - first).astype(np.uint64))
        prime = (self.prime_total[last] - self.prime_total[first]) % PRIME * self.prime_down[first] % PRIME
        return mix(whole ^ prime * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(bounds: np.ndarray, data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first byte, byte behind the last and hash of each word of a piece."""
    found = []
    for at, end in _cuts(data, table, SLICE_BYTES):
        lo, hi = np.searchsorted(bounds, at, "left"), np.searchsorted(bounds, end, "right")
        local = np.concatenate([[0], np.clip(bounds[lo:hi] - at, 0, end - at), [end - at]])
        s, e = words(local, data[at:end], table)
        found.append((s + at, e + at, hashed(data[at:end], s, e)))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    starts, ends, h = (np.concatenate(x) for x in zip(*found, strict=True))
    return np.searchsorted(bounds, starts, "right") - 1, starts, ends, h


def hash_of(word: bytes) -> np.uint64:
    """The hash of one word."""
    data = np.frombuffer(word, np.uint8)
    return hashed(data, np.array([0]), np.array([len(data)]))[0]
