"""Substring deduplication with sampled suffix arrays in a logarithmic index family.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Suffixes
are sampled by their content: every string of ``length`` bytes holds a smallest hash of its substrings of ``SEED``
bytes, and neighbouring strings with the same one make a *unit*. Equal strings lie in units with equal seeds, wherever
they occur. Sorted arrays of seeds, of whole units and of strings are merged and scanned as families of runs whose
sizes grow geometrically (see ``exchange``), in three rounds:

1. Which seeds occur in more than one document? Most units end here.
2. For units with such seeds: which document is the first with the same whole unit? A later one loses the unit. And
   which seeds have more than one kind of unit?
3. For seeds with several kinds: the first document of each kind looks up each of its strings by itself.

A family is built per bin of keys from runs of bounded parts, so no task holds more than its bin, and a passage that a
third of all documents hold is one entry for each part.

Keys are 64-bit hashes (48 bits for seeds, which only choose candidates). Defined results: a null or empty text has no
bytes; null ids rank behind all others; rows with equal ids never match each other; texts shorter than ``length`` stay;
columns other than id and text play no part. Cuts go by bytes, so what is kept may split a character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import exchange, texts
from rotorlake.llm.memo import ranges

LENGTH = 50
SEED = 20
#: A longer text is looked at in slices that overlap by the length of a string.
SLICE = 8 << 20

_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_KEY = np.uint64(0xFFFFFFFFFFFF0000)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` neighbours from each place on."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _units(bounds: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last string start, and seed of each unit of a piece."""
    n = len(data) - length + 1
    if n < 1:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    x = data.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))  # eight bytes from each place on
    count = len(data) - SEED + 1
    h = texts.mix(x[:count] * _P[0] + x[8 : count + 8] * _P[1] + x[SEED - 8 : count + SEED - 8] * _P[2])
    low = _least(h, length - SEED + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.arange(n) + length <= bounds[row + 1]
    new = np.empty(n + 1, np.bool_)
    new[0] = new[n] = True
    new[1:n] = (low[1:] != low[:-1]) | (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
    edge = np.flatnonzero(new)
    first, last = edge[:-1], edge[1:] - 1
    real = inside[first]
    first, last = first[real], last[real]
    return row[first], first, last, texts.mix(low[first]) & _KEY


def units(bounds: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``_units``, in slices for a very long text; a unit that a slice's end cuts is looked up in two."""
    if len(data) <= SLICE:
        return _units(bounds, data, length)
    found = []
    for r in range(len(bounds) - 1):
        for at in range(int(bounds[r]), max(int(bounds[r]) + 1, int(bounds[r + 1]) - length + 1), SLICE):
            end = min(int(bounds[r + 1]), at + SLICE + length - 1)
            _, first, last, seed = _units(np.array([0, end - at]), data[at:end], length)
            found.append((np.full(len(first), r), first + at, last + at, seed))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _seeds(rows: pa.Table, _: exchange.Replies, length: int) -> dict[str, exchange.Run]:
    made = []
    for ids, bounds, data in exchange.documents(rows):
        row, _, _, seed = units(bounds, data, length)
        doc = exchange.ranked(ids)[row]
        made.append(exchange.condensed(seed, doc, doc))
    return {"seed": exchange.condensed(*map(np.concatenate, zip(*made, strict=True)))}


def _candidates(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, replies: exchange.Replies, kind: str, length: int):
    """Units whose seed was replied to: document, first and last string start, seed, hash of the whole unit."""
    row, first, last, seed = units(bounds, data, length)
    hit = replies.find(kind, seed)[0]
    row, first, last, seed = (x[hit] for x in (row, first, last, seed))
    whole = texts.hashed(data, first, last + length, fold=False) if len(row) else seed
    return row, exchange.ranked(ids)[row], first, last, seed, whole


def _kinds(rows: pa.Table, replies: exchange.Replies, length: int) -> dict[str, exchange.Run]:
    made = [_candidates(*x, replies, "seed", length) for x in exchange.documents(rows)]
    _, doc, _, _, seed, whole = map(np.concatenate, zip(*made, strict=True))
    return {"unit": exchange.condensed(whole, doc, doc), "several": exchange.condensed(seed, whole, whole)}


def _open(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, replies: exchange.Replies, length: int):
    """Units of this piece that are the first of their kind where a seed has several: as ``_candidates``."""
    found = _candidates(ids, bounds, data, replies, "several", length)
    hit, least, *_ = replies.find("unit", found[5])
    first = ~hit | (least == found[1])
    return tuple(x[first] for x in found)


def _strings(rows: pa.Table, replies: exchange.Replies, length: int) -> dict[str, exchange.Run]:
    made = []
    for ids, bounds, data in exchange.documents(rows):
        _, doc, first, last, _, _ = _open(ids, bounds, data, replies, length)
        sizes = last - first + 1
        starts = ranges(first, sizes)
        key = texts.hashed(data, starts, starts + length, fold=False) if len(starts) else np.zeros(0, np.uint64)
        doc = np.repeat(doc, sizes)
        made.append(exchange.condensed(key, doc, doc))
    return {"string": exchange.condensed(*map(np.concatenate, zip(*made, strict=True)))}


def _removed(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, replies: exchange.Replies, length: int) -> np.ndarray:
    """Whether each byte of a piece goes."""
    change = np.zeros(len(data) + 1, np.int32)
    row, first, last, seed = units(bounds, data, length)
    if len(row):
        doc = exchange.ranked(ids)[row]
        whole = texts.hashed(data, first, last + length, fold=False)
        hit, least, *_ = replies.find("unit", whole)
        gone = hit & (least < doc)
        np.add.at(change, first[gone], 1)
        np.add.at(change, last[gone] + length, -1)
        _, doc, first, last, _, _ = _open(ids, bounds, data, replies, length)
        sizes = last - first + 1
        starts = ranges(first, sizes)
        if len(starts):
            key = texts.hashed(data, starts, starts + length, fold=False)
            hit, least, *_ = replies.find("string", key)
            starts = starts[hit & (least < np.repeat(doc, sizes))]
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_kept: bool = True) -> DataFrame:
    """One row per document: sizes, removed spans (byte from, to pairs), digest of what stays, and ``kept`` itself."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = exchange.spread(source)
    seeds = exchange.ask(parts, lambda rows, back: _seeds(rows, back, length), {"seed": ()})
    kinds = exchange.ask(parts, lambda rows, back: _kinds(rows, back, length), {"unit": (1,), "several": ()}, seeds)
    strings = exchange.ask(parts, lambda rows, back: _strings(rows, back, length), {"string": (1,)}, kinds)

    def cut(rows: pa.Table, back: pa.Table) -> pa.Table:
        replies, out = exchange.Replies(back), []
        for ids, bounds, data in exchange.documents(rows):
            gone = _removed(ids, bounds, data, replies, length)
            step = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            keep = data[~gone].tobytes()
            kept_at = np.concatenate([[0], np.cumsum(~gone)])
            for k, name in enumerate(ids.tolist()):
                a, b = int(bounds[k]), int(bounds[k + 1])
                own = gone[a:b]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))) if step[a : b + 1].any() or own[:1].any() else np.zeros(0, np.int64)
                left = keep[kept_at[a] : kept_at[b]]
                row = (None if name == exchange.NO_ID else name, b - a, int(own.sum()), len(edges) // 2, hashlib.sha256(left).hexdigest(), edges.tolist())
                out.append((*row, left) if with_kept else row)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())] + [pa.binary()] * with_kept
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_kept
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    known = kinds.unionByName(strings)
    schema = SCHEMA + ", kept binary" * with_kept
    return parts.table.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(cut, schema)
