"""Questions that parts of a corpus ask each other: which keys do others hold too, and what are the extreme values?

Texts are dealt once into *parts* of bounded size by a hash of id and length, compressed, in a bucketed table. A round
works like this: each part makes (key, value) pairs from its texts, keeps the smallest and largest value of each key
(so a key that a third of all documents hold is one entry a part), and sends them to *bins* by the key's leading bits.
A bin merges what it gets and replies to each part the keys whose extremes differ. Replies are tables in the shared
folder; the next round joins them with the parts by the part's number, without moving the texts again.

A bin keeps its sorted runs as a logarithmic family: a new run that finds one of its own size is merged with it, and
the result with the next, so every entry is merged a logarithmic number of times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts
from rotorlake.session import shared_folder

PART_BYTES = 12 << 20
MIN_PARTS = 64
FLUSH_BYTES = 24 << 20
#: Stands for a null id: behind all others.
NO_ID = np.int64(2**63 - 1)

Run = tuple[np.ndarray, ...]


def ranked(ids: np.ndarray) -> np.ndarray:
    """Ids as unsigned numbers in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def unranked(values: np.ndarray) -> np.ndarray:
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def pack(run: Run) -> bytes:
    """Sorted keys as differences, then the columns, each byte place by itself, compressed."""
    keys, *columns = run
    body = [_planes(np.diff(keys, prepend=np.uint64(0)))]
    for k, x in enumerate(columns):
        body.append(_planes(x ^ columns[k - 1] if k else x))
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(run)]) + b"".join(body))


def unpack(data: bytes) -> Run:
    raw = zstandard.ZstdDecompressor().decompress(data)
    wide = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], 8, -1)
    columns = [np.ascontiguousarray(x.T).view("<u8").ravel() for x in wide]
    for k in range(2, len(columns)):
        columns[k] = columns[k] ^ columns[k - 1]
    return (np.cumsum(columns[0], dtype=np.uint64), *columns[1:])


def condensed(keys: np.ndarray, low: np.ndarray, high: np.ndarray, *sums: np.ndarray) -> Run:
    """Each key once, in order, with its smallest and largest value and the sums of what follows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if not len(keys):
        return (keys, low, high, *sums)
    least, most = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
    return (keys[first], least, most, *(np.add.reduceat(x[order], first) for x in sums))


def merged(a: Run, b: Run) -> Run:
    return condensed(*(np.concatenate(x) for x in zip(a, b, strict=True)))


class Family:
    """Sorted runs of geometric sizes."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, Run]] = []

    def add(self, run: Run) -> None:
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            run, size = merged(other, run), 2 * size
        self.levels.append((size, run))

    def whole(self) -> Run:
        run = self.levels[-1][1]
        for _, other in self.levels[-2::-1]:
            run = merged(other, run)
        return run


@dataclass(frozen=True)
class Parts:
    """The corpus in parts: a bucketed table, and how many parts and bins there are (a power of two)."""

    table: DataFrame
    count: int


Signer = Callable[[np.ndarray, np.ndarray], np.ndarray]


def spread(docs: DataFrame, part_bytes: int | None = None, min_parts: int | None = None, sign: Signer | None = None) -> Parts:
    """Deal documents (columns doc_id: long, text) into parts; ``sign`` gives each text of a piece a number to keep."""
    spark = docs.sparkSession
    part_bytes, min_parts = part_bytes or PART_BYTES, min_parts or MIN_PARTS
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 << max(min_parts - 1, -(-total // part_bytes) - 1, 0).bit_length()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        held: dict[int, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = sorted(held.items())
            fixed = [[np.concatenate([x[c] for x in own]).tobytes() for _, own in rows] for c in range(3)]
            blobs = [packer.compress(b"".join(x[3] for x in own)) for _, own in rows]
            columns = [pa.array([k for k, _ in rows], pa.int32()), *(pa.array(x, pa.binary()) for x in (*fixed, blobs))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["part", "ids", "sizes", "signs", "blob"])

        for batch, bounds, data in texts.pieces(batches, "text"):
            ids = batch.column("doc_id").fill_null(int(NO_ID)).to_numpy().astype(np.int64)
            sizes = np.diff(bounds)
            part = texts.mix(ids.view(np.uint64) * np.uint64(31) + sizes.astype(np.uint64)) & np.uint64(count - 1)
            signs = sign(bounds, data) if sign else np.zeros(0, np.uint64)
            raw = data.tobytes()
            for k, p in enumerate(part.tolist()):
                own = slice(k, k + 1)
                held.setdefault(p, []).append((ids[own], sizes[own], signs[own], raw[bounds[k] : bounds[k + 1]]))
            size += len(raw)
            if size >= FLUSH_BYTES:
                size = 0
                yield flush()
        if held:
            yield flush()

    rows = docs.mapInArrow(deal, "part int, ids binary, sizes binary, signs binary, blob binary")
    name, path = f"rotorlake_parts_{uuid.uuid4().hex}", shared_folder(spark, "parts")
    writer = rows.repartition(count, "part").write.bucketBy(count, "part").option("compression", "none")
    writer.option("path", path).saveAsTable(name)
    return Parts(spark.table(name), count)


def signed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and signs of a part's texts."""
    read = lambda c, kind: [np.frombuffer(rows.column(c)[k].as_buffer(), kind) for k in range(rows.num_rows)]
    return np.concatenate(read("ids", np.int64)), np.concatenate(read("signs", np.uint64))


def documents(rows: pa.Table, max_bytes: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, bounds and bytes of the texts of a part, in pieces, in the order of ``signed``."""
    for k in range(rows.num_rows):
        ids = np.frombuffer(rows.column("ids")[k].as_buffer(), np.int64)
        sizes = np.frombuffer(rows.column("sizes")[k].as_buffer(), np.int64)
        blob = zstandard.ZstdDecompressor().decompress(rows.column("blob")[k].as_buffer())
        data = np.frombuffer(blob, np.uint8)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(ids):
            end = max(at + 1, min(len(ids), int(np.searchsorted(bounds, bounds[at] + max_bytes, "right")) - 1))
            yield ids[at:end], bounds[at : end + 1] - bounds[at], data[bounds[at] : bounds[end]]
            at = end


class Replies:
    """What a part got back: by kind of question, keys in order and their columns."""

    def __init__(self, rows: pa.Table | None) -> None:
        got: dict[str, list[Run]] = {}
        if rows is not None:
            for k in range(rows.num_rows):
                got.setdefault(rows.column("kind")[k].as_py(), []).append(unpack(rows.column("data")[k].as_buffer()))
        self.by_kind: dict[str, Run] = {}
        for kind, runs in got.items():
            runs.sort(key=lambda r: r[0][0])  # bins are ranges of keys
            self.by_kind[kind] = tuple(np.concatenate(x) for x in zip(*runs, strict=True))

    def find(self, kind: str, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether each key was replied to, and its columns (0 if not)."""
        if kind not in self.by_kind or not len(keys):
            return np.zeros(len(keys), np.bool_), *(np.zeros(len(keys), np.uint64) for _ in range(3))
        known, *columns = self.by_kind[kind]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        return hit, *(np.where(hit, x[at], np.uint64(0)) for x in columns)


Emit = Callable[[pa.Table, Replies], dict[str, Run]]


def ask(parts: Parts, emit: Emit, told: dict[str, tuple[int, ...]], replies: DataFrame | None = None) -> DataFrame:
    """One round; rows of the reply: part, kind, data. ``told`` names the columns of the reply for each kind of
    question: 1 the smallest value, 2 the largest, 3 and on the sums."""
    bits = parts.count.bit_length() - 1

    def asked(rows: pa.Table, back: pa.Table | None) -> pa.Table:
        out: list[tuple[str, int, int, bytes]] = []
        if rows.num_rows:
            part = rows.column("part")[0].as_py()
            for kind, run in emit(rows, Replies(back)).items():
                place = (run[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(run[0]), np.int64)
                cuts = np.searchsorted(place, np.arange((1 << bits) + 1))
                out += [(kind, b, part, pack(tuple(x[cuts[b] : cuts[b + 1]] for x in run))) for b in np.flatnonzero(np.diff(cuts)).tolist()]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["kind", "bin", "part", "data"])

    def served(key: tuple, rows: pa.Table) -> pa.Table:
        blocks = [unpack(rows.column("data")[k].as_buffer()) for k in range(rows.num_rows)]
        family = Family()
        for block in blocks:
            family.add(block)
        whole = family.whole()
        open_ = whole[1] != whole[2]
        known = tuple(x[open_] for x in whole)
        names, data = [], []
        for part, block in zip(rows.column("part").to_pylist(), blocks, strict=True):
            at = np.minimum(np.searchsorted(known[0], block[0]), max(0, len(known[0]) - 1))
            mine = at[known[0][at] == block[0]] if len(known[0]) else at[:0]
            if len(mine):
                names.append(part)
                data.append(pack(tuple(known[x][mine] for x in (0, *told[key[0].as_py()]))))
        kind = pa.array([key[0].as_py()] * len(names), pa.string())
        return pa.table([pa.array(names, pa.int32()), kind, pa.array(data, pa.binary())], names=["part", "kind", "data"])

    schema = "kind string, bin int, part int, data binary"
    if replies is None:
        entries = parts.table.groupBy("part").applyInArrow(lambda rows: asked(rows, None), schema)
    else:
        entries = parts.table.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(asked, schema)
    answers = entries.groupBy("kind", "bin").applyInArrow(served, "part int, kind string, data binary")
    path = shared_folder(parts.table.sparkSession, "replies")
    answers.write.option("compression", "none").parquet(path)
    return parts.table.sparkSession.read.schema("part int, kind string, data binary").parquet(path)
