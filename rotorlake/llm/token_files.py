"""Token ids in files of fixed-width bit-packed blocks.

Documents are dealt out by ranges of their id, encoded in ascending order, and written in blocks. Every block is one
row of a Parquet table: its shard and place, the number of bits of an id, the documents that lie in it with the place
of their first id, and the packed ids (uncompressed, most significant bit first). Blocks end with a document, so each
block is read by itself: an id's bits start at place times width, which numpy unpacks in one step, for the whole block
or any range of it.

Texts are encoded by the tokenizers library. Its byte-level vocabularies cut texts into words first; texts are cut at
some of the places where that is certain, and equal parts are encoded once per worker.

Defined results: a null or empty text has the end id only; rows with equal ids follow each other, ordered by a hash of
the text; null ids come first; ids of other types are in Spark's order of that type; an empty table makes no blocks;
columns other than id and text play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rotorlake.llm import texts
from rotorlake.llm.memo import Memo
from rotorlake.operators.joins import lookup_join

BLOCK_IDS = 1 << 16
SHARD_DOCS = 16_384
#: A word without white space or characters of which some are white space.
_PLAIN = re.compile(rb" [\x21-\x7e\x80-\xc1\xc3-\xe0\xe4-\xff]+")

BLOCKS = (
    "shard int, block int, first long, n_ids long, bits int, doc_ids array<{id}>, places array<long>, payload binary"
)


def width(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as one bit string of ``bits`` per id, filled up to a whole byte."""
    wide = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return wide[:, 4 - bits // 8 :].tobytes()
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits :]).tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` on; only the bytes that hold them are touched."""
    lo, hi = start * bits, (start + count) * bits
    raw = np.frombuffer(payload, np.uint8)[lo // 8 : -(-hi // 8)]
    wide = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        wide[:, 4 - bits // 8 :] = raw.reshape(count, bits // 8)
    else:
        own = np.unpackbits(raw)[lo % 8 : lo % 8 + count * bits].reshape(count, bits)
        full = np.zeros((count, 32), np.uint8)
        full[:, 32 - bits :] = own
        wide = np.packbits(full, axis=1)
    return wide.view(">u4").ravel().astype(np.uint32)


_LETTER = np.zeros(256, np.bool_)
_LETTER[65:91] = _LETTER[97:123] = True


def parts(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts texts where byte-level pre-tokenization always ends a token.

    These are: in front of a blank, full stop or comma, and around a single line feed, as far as the neighbours make
    it certain. A character that may be white space beyond ASCII is never next to a cut.
    """
    n = len(data)
    cut = np.zeros(n + 1, np.bool_)
    cut[bounds] = True
    if n > 1:
        before = data[:-1]
        solid = (before > 0x20) & (before != 0x7F)
        solid[1:] &= data[:-2] != 0xC2
        solid[2:] &= ~((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
        here = data[1:]
        cut[1:n] |= solid & (here == 0x20)
        cut[1:n] |= _LETTER[before] & ((here == 0x2E) | (here == 0x2C))
        lines = solid[:-1] & (here[:-1] == 0x0A) & _LETTER[data[2:]]
        cut[1 : n - 1] |= lines
        cut[2:n] |= lines
    places = np.flatnonzero(cut)
    return places[:-1], places[1:]


class Encoder:
    """Encodes texts with one tokenizer file; remembers parts."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        # A byte-level token's name has one character for each byte.
        self.bytes = np.zeros(self.vocabulary, np.int64)
        for name, k in self.tokenizer.get_vocab().items():
            self.bytes[k] = len(name)
        self.memo = Memo(self._learn)

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Plain words are encoded side by side, since each starts with a blank; others one by one."""
        plain = np.array([x[:1] == b" " and _PLAIN.fullmatch(x) is not None for x in new], np.bool_)
        held: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(new)
        some = np.flatnonzero(plain).tolist()
        groups = [some[k : k + 500] for k in range(0, len(some), 500)]
        done = self.tokenizer.encode_batch_fast([b"".join(new[k] for k in g).decode() for g in groups], add_special_tokens=False)
        odd = np.flatnonzero(~plain).tolist()
        for group, e in zip(groups, done, strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = np.cumsum([len(new[k]) for k in group])
            at = np.searchsorted(reached := np.cumsum(self.bytes[ids]), ends)
            if len(ids) and at[-1] < len(ids) and (reached[at] == ends).all():
                for k, x in zip(group, np.split(ids, at[:-1] + 1), strict=True):
                    held[k] = x
            else:
                odd += group
        done = self.tokenizer.encode_batch_fast([new[k].decode() for k in odd], add_special_tokens=False)
        for k, e in zip(odd, done, strict=True):
            held[k] = np.array(e.ids, np.uint32)
        return np.concatenate(held), np.array(list(map(len, held)), np.int64)

    def encode(self, bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a piece side by side, and the number of ids of each text."""
        starts, ends = parts(bounds, data)
        ids, sizes = self.memo.ids(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.searchsorted(starts, bounds)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _dealt(docs: DataFrame, shard_docs: int) -> DataFrame:
    """Documents in partitions by ascending ranges of the id, and of the text's hash where ids are equal."""
    order = ["doc_id", F.xxhash64("text")]
    return docs.repartitionByRange(max(1, -(-docs.count() // shard_docs)), *order).sortWithinPartitions(*order)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
    shard_docs: int = SHARD_DOCS,
) -> None:
    """Encode and write all documents, each followed by the end id."""
    rows = _dealt(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shard_docs)
    schema = BLOCKS.format(id=rows.schema["doc_id"].dataType.simpleString())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        bits = width(max(code.vocabulary, end_id + 1))
        # Ranges ascend with the partition's number.
        shard, block, first, held, sizes, names = TaskContext.get().partitionId(), 0, 0, [], [], []
        kind = None

        def flush() -> pa.RecordBatch:
            nonlocal block, first, held, sizes, names
            ids = np.concatenate(held)
            places = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            row = [[shard], [block], [first], [len(ids)], [bits], [names], [places], [pack(ids, bits)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds, strict=True)],
                names=["shard", "block", "first", "n_ids", "bits", "doc_ids", "places", "payload"],
            )
            block, first, held, sizes, names = block + 1, first + len(ids), [], [], []
            return out

        total = 0
        for batch, bounds, data in texts.pieces(batches, "text"):
            kind = batch.column("doc_id").type
            ids, counts = code.encode(bounds, data)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id))
            ends += np.arange(1, len(ends) + 1)
            at = 0
            for name, a, b in zip(batch.column("doc_id").to_pylist(), (ends - counts - 1).tolist(), ends.tolist(), strict=True):
                sizes.append(b - a)
                names.append(name)
                total += b - a
                if total >= block_ids:
                    held.append(ids[at:b])
                    at, total = b, 0
                    yield flush()
            held.append(ids[at:])
        if names:
            yield flush()

    rows.mapInArrow(blocks, schema).write.mode("overwrite").option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, ids."""
    blocks = spark.read.parquet(path)
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).withColumn("g", F.expr("shard div 1024"))
    groups = sums.groupBy("g").agg(F.sum("n").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("g", F.coalesce(F.sum("n").over(before.orderBy("g")), F.lit(0)).alias("g_base"))
    within = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.join(groups, "g").select("shard", (F.col("g_base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("base"))
    rows = lookup_join(blocks, bases, "shard")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("base", "first", "bits", "n_ids", "places", "payload")}
                ids = unpack(row["payload"].as_buffer(), row["bits"].as_py(), 0, row["n_ids"].as_py()).astype("<u4")
                places = row["places"].values.to_numpy()
                ends = np.append(places[1:], len(ids))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(places.tolist(), ends.tolist(), strict=True)]
                bounds = np.append(places, len(ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[k].values,
                        pa.array(places + (row["base"].as_py() + row["first"].as_py())),
                        pa.array(ends - places),
                        pa.array(crc, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return rows.mapInArrow(unpacked, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, ids array<int>")
