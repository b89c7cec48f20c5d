"""Substring deduplication by hashes of lines and of the sentences of long lines.

Texts are cut into units behind every line feed and, inside a line, behind a full stop, exclamation or question mark
that white space follows, so a passage pasted into a line is found too. A unit is normalised to its words (A-Z
lower-cased, white space and ASCII punctuation left out) and hashed. Digests are grouped globally; of equal units with
``min_words`` words or more the earliest by document id and place stays and the rest are removed. Shorter units, which
meet by chance, stay, but go with their neighbours if both sides are removed.

With ``whole``, lines and paragraphs (lines between blank ones) are hashed too, and a unit goes if it, its line or its
paragraph repeats, so lines of short sentences are found. A unit then also counts as long with ``min_bytes`` bytes in
its words, since some scripts set no blanks between words.

Groups are formed per digest and part first (see ``exchange``): a line that a third of all documents hold is one entry
for each part.

Defined results: a null or empty text has no units; null ids rank behind all others; of rows with equal ids none is
earlier, but each keeps its own first occurrence; offsets are bytes of the original UTF-8 text and never split a
character, since units end behind ASCII characters.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import exchange, texts

MIN_WORDS = 6
MIN_BYTES = 30

_END = np.zeros(256, np.bool_)
_END[list(b".!?")] = True
_SPACE = ~texts.SPACED


class Units(NamedTuple):
    """Units of a piece in order: row, first byte, byte behind the last, first word, words, bytes in words, digest."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    word: np.ndarray
    count: np.ndarray
    letters: np.ndarray
    digest: np.ndarray


def units(bounds: np.ndarray, data: np.ndarray, whole: bool = False) -> list[Units]:
    """The sentences of a piece; with ``whole`` the lines and the paragraphs too."""
    n = len(data)
    text = np.zeros(n + 1, np.bool_)
    text[bounds] = True
    line = text.copy()
    line[1:] |= data == 0x0A
    cut = line.copy()
    if n:
        cut[1:n] |= _END[data[:-1]] & _SPACE[data[1:]]
    _, starts, ends, h = texts.word_hashes(bounds, data, texts.ALNUM)
    runs = texts.Sequences(h)
    size = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])

    def between(edge: np.ndarray) -> Units:
        first, last = edge[:-1], edge[1:]
        row = np.searchsorted(bounds, first, "right") - 1
        a, b = np.searchsorted(starts, first), np.searchsorted(starts, last)
        count = b - a
        digest = runs.between(a, b)
        return Units(row, first, last, a, count, size[b] - size[a], digest)

    made = [between(np.flatnonzero(cut))]
    if whole:
        lines_ = between(np.flatnonzero(line))
        # A paragraph begins with a text and behind a line without words.
        begins = text[lines_.first] | np.append(True, lines_.count[:-1] == 0)[: len(lines_.first)]
        made += [lines_, between(np.append(lines_.first[begins], n))]
    return made


class Least(NamedTuple):
    """The size from which a repeated unit goes, and which units there are."""

    words: int
    bytes: int
    whole: bool

    def long(self, own: Units) -> np.ndarray:
        return (own.count >= self.words) | (own.letters >= self.bytes) if self.whole else own.count >= self.words


def _digests(rows: pa.Table, least: Least) -> dict[str, exchange.Run]:
    made = []
    for ids, bounds, data in exchange.documents(rows):
        for own in units(bounds, data, least.whole):
            long_ = least.long(own)
            doc = exchange.ranked(ids)[own.row[long_]]
            made.append(exchange.condensed(own.digest[long_], doc, doc))
    return {"unit": exchange.condensed(*map(np.concatenate, zip(*made, strict=True)))}


def _gone(ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, replies: exchange.Replies, least: Least):
    """Row, first byte, byte behind the last of each sentence, and whether it goes."""
    levels = units(bounds, data, least.whole)
    longs, goes = [least.long(own) for own in levels], []
    for own, long_ in zip(levels, longs, strict=True):
        hit, lowest, *_ = replies.find("unit", own.digest)
        goes.append(long_ & hit & (lowest < exchange.ranked(ids)[own.row]))
    # Within a document the first place stays; a sentence that is its whole line is one place.
    row, word, digest = (np.concatenate([getattr(own, c)[long_] for own, long_ in zip(levels, longs, strict=True)]) for c in ("row", "word", "digest"))
    order = np.lexsort((word, digest, row))
    new = np.ones(len(row), np.bool_)
    new[1:] = (digest[order[1:]] != digest[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    again = np.zeros(len(row), np.bool_)
    if len(row):
        again[order] = word[order] != word[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    for long_, go, part in zip(longs, goes, np.split(again, np.cumsum([int(x.sum()) for x in longs])[:-1]), strict=True):
        go[long_] |= part
    own, long_, gone = levels[0], longs[0], goes[0]
    for wide, go in zip(levels[1:], goes[1:], strict=True):
        gone |= go[np.searchsorted(wide.first, own.first, "right") - 1]
    # A run of short units goes if the units on both of its sides do.
    row, place = own.row, np.arange(len(own.row))
    before = np.maximum.accumulate(np.where(long_, place, -1))
    after = np.minimum.accumulate(np.where(long_, place, len(row))[::-1])[::-1]
    inner = ~long_ & (before >= 0) & (after < len(row))
    b, a = before[inner], after[inner]
    gone[inner] |= gone[b] & gone[a] & (row[b] == row[inner]) & (row[a] == row[inner])
    return row, own.first, own.last, gone


SCHEMA = "doc_id long, text_hash long, n_units long, n_removed long, n_bytes long, n_cut long, kept_sha256 string, spans array<long>"


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, with_kept: bool = True, whole: bool = False, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per document: units, removed units, bytes, removed bytes, removed spans (byte from, to pairs) and
    ``kept``, the text that stays. ``text_hash`` is xxhash64 of the text."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts, limits = exchange.spread(source), Least(min_words, min_bytes, whole)
    found = exchange.ask(parts, lambda rows, _: _digests(rows, limits), {"unit": (1,)})

    def cut(rows: pa.Table, back: pa.Table) -> pa.Table:
        replies, out = exchange.Replies(back), []
        for ids, bounds, data in exchange.documents(rows):
            row, first, last, gone = _gone(ids, bounds, data, replies, limits)
            at = np.searchsorted(row, np.arange(len(ids) + 1))
            raw = data.tobytes()
            for k, name in enumerate(ids.tolist()):
                lo, hi, a, b = int(at[k]), int(at[k + 1]), int(bounds[k]), int(bounds[k + 1])
                own, spans, kept = raw[a:b], [], raw[a:b]
                if gone[lo:hi].any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[lo:hi].view(np.int8), [0]]))).reshape(-1, 2) + lo
                    spans = [int(x) - a for s, e in edges.tolist() for x in (first[s], last[e - 1])]
                    kept = b"".join(own[s:e] for s, e in zip([0, *spans[1::2]], [*spans[::2], len(own)], strict=True))
                digest = np.uint64(xxhash.xxh64_intdigest(own, seed=42)).view(np.int64)
                values = (None if name == exchange.NO_ID else name, int(digest), hi - lo, int(gone[lo:hi].sum()), b - a, len(own) - len(kept), hashlib.sha256(kept).hexdigest(), spans)
                out.append((*values, kept.decode()) if with_kept else values)
        kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int64())] + [pa.string()] * with_kept
        names = ["doc_id", "text_hash", "n_units", "n_removed", "n_bytes", "n_cut", "kept_sha256", "spans"] + ["kept"] * with_kept
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    schema = SCHEMA + ", kept string" * with_kept
    return parts.table.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(cut, schema)


def clean(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """The documents with all columns and without removed units; texts of which nothing is left go."""
    place, names = docs.columns.index("text"), [f"_{k}" for k in range(len(docs.columns))]
    ids = docs.columns.index("doc_id")
    plain = docs.toDF(*names)
    kept = dedup(plain.select(F.col(names[ids]).alias("doc_id"), F.col(names[place]).alias("text")), min_words=min_words, whole=whole)
    kept = kept.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"), F.col("kept").alias("k_text"), F.col("n_cut").alias("k_cut"))
    kept = kept.dropDuplicates(["k_id", "k_hash"])
    rows = plain.withColumn("r_null", F.col(names[place]).isNull()).withColumn("r_hash", F.xxhash64(F.coalesce(names[place], F.lit("")))).drop(names[place])
    same = rows[names[ids]].cast("long").eqNullSafe(kept.k_id) & (rows.r_hash == kept.k_hash)
    joined = rows.join(kept, same).where((F.col("k_cut") == 0) | F.col("k_text").rlike(r"\S"))
    texts_ = F.when(~F.col("r_null"), F.col("k_text"))
    return joined.select(*[(texts_ if k == place else F.col(x)).alias(docs.columns[k]) for k, x in enumerate(names)])
