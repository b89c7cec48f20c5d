"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability is the sum over all
ways to cut it into pieces, found by a forward algorithm over its bytes; bytes outside any piece have a small
probability of their own. A text's score for a language is the product over its words and the language's share.

Piece probabilities come from all training rows: each task counts distinct words per language, and a word counts for
each piece at each place where it occurs in it. Counts are summed by Spark; what reaches the driver is one number for
each language and piece of the fixed vocabulary.

Words start with a blank that stands for the vocabulary's word mark. A word of more than ``WORD`` bytes is cut wherever
no piece that occurs in it reaches over: there every segmentation has a border, so the sum over all of them is the product
of the sums over the parts, whatever the word's length. Sums are scaled up as they go. Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text if there is nothing to learn from;
equal scores go to the language first in order; a language is any non-null value of ``lang`` in the training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts
from rotorlake.llm.memo import Memo, ranges

MARK = "▁"
#: Words up to so many bytes are taken whole.
WORD = 32
#: Longest part of a word that is summed side by side with others of its length.
PART = 256
#: Steps after which sums are scaled.
SCALED = 8
#: Probability of a byte that no piece covers, and what is added to each count.
FLOOR, SMOOTH = 1e-7, 0.05
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


class Vocabulary:
    """Pieces as bytes, found by hash."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = (k for k in range(lib.get_piece_size()) if not (lib.is_control(k) or lib.is_unknown(k) or lib.is_byte(k) or lib.is_unused(k)))
        names = sorted({x.replace(MARK, " ").encode() for k in usable if MARK not in (x := lib.id_to_piece(k))[1:]} - {b" "})
        sizes = np.array(list(map(len, names)))
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(names), np.uint8)
        self.size, self.longest = len(names), int(sizes.max())
        self.index = Memo(lambda new: (np.zeros(0, np.uint32), np.zeros(len(new), np.int64)))
        self.index._add(texts.hashed(flat, ends - sizes, ends, fold=False), np.zeros(0, np.uint32), np.zeros(len(names), np.int64))

    def cuts(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word, place, bytes and piece of every piece that occurs in words of equal length (one row each)."""
        n, size = words.shape
        at = [(i, j) for j in range(1, size + 1) for i in range(max(0, j - self.longest), j)]
        first, last = np.array([i for i, _ in at]), np.array([j for _, j in at])
        base = np.arange(n)[:, None] * size
        h = texts.hashed(words.ravel(), (base + first).ravel(), (base + last).ravel(), fold=False)
        piece = self.index._find(h)
        hit = np.flatnonzero(piece >= 0)
        which = hit % len(at)
        return hit // len(at), first[which], (last - first)[which], piece[hit]


    def hits(self, flat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each width the places in ``flat`` where a piece of that width stands, and the pieces."""
        for width in range(1, min(self.longest, len(flat)) + 1):
            at = np.arange(len(flat) - width + 1)
            piece = self.index._find(texts.hashed(flat, at, at + width, fold=False))
            found = np.flatnonzero(piece >= 0)
            yield width, at[found], piece[found]

    def borders(self, word: np.ndarray) -> np.ndarray:
        """The places in a word that no piece in it reaches over, its start among them."""
        over = np.zeros(len(word) + 1, np.int64)
        for width, at, _ in self.hits(word):
            if width > 1:
                np.add.at(over, at + 1, 1)
                np.add.at(over, at + width, -1)
        return np.flatnonzero(np.cumsum(over)[:-1] == 0)


def chunks(vocabulary: Vocabulary, bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, bytes, starts and ends of words with a blank in front, long ones cut at their borders."""
    first, last = texts.words(bounds, data, texts.SPACED)
    row = np.searchsorted(bounds, first, "right") - 1
    sizes = last - first + 1
    flat = data[ranges(first - 1, sizes)] if len(first) else data[:0]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if len(first):
        flat[starts] = 0x20
    long_ = np.flatnonzero(sizes > WORD)
    if len(long_):
        cuts = [starts[k] + vocabulary.borders(flat[starts[k] : ends[k]])[1:] for k in long_.tolist()]
        added = np.concatenate(cuts)
        row = np.concatenate([row, np.repeat(row[long_], list(map(len, cuts)))])
        starts = np.concatenate([starts, added])
        order = np.argsort(starts, kind="stable")
        row, starts = row[order], starts[order]
        ends = np.append(starts[1:], len(flat))
    return row, flat, starts, ends


def _by_size(words: list[bytes], at_most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of words of equal length."""
    sizes = np.array(list(map(len, words)))
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        step = 1 if size > PART else max(1, at_most * WORD // max(WORD, size))
        for k in range(0, len(own), step):
            some = own[k : k + step]
            yield some, np.frombuffer(b"".join(words[x] for x in some.tolist()), np.uint8).reshape(-1, size)


class Counter:
    """Counts of pieces by language; words are counted first and cut once."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.total: dict[str, np.ndarray] = {}

    def add(self, names: list[str], bounds: np.ndarray, data: np.ndarray) -> None:
        row, flat, starts, ends = chunks(self.vocabulary, bounds, data)
        if not len(row):
            return
        h = texts.hashed(flat, starts, ends, fold=False)
        _, where, number = np.unique(h, return_index=True, return_inverse=True)
        kinds = sorted(set(names))
        code = np.array([kinds.index(x) for x in names])[row]
        seen = np.bincount(code * len(where) + number, minlength=len(kinds) * len(where)).reshape(len(kinds), -1)
        raw = flat.tobytes()
        words = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        for some, matrix in _by_size(words):
            if matrix.shape[1] > PART:
                found = [(np.zeros(len(p), np.int64), p) for _, _, p in self.vocabulary.hits(matrix[0])]
            else:
                word, _, _, piece = self.vocabulary.cuts(matrix)
                found = [(word, piece)]
            for k, name in enumerate(kinds):
                if name not in self.total:
                    self.total[name] = np.zeros(self.vocabulary.size)
                for word, piece in found:
                    self.total[name] += np.bincount(piece, seen[k][some][word], self.vocabulary.size)


class Model:
    """Forward sums for all languages at once."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], shares: np.ndarray, counts: np.ndarray) -> None:
        self.vocabulary, self.languages = vocabulary, languages
        mass = counts + SMOOTH
        self.chance = (mass / mass.sum(axis=1, keepdims=True)).T.copy()  # piece, language
        self.share = np.log(shares / shares.sum())
        self.memo = Memo(self._learn)

    def forward(self, matrix: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations, for words of equal length."""
        n, size = matrix.shape
        if size > PART:
            return np.stack([self.forward_long(word) for word in matrix])
        reach = np.zeros((size + 1, n, len(self.languages)))
        reach[0] = 1.0
        scale = np.zeros((n, len(self.languages)))
        word, place, width, piece = self.vocabulary.cuts(matrix)
        end = place + width
        # Pieces by where they end, then by length: a word has one piece at most of each, so sums do not collide.
        key = end * (self.vocabulary.longest + 1) + width
        order = np.argsort(key, kind="stable")
        word, place, piece, key = word[order], place[order], piece[order], key[order]
        at = np.searchsorted(key, np.arange((size + 2) * (self.vocabulary.longest + 1)))
        for j in range(1, size + 1):
            reach[j] = reach[j - 1] * FLOOR
            for w in range(1, min(j, self.vocabulary.longest) + 1):
                k = j * (self.vocabulary.longest + 1) + w
                a, b = at[k], at[k + 1]
                if b > a:
                    reach[j][word[a:b]] += reach[j - w][word[a:b]] * self.chance[piece[a:b]]
            if j % SCALED == 0:
                top = reach[j].copy()
                reach[max(0, j - self.vocabulary.longest) : j + 1] /= top
                scale += np.log(top)
        return np.log(reach[size]) + scale

    def forward_long(self, word: np.ndarray) -> np.ndarray:
        """The same for one word of any length, with the last sums only."""
        size, wide = len(word), self.vocabulary.longest
        places, widths, pieces = [], [], []
        for width, at, piece in self.vocabulary.hits(word):
            places.append(at + width)
            widths.append(np.full(len(at), width))
            pieces.append(piece)
        end, width, piece = (np.concatenate(x) for x in (places, widths, pieces))
        order = np.argsort(end, kind="stable")
        width, piece = width[order], piece[order]
        at = np.searchsorted(end[order], np.arange(size + 2)).tolist()
        # Sums to the last places, the sum to place j in row j modulo their number.
        ring = np.zeros((wide + 1, len(self.languages)))
        ring[0] = 1.0
        scale = np.zeros(len(self.languages))
        for j in range(1, size + 1):
            a, b = at[j], at[j + 1]
            total = ring[(j - 1) % (wide + 1)] * FLOOR
            if b > a:
                total = total + (ring[(j - width[a:b]) % (wide + 1)] * self.chance[piece[a:b]]).sum(0)
            ring[j % (wide + 1)] = total
            if j % SCALED == 0:
                ring /= total
                scale += np.log(total)
        return np.log(ring[size % (wide + 1)]) + scale

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out = np.empty((len(new), len(self.languages)), np.float32)
        for some, matrix in _by_size(new):
            out[some] = self.forward(matrix)
        return out.ravel().view(np.uint32), np.full(len(new), len(self.languages), np.int64)

    def predict(self, values: list[str | None], bounds: np.ndarray, data: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of a piece."""
        row, flat, starts, ends = chunks(self.vocabulary, bounds, data)
        got, _ = self.memo.ids(flat, starts, ends)
        each = got.view(np.float32).reshape(-1, len(self.languages)).astype(np.float64)
        n = len(bounds) - 1
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(each, axis=0)])
        at = np.searchsorted(row, np.arange(n + 1))
        score = total[at[1:]] - total[at[:-1]] + self.share
        best = score.argmax(axis=1)
        # Words are not independent: the margin is taken per root of the number of words.
        score = (score - score.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(1, np.diff(at)))[:, None]
        sure = 1.0 / np.exp(score).sum(axis=1)
        letters = np.array([x is not None and _LETTER.search(x) is not None for x in values], np.bool_)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, np.where(letters, sure, 0.0)


def learn(docs: DataFrame, training: Column, vocabulary: str, text: str = "text", lang: str = "lang"):
    """Languages, their numbers of training rows, and counts of pieces (language, piece)."""
    rows = docs.where(training & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, docs_ = Counter(Vocabulary(vocabulary)), {}
        for batch, bounds, data in texts.pieces(batches, "text", 4 << 20):
            names = batch.column("lang").to_pylist()
            for x in names:
                docs_[x] = docs_.get(x, 0) + 1
            counter.add(names, bounds, data)
        for name, n in docs_.items():
            own = counter.total.get(name, np.zeros(0))
            piece = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(piece) + 1)), pa.array(np.append(-1, piece), pa.int32()), pa.array(np.append(n, own[piece]), pa.float64())],
                names=["lang", "piece", "n"],
            )

    sums = rows.mapInArrow(count, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    names = np.array(got.column("lang").to_pylist(), object)
    piece, n = got.column("piece").to_numpy(), got.column("n").to_numpy()
    languages = sorted(set(names.tolist()))
    code = np.searchsorted(np.array(languages, object), names) if languages else np.zeros(0, np.int64)
    shares = np.bincount(code[piece < 0], n[piece < 0], len(languages)) if languages else np.zeros(0)
    counts = np.zeros((len(languages), Vocabulary(vocabulary).size))
    real = piece >= 0
    counts[code[real], piece[real]] = n[real]
    return languages, shares, counts


def identify(docs: DataFrame, training: Column, vocabulary: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out (not a training row), lang_pred, score."""
    languages, shares, counts = learn(docs, training, vocabulary, text, lang)
    model = docs.sparkSession.sparkContext.broadcast((languages, shares, counts))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (~training).alias("held_out"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, share, count = model.value
        own = Model(Vocabulary(vocabulary), names, share, count) if names else None
        for batch, bounds, data in texts.pieces(batches, "text"):
            if own is None:
                best, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                best, score = own.predict(batch.column("text").to_pylist(), bounds, data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
