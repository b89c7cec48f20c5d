"""Encoding and decoding for SentencePiece vocabularies of the merge (BPE) type.

Symbols are merged by an agenda of adjacent symbol pairs whose concatenation is a piece: best score first, then leftmost. No piece of such a vocabulary holds a word mark behind another character, so merges never cross the place in
front of a mark; texts are cut there and equal words are merged once per worker. What is left and is no piece falls
back to byte pieces.

Each Arrow batch is checked: every word that the batch adds to the worker's memory is also encoded and decoded by the
sentencepiece library, and a difference ends the task.

Defined results: a null or empty text has no ids but the end id, and decodes to an empty text; repeated rows give
repeated results; columns other than id and text play no part.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts
from rotorlake.llm.memo import Memo, ranges

MARK = "▁"
#: Longest word, in characters, that is merged side by side with others.
LONG_WORD = 200
#: Words that a worker remembers; a worker lives on in the stages after this one.
MAX_WORDS = 700_000


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.get_piece_size()
        pieces = [lib.id_to_piece(k) for k in range(n)]
        special = [lib.is_control(k) or lib.is_unknown(k) or lib.is_unused(k) for k in range(n)]
        self.ids = {p: k for k, p in enumerate(pieces) if not special[k] and not lib.is_byte(k)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with an inner word mark are not supported")
        self.bytes = {int(pieces[k][3:5], 16): k for k in range(n) if lib.is_byte(k)}
        self.end = lib.eos_id()
        surface = [b"" if special[k] else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        for value, k in self.bytes.items():
            surface[k] = bytes([value])
        surface[lib.unk_id()] = " ⁇ ".encode()
        self.surface, self.digits = surface, [str(k) for k in range(n)]
        self.memo = Memo(self._learn, MAX_WORDS)
        # Every way to make a piece of two pieces, as left * n + right.
        made = [(self.ids[p[:k]] * n + self.ids[p[k:]], c) for p, c in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        self.pairs, order = np.unique(np.array([x for x, _ in made], np.int64), return_index=True)
        self.made = np.array([c for _, c in made], np.int64)[order]
        self.cost = np.array([-lib.get_score(k) for k in range(n)])
        self.n, self.pieces = n, pieces
        costs, rank = np.unique(self.cost, return_inverse=True)
        self.rank = rank.tolist()

    def _best(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair of symbols makes, and its cost; infinite if it makes none."""
        key = np.where((left < self.n) & (right < self.n), left * self.n + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.made[at], -1), np.where(hit, self.cost[self.made[at]], np.inf)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (with their marks) side by side, and the number of ids of each.

        The agendas of all words are kept side by side: in each round every word merges its best adjacent pair, the
        leftmost of equals, and the pairs next to the new symbol are looked up anew. Words without a pair are done.
        """
        chars = "".join(words)
        letters, code = np.unique(np.frombuffer(chars.encode("utf-32-le"), np.uint32), return_inverse=True)
        # A character that is no piece gets a number beyond the pieces, and no pair.
        known = np.array([self.ids.get(chr(c), self.n + k) for k, c in enumerate(letters)], np.int64)
        symbol = known[code]
        word = np.repeat(np.arange(len(words)), list(map(len, words)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece, cost = np.full(len(symbol), -1, np.int64), np.full(len(symbol), np.inf)
        if len(symbol) > 1:
            piece[:-1], cost[:-1] = self._best(symbol[:-1], symbol[1:])
            cost[:-1][word[1:] != word[:-1]] = np.inf
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(cost, starts), np.diff(starts, append=len(word)))
            over = np.isinf(best)
            if over.any():
                done.append((word[over], symbol[over]))
                symbol, word, piece, cost, best = (x[~over] for x in (symbol, word, piece, cost, best))
                if not len(symbol):
                    break
            at = np.flatnonzero(cost == best)
            at = at[np.diff(word[at], prepend=-1) != 0]
            symbol[at] = piece[at]
            stay = np.ones(len(symbol), np.bool_)
            stay[at + 1] = False
            symbol, word, piece, cost = (x[stay] for x in (symbol, word, piece, cost))
            at -= np.arange(len(at))
            near = np.concatenate([at, at[at > 0] - 1])
            near = near[near < len(symbol) - 1]
            piece[near], cost[near] = self._best(symbol[near], symbol[near + 1])
            cost[near[word[near] != word[near + 1]]] = np.inf
            cost[-1] = np.inf
        owner = np.concatenate([w for w, _ in done] or [np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        owner, ids = owner[order], np.concatenate([s for _, s in done] or [np.zeros(0, np.int64)])[order]
        if (ids >= self.n).any():
            fall = [[self.bytes[b] for b in chr(letters[k - self.n]).encode()] if k >= self.n else [k] for k in ids.tolist()]
            owner, ids = np.repeat(owner, list(map(len, fall))), np.array([x for f in fall for x in f], np.int64)
        return ids.astype(np.uint32), np.bincount(owner, minlength=len(words))

    def agenda(self, word: str) -> list[int]:
        """Ids of one long word: a heap of its adjacent pairs over linked symbols.

        An entry is the rank of the new piece's score and the place of its left symbol; it is out of date if the pair
        that now starts there makes no piece of that rank.
        """
        ids, pieces, rank = self.ids, self.pieces, self.rank
        symbol = [ids.get(c, -1) for c in word]
        n = len(symbol)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))

        def pair(left: int) -> int:
            """The piece that the symbol at a place makes with the one after it, or -1."""
            right = after[left]
            if right >= n or symbol[left] < 0 or symbol[right] < 0:
                return -1
            return ids.get(pieces[symbol[left]] + pieces[symbol[right]], -1)

        heap = [rank[made] << 40 | k for k in range(n) if (made := pair(k)) >= 0]
        heapify(heap)
        gone = bytearray(n)
        while heap:
            entry = heappop(heap)
            left = entry & (1 << 40) - 1
            if gone[left]:
                continue
            made = pair(left)
            if made < 0 or rank[made] != entry >> 40:
                continue
            right = after[left]
            symbol[left], gone[right], after[left] = made, 1, after[right]
            if after[left] < n:
                before[after[left]] = left
            for k in (left, before[left]):
                if k >= 0 and (new := pair(k)) >= 0:
                    heappush(heap, rank[new] << 40 | k)
        out = []
        for k, c in enumerate(word):
            if not gone[k]:
                out += [symbol[k]] if symbol[k] >= 0 else [self.bytes[b] for b in c.encode()]
        return out

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge new words, in groups of like length, and hold them against the library."""
        order = np.argsort(list(map(len, new)), kind="stable")
        words = [new[k].decode() for k in order.tolist()]
        marked = [w.replace(" ", MARK) for w in words]
        few = next((k for k, w in enumerate(marked) if len(w) > LONG_WORD), len(marked))
        ids, sizes = self.merged(marked[:few])
        # Rounds over all symbols would take the square of a long word's length. Lengths are in bytes, so that shorter
        # words may follow a long one.
        rest = [np.array(self.agenda(w), np.uint32) for w in marked[few:]]
        ids, sizes = np.concatenate([ids, *rest]), np.concatenate([sizes, np.array(list(map(len, rest)), np.int64)])
        ends = np.cumsum(sizes)
        # Words that end with a blank or mark would run into the next; the library sees each of them alone.
        alone = [k for k, w in enumerate(words) if w[-1] in (" ", MARK)]
        cuts = sorted({*range(0, len(words), 500), *alone, *(k + 1 for k in alone), len(words)})
        for a, b in zip(cuts, cuts[1:]):
            plain = "".join(words[a:b])[1:].replace(MARK, " ")
            own = ids[ends[a] - sizes[a] : ends[b - 1]].tolist()
            # An empty text has no mark for the library, but a word of a longer text has.
            if plain and (own != self.library.encode(plain) or self.library.decode(own) != plain):
                raise ValueError(f"differs from the library: {words[a:b]!r}")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return ids[ranges((ends - sizes)[back], sizes[back])], sizes[back]

    def encode(self, bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a piece side by side, without end ids, and the number of ids of each text."""
        full = np.flatnonzero(np.diff(bounds))
        data = np.insert(data, bounds[full], 0x20)
        bounds = bounds + np.searchsorted(full, np.arange(len(bounds)))
        cut = data == 0x20
        cut[1:] &= data[:-1] != 0x20
        mark = (data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81)
        cut[3:] &= ~mark
        cut[bounds[:-1][full]] = True
        starts = np.flatnonzero(cut)
        ids, sizes = self.memo.ids(data, starts, np.append(starts[1:], len(data)))
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.searchsorted(starts, bounds)])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces side by side, marks as blanks, without the blank that encoding put in front."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")

    def listed(self, ids: list[int]) -> str:
        """Decimal ids joined by one blank."""
        return " ".join(map(self.digits.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a model file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, digests of ids (with the end id) and decoded text; the ids."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch, bounds, data in texts.pieces(batches, "text"):
            whole, counts = code.encode(bounds, data)
            whole = np.insert(whole, np.cumsum(counts), np.uint32(code.end)).astype(np.int32)
            at = np.concatenate([[0], np.cumsum(counts + 1)])
            listed = whole.tolist()
            rows = [listed[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            columns = [
                batch.column("doc_id"),
                pa.array(counts + 1),
                pa.array([digest(code.listed(x)) for x in rows]),
                pa.array([digest(code.decode(x)) for x in rows]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(whole)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
