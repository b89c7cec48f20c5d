"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds all word sequences of all items. A document's words are streamed through it; the state keeps the
longest suffix of the words read so far that occurs in some item. Where that length reaches the window, the window's
words are hit. An item shorter than the window, but not empty, is a window as a whole.

Items are packed into automata of at most ``MAX_ITEM_WORDS`` words. Documents pass one automaton after the other in
the same task, so no number of items makes a broadcast larger than that, and documents are never shuffled.

Defined results: a null or empty text has no words and no hits; null and empty items are no windows; repeated rows
and repeated items each count for themselves by their ids; an empty benchmark hits nothing. Columns of the input
other than the id and the text play no part, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts

WINDOW = 10
MAX_ITEM_WORDS = 1_000_000


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window.

    Nearly all states have one way on, which is held in arrays; only states with several have a table of the others.
    """

    def __init__(self, items: list[tuple[str, list[int]]], window: int) -> None:
        self.window = window
        #: By state: the word of its first way on and where that leads, the suffix link, the longest sequence.
        self.word, self.to, self.link, self.length = (array("i", [-1]) for _ in range(4))
        self.length[0] = 0
        self.more: dict[int, dict[int, int]] = {}
        self.names = [name for name, words in items if words]
        sequences = [words for _, words in items if words]
        for words in sequences:
            last = 0
            for w in words:
                last = self._extend(last, w)
        held = array("q")
        #: By state: length and number of short items that end there.
        self.short: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(sequences):
            state = length = 0
            for k, w in enumerate(words):
                state, length = self.step(state, length, w)
                if k + 1 >= window:
                    held.append(self.window_state(state) << 32 | number)
            if len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(words), number))
        # The items that hold the window of a state (which stands for one window at most), side by side.
        pairs = np.unique(np.frombuffer(held, np.int64)) if held else np.zeros(0, np.int64)
        self.item_states, self.item_numbers = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32)

    def _on(self, state: int, w: int) -> int:
        """Where a word leads from a state, or -1."""
        if self.word[state] == w:
            return self.to[state]
        others = self.more.get(state)
        return -1 if others is None else others.get(w, -1)

    def _lead(self, state: int, w: int, target: int) -> None:
        if self.word[state] in (-1, w):
            self.word[state], self.to[state] = w, target
        else:
            self.more.setdefault(state, {})[w] = target

    def _state(self, word: int, to: int, link: int, length: int) -> int:
        for column, x in ((self.word, word), (self.to, to), (self.link, link), (self.length, length)):
            column.append(x)
        return len(self.word) - 1

    def _extend(self, last: int, w: int) -> int:
        q = self._on(last, w)
        if q >= 0:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        new = self._state(-1, -1, 0, self.length[last] + 1)
        p = last
        while p >= 0 and self._on(p, w) < 0:
            self._lead(p, w, new)
            p = self.link[p]
        if p >= 0:
            q = self._on(p, w)
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.word[q], self.to[q], self.link[q], self.length[p] + 1)
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        while p >= 0 and self._on(p, w) == q:
            self._lead(p, w, copy)
            p = self.link[p]
        self.link[q] = copy
        return copy

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """State and longest matching length after one more word."""
        word, more = self.word, self.more
        while True:
            if word[state] == w:
                return self.to[state], length + 1
            if state in more and w in more[state]:
                return more[state][w], length + 1
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]

    def window_state(self, state: int) -> int:
        """The state of the window that ends here; the length must reach the window."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[int], hit: np.ndarray, at: int, found: set[str]) -> int:
        """Stream words, mark ``hit`` from place ``at`` on and collect items; the longest match is returned."""
        state = length = longest = 0
        windows, short = set(), set()
        for k, w in enumerate(words, at):
            state, length = self.step(state, length, w)
            longest = max(longest, length)
            if length >= self.window:
                hit[k - self.window + 1 : k + 1] = True
                windows.add(self.window_state(state))
            if self.short:
                s, left = state, length
                while s > 0:
                    for n, number in self.short.get(s, ()):
                        if n <= left:
                            hit[k - n + 1 : k + 1] = True
                            short.add(number)
                    s = self.link[s]
                    left = self.length[s]
        # Items are named once for each window that occurs, not for each place.
        if windows:
            states = np.array(sorted(windows))
            ends = (np.searchsorted(self.item_states, states, side) for side in ("left", "right"))
            for a, b in zip(*(x.tolist() for x in ends), strict=True):
                short.update(self.item_numbers[a:b].tolist())
        found.update(self.names[number] for number in short)
        return longest


class Index:
    """What a task needs: the automaton and the words' numbers, built from one shard of items."""

    def __init__(self, rows: list[tuple[str, str | None]], window: int) -> None:
        hashes, sizes = [], []
        for _, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            hashes.append(texts.word_hashes(np.array([0, len(data)]), data, texts.ALNUM)[3])
            sizes.append(len(hashes[-1]))
        self.vocabulary, numbers = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_inverse=True)
        split = np.split(numbers, np.cumsum(sizes)[:-1]) if sizes else []
        items = [(name, list(map(int, x))) for (name, _), x in zip(rows, split, strict=True)]
        self.automaton = Automaton(items, window)
        self.shortest = min([min(n, window) for n in sizes if n], default=0)

    def hits(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]], dict[int, int]]:
        """Hit words, items by row, longest match by row, for all words of a piece."""
        hit = np.zeros(len(h), np.bool_)
        items: dict[int, set[str]] = {}
        longest: dict[int, int] = {}
        if not self.shortest or not len(h):
            return hit, items, longest
        number = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[number] == h
        # A match lies within known words of one text: only such runs, long enough for a window, are streamed.
        edge = np.flatnonzero(np.diff(known.astype(np.int8), prepend=0, append=0) != 0)
        cut = np.flatnonzero(np.diff(row)) + 1
        starts, ends = edge[::2], edge[1::2]
        inner = cut[(known[cut] & known[cut - 1])] if len(cut) else cut
        starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
        for s, e in zip(*(x[ends - starts >= self.shortest].tolist() for x in (starts, ends)), strict=True):
            r, found = int(row[s]), set()
            length = self.automaton.scan(number[s:e].tolist(), hit, s, found)
            longest[r] = max(longest.get(r, 0), length)
            if found:
                items.setdefault(r, set()).update(found)
        return hit, items, longest


def shards(benchmark: DataFrame, item_id: str, text: str, max_words: int = MAX_ITEM_WORDS) -> Iterator[list]:
    """Items in groups whose words number about ``max_words`` at most; one group at a time is on the driver."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where(F.length("t") > 0)
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // (2 * max_words)))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i if r.i is not None else "", r.t) for r in part.collect()]


def _runs(mask: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)


def match(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """One row per document: id, text, n_words, hit (word places as from, to pairs), items, longest (words)."""
    sc = docs.sparkSession.sparkContext
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("hit"),
        F.array().cast("array<string>").alias("items"),
        F.lit(0).cast("long").alias("longest"),
    )
    schema = found.schema
    for rows in shards(benchmark, item_id, item_text, max_item_words):
        held = sc.broadcast(rows)

        def add(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Index(held.value, window)
            for batch, bounds, data in texts.pieces(batches, "text"):
                row, _, _, h = texts.word_hashes(bounds, data, texts.ALNUM)
                hit, items, longest = index.hits(row, h)
                first = np.searchsorted(row, np.arange(batch.num_rows + 1))
                old = batch.to_pydict() if (touched := sorted({*items, *longest})) else {}
                hits, names, most = batch.column("hit"), batch.column("items"), batch.column("longest")
                if touched:
                    new = {c: list(old[c]) for c in ("hit", "items", "longest")}
                    for r in touched:
                        mask = hit[first[r] : first[r + 1]]
                        if len(new["hit"][r]):
                            for a, b in zip(new["hit"][r][::2], new["hit"][r][1::2], strict=True):
                                mask[a:b] = True
                        new["hit"][r] = _runs(mask).ravel().tolist()
                        new["items"][r] = sorted({*new["items"][r], *items.get(r, ())})
                        new["longest"][r] = max(new["longest"][r], longest.get(r, 0))
                    hits = pa.array(new["hit"], pa.list_(pa.int64()))
                    names = pa.array(new["items"], pa.list_(pa.string()))
                    most = pa.array(new["longest"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(np.diff(first)), hits, names, most],
                    names=["doc_id", "text", "n_words", "hit", "items", "longest"],
                )

        found = found.mapInArrow(add, schema)
    return found


def hit_words(hit: str = "hit"):
    """Number of hit words of a row of ``match``."""
    odd = F.filter(hit, lambda x, i: i % 2 == 1)
    even = F.filter(hit, lambda x, i: i % 2 == 0)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return total(odd) - total(even)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    max_coverage: float = 0.5,
    window: int = WINDOW,
    text: str = "text",
    max_item_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """The documents with all columns, hit spans cut out of the text: every window of ten words, every whole short item.

    A document of which more than ``max_coverage`` of the words are hit is dropped. Documents without hits stay as
    they are; words next to a cut keep their own white space. The hits of all automata are united before anything is
    cut or dropped, so that the result does not depend on their number.
    """
    # The text is found by place, so that further columns may have any name.
    place, names = docs.columns.index(text), [f"_{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    sc, schema = plain.sparkSession.sparkContext, plain.schema
    held = [sc.broadcast(rows) for rows in shards(benchmark, "item_id", "text", max_item_words)]
    marked = plain.withColumn("hit", F.array().cast("array<long>")).schema

    def cut(batch: pa.RecordBatch, bounds: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray, row: np.ndarray):
        value, keep = batch.column(place).to_pylist(), np.ones(batch.num_rows, np.bool_)
        for r in np.unique(row[hit]).tolist():
            mask = hit[first[r] : first[r + 1]]
            keep[r] = mask.mean() <= max_coverage
            own, at, kept = value[r].encode(), 0, []
            for a, b in _runs(mask).tolist():
                s, e = (int(x - bounds[r]) for x in (starts[first[r] + a], ends[first[r] + b - 1]))
                kept.append(own[at:s])
                at = e
            value[r] = b"".join([*kept, own[at:]]).decode()
        columns = batch.columns
        columns[place] = pa.array(value, pa.string())
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    for k, items in enumerate(held):

        def scan(batches: Iterator[pa.RecordBatch], items=items, fresh=k == 0, last=k == len(held) - 1) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, window)
            for batch, bounds, data in texts.pieces(batches, names[place]):
                row, starts, ends, h = texts.word_hashes(bounds, data, texts.ALNUM)
                hit, _, _ = index.hits(row, h)
                first = np.searchsorted(row, np.arange(batch.num_rows + 1))
                if not fresh:
                    for r, runs in enumerate(batch.column(len(names)).to_pylist()):
                        for a, b in zip(runs[::2], runs[1::2], strict=True):
                            hit[first[r] + a : first[r] + b] = True
                    batch = batch.select(names)
                if last:
                    yield cut(batch, bounds, first, starts, ends, hit, row) if hit.any() else batch
                else:
                    runs = [_runs(hit[a:b]).ravel().tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, pa.list_(pa.int64()))], names=[*names, "hit"])

        plain = plain.mapInArrow(scan, schema if k == len(held) - 1 else marked)
    return plain.toDF(*docs.columns)
