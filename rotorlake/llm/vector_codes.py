"""Vectors as codes: each of some equal parts is replaced by the index of the nearest entry of its own codebook.

Lloyd's rounds run on two trees. Vectors are cut into blocks; in each block and part position the points form a tree of
halves along the widest side, whose nodes hold their box, the sum of their points and their number. The entries of a
codebook form such a tree, too. A round goes down both trees at once: the distance of a node pair lies between the
nearest and the farthest points of the two boxes, so entry nodes that are farther than some other's farthest point are
left out. Where one entry is left, the whole node goes to it by its cached sum; points of a leaf where several are left
are measured against these in whole numbers. The bounds are whole numbers as well, so nothing hangs on rounding.

The blocks with their trees are written to the shared folder once; every round reads them, and only entry sums, bounded
by the codebooks, are shuffled and come to the driver.

Defined results: vectors that are null or hold a null or a value that is not finite take no part; vectors shorter than
the longest, and lengths that the parts do not divide, are filled with 0; scaled components beyond the limit where
squared distances of a vector no longer fit 62 bits count as that limit; with fewer vectors than entries there are so
many entries less; of equal entries the first is used; the first entries go by id (null last), then by the vector;
repeated rows each count; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm.graph import kept
from rotorlake.llm.order import lookup
from rotorlake.llm.topk import _matrix, integers, valid

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components of a block of vectors, points of a leaf, and (node, entry) coordinates that are bounded at once.
BLOCK_VALUES = 1 << 19
LEAF = 32
AT_ONCE = 1 << 20


class Tree:
    """Halves of a set of points, level by level, each with its box and its sum; nodes of a level differ by one point."""

    def __init__(self, points: np.ndarray, leaf: int, sorted_: bool = False) -> None:
        n = len(points)
        self.order = np.arange(n)
        cuts = [np.array([0, n])]
        while np.diff(cuts[-1]).max(initial=0) > leaf:
            ends = cuts[-1]
            middle = (ends[:-1] + ends[1:]) // 2
            if not sorted_ and points.shape[1]:
                for lo, mid, hi in zip(ends[:-1].tolist(), middle.tolist(), ends[1:].tolist(), strict=True):
                    if hi - lo > 1:
                        mine = points[self.order[lo:hi]]
                        side = int(np.argmax(mine.max(0) - mine.min(0)))
                        self.order[lo:hi] = self.order[lo:hi][np.argpartition(mine[:, side], mid - lo)]
            cuts.append(np.append(0, np.stack([middle, ends[1:]], axis=1).ravel()))
        self.cuts, self.points = cuts, points if sorted_ else points[self.order]
        # A node without points (only in trees of single entries) borrows a box; walks leave it out.
        starts = [np.minimum(c[:-1], max(0, n - 1)) for c in cuts]
        self.low = [np.minimum.reduceat(self.points, s, axis=0) for s in starts]
        self.high = [np.maximum.reduceat(self.points, s, axis=0) for s in starts]
        self.sums = [np.add.reduceat(self.points, s, axis=0) for s in starts]

    @property
    def depth(self) -> int:
        return len(self.cuts) - 1


def _far_near(a: Tree, la: int, na: np.ndarray, b: Tree, lb: int, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of the farthest and the nearest points of the boxes of node pairs."""
    far, near = np.empty(len(na), np.int64), np.empty(len(na), np.int64)
    step = max(1, AT_ONCE // max(1, a.points.shape[1]))
    for at in range(0, len(na), step):
        x, y = na[at : at + step], nb[at : at + step]
        right, left = b.high[lb][y] - a.low[la][x], a.high[la][x] - b.low[lb][y]
        most = np.maximum(right, left)
        gap = np.maximum(0, np.maximum(-right, -left))
        far[at : at + step], near[at : at + step] = (most * most).sum(1), (gap * gap).sum(1)
    return far, near


def _groups(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal numbers."""
    starts = np.flatnonzero(np.append(True, p[1:] != p[:-1])) if len(p) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(p)))


def nearest(points: Tree, entries: Tree) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], list[tuple[int, int, np.ndarray]]]:
    """What a walk down both trees settles: whole nodes (level, nodes, entry), and leaves (from, to, entries left).

    Entries are numbers of nodes of the lowest level of their tree, where each node holds one entry or none.
    """
    whole, open_ = [], []
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    lp = le = 0
    while True:
        # Pairs are sorted by point node. The least far distance of a node bounds the distance of all its points.
        far, near = _far_near(points, lp, p, entries, le, e)
        starts, sizes = _groups(p)
        keep = near <= np.repeat(np.minimum.reduceat(far, starts), sizes)
        p, e = p[keep], e[keep]
        if le == entries.depth:
            starts, sizes = _groups(p)
            alone = np.repeat(sizes == 1, sizes)
            whole.append((lp, p[alone], e[alone]))
            p, e = p[~alone], e[~alone]
        if not len(p):
            return whole, open_
        starts, sizes = _groups(p)
        if le == entries.depth and lp == points.depth:
            cut = points.cuts[lp]
            for lo, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                open_.append((int(cut[p[lo]]), int(cut[p[lo] + 1]), e[lo : lo + n]))
            return whole, open_
        if lp < points.depth:
            # Both halves of a node keep its entry nodes.
            long = np.repeat(sizes, 2)
            take = np.arange(long.sum()) + np.repeat(np.repeat(starts, 2) - np.append(0, np.cumsum(long)[:-1]), long)
            p, e = np.repeat(2 * np.repeat(p[starts], 2) + np.tile([0, 1], len(starts)), long), e[take]
            lp += 1
        if le < entries.depth:
            p, e = np.repeat(p, 2), (2 * e[:, None] + [0, 1]).ravel()
            le += 1
            full = np.diff(entries.cuts[le])[e] > 0
            p, e = p[full], e[full]


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances in whole numbers, by fast products where every sum on the way is below 2^53."""
    reach = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4.0 * float(reach) ** 2 * max(1, points.shape[1]) < 2**53:
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(points), len(entries)), np.int64)
    for k, entry in enumerate(entries):
        out[:, k] = ((points - entry) ** 2).sum(1)
    return out


class Book:
    """One part's entries as a tree; of equal entries only the first is in it."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        _, first = np.unique(entries, axis=0, return_index=True) if entries.shape[1] else (None, np.zeros(1, np.int64))
        first.sort()
        self.tree = Tree(entries[first], 1)
        cut = self.tree.cuts[-1]
        #: Index of the entry at each node of the lowest level.
        self.index = first[self.tree.order[np.minimum(cut[:-1], len(first) - 1)]]

    def codes(self, points: Tree) -> np.ndarray:
        """Index of the nearest entry for each point, in the tree's order; the smallest of equals."""
        out = np.empty(len(points.points), np.int64)
        whole, open_ = nearest(points, self.tree)
        for level, nodes, entry in whole:
            cut = points.cuts[level]
            for node, e in zip(nodes.tolist(), self.index[entry].tolist(), strict=True):
                out[cut[node] : cut[node + 1]] = e
        for lo, hi, entry in open_:
            out[lo:hi] = self._best(points.points[lo:hi], entry)
        return out

    def sums(self, points: Tree) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the points of each entry; whole nodes add the sums that they hold."""
        total, count = np.zeros(self.entries.shape, np.int64), np.zeros(len(self.entries), np.int64)
        whole, open_ = nearest(points, self.tree)
        for level, nodes, entry in whole:
            np.add.at(total, self.index[entry], points.sums[level][nodes])
            np.add.at(count, self.index[entry], np.diff(points.cuts[level])[nodes])
        for lo, hi, entry in open_:
            mine = points.points[lo:hi]
            best = self._best(mine, entry)
            np.add.at(total, best, mine)
            np.add.at(count, best, 1)
        return total, count

    def _best(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        left = np.sort(self.index[nodes])
        return left[np.argmin(distances(points, self.entries[left]), axis=1)]


def _lists(column: pa.Array, at: int, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column.slice(at, n))


def _blocks(parts: int, width: int, rows: int, leaf: int):
    """Batches (id, label, v) to one row a block: ids, labels, and each part's points and their order in its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                n = min(rows, batch.num_rows - at)
                x = _matrix(batch.column(2).slice(at, n), parts * width)
                size = np.abs(x).max(initial=0)
                kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"
                trees = [Tree(x[:, k * width : (k + 1) * width], leaf) for k in range(parts)]
                order = [t.order.astype("<i4").tobytes() for t in trees]
                points = [t.points.astype(kind).tobytes() for t in trees]
                columns = [_lists(batch.column(0), at, n), _lists(batch.column(1), at, n), pa.array([n]), pa.array([kind]), pa.array([order], pa.list_(pa.binary())), pa.array([points], pa.list_(pa.binary()))]
                yield pa.record_batch(columns, ["ids", "labels", "n", "kind", "orders", "points"])

    return run


def _tree(points: bytes, kind: str, n: int, width: int, leaf: int) -> Tree:
    return Tree(np.frombuffer(points, kind).reshape(n, width).astype(np.int64), leaf, sorted_=True)


def _summed(books: list[np.ndarray], width: int, leaf: int):
    """Blocks (n, kind, points) to rows (part, entry, side, total); side -1 is the number of points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        total = [np.zeros((len(b), width + 1), np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                n, kind, points = (batch.column(k)[row].as_py() for k in range(3))
                for part, book in enumerate(own):
                    s, c = book.sums(_tree(points[part], kind, n, width, leaf))
                    total[part][:, 1:] += s
                    total[part][:, 0] += c
        for part, t in enumerate(total):
            entry, side = np.nonzero(t)
            yield pa.record_batch([pa.array(np.full(len(entry), part)), pa.array(entry), pa.array(side - 1), pa.array(t[entry, side])], ["part", "entry", "side", "total"])

    return run


def _coded(books: list[np.ndarray], width: int, leaf: int):
    """Blocks to rows (id, label, code, error)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books if len(b)]
        for batch in batches:
            for row in range(batch.num_rows):
                n, kind, orders, points = (batch.column(k)[row].as_py() for k in range(2, 6))
                codes, error = np.empty((n, len(own)), np.uint8), np.zeros(n, np.int64)
                for part, book in enumerate(own):
                    tree = _tree(points[part], kind, n, width, leaf)
                    found, order = book.codes(tree), np.frombuffer(orders[part], "<i4")
                    codes[order, part] = found
                    error[order] += ((tree.points - book.entries[found]) ** 2).sum(1)
                text = codes.tobytes().hex()
                step = 2 * len(own)
                code = pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string())
                yield pa.record_batch([batch.column(0)[row].values, batch.column(1)[row].values, code, pa.array(error)], ["id", "label", "code", "error"])

    return run


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    leaf: int = LEAF,
    block_values: int = BLOCK_VALUES,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows (id, label, code, error) of the vectors, and the codebook of each part."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part")
    rows = vectors.where(valid(vector)).select(F.col(vec_id).alias("id"), F.col(label).alias("label"), integers(vector, scale).alias("v"))
    id_type, label_type = (rows.schema[x].dataType.simpleString() for x in ("id", "label"))
    terms = rows.agg(F.max(F.size("v"))).first()[0]
    width = -(-(terms or 0) // parts)
    limit = math.isqrt((1 << 62) // max(1, parts * width)) // 2
    rows = rows.withColumn("v", F.transform("v", lambda x: F.greatest(F.least(x, F.lit(limit)), F.lit(-limit))))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.array([r.v + [0] * (parts * width - len(r.v)) for r in first], np.int64).reshape(len(first), parts * width)
    books = [start[:, k * width : (k + 1) * width] for k in range(parts)]
    schema = f"ids array<{id_type}>, labels array<{label_type}>, n long, kind string, orders array<binary>, points array<binary>"
    per = max(1, block_values // max(1, parts * width))
    blocks = kept(rows.mapInArrow(_blocks(parts, width, per, leaf), schema), "vector-blocks")
    for _ in range(rounds if len(first) else 0):
        found = blocks.select("n", "kind", "points").mapInArrow(_summed(books, width, leaf), "part long, entry long, side long, total long")
        found = found.groupBy("part", "entry", "side").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        total = {(r.part, r.entry, r.side): int(r.total) for r in found.collect()}
        books = [b.copy() for b in books]
        for part, entry in {k[:2] for k in total}:
            n = total[part, entry, -1]
            books[part][entry] = [total.get((part, entry, side), 0) // n for side in range(width)]
    coded = blocks.mapInArrow(_coded(books, width, leaf), f"id {id_type}, label {label_type}, code string, error long")
    return kept(coded, "vector-codes"), books


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The errors summed over each label, nulls together, beside every row; null where the sum passes 64 bits."""
    rows = coded.withColumn("of", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = rows.groupBy("of").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("uses"))
    return lookup(rows, sums, "of", "uses").drop("of")
