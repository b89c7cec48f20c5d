"""N-gram Jaccard join with prefix trees.

Every text is the set of its distinct word n-grams, as 64-bit hashes. Sets are put in one global order, rarest n-gram
first, so each set is a path in a trie. Two sets with a similarity of 0.8 share an n-gram among their first
``n - ceil(0.8 n) + 1``; the trie is therefore cut at these n-grams, and each makes a subtree that is joined by itself.
Equal sets are one path.

1. Parts exchange the first n-grams in hash order; sets of which too few are shared have no partner and end here.
2. The others exchange all n-grams and get back those that some other set holds, with their frequencies. A set of
   which less than 0.8 is shared ends here; the others now have their path.
3. In each subtree the most typical set (fewest n-grams of its own) is the pivot. Sets are verified against the pivot
   that they meet in most subtrees:
   the paths of a block of candidates are walked in order, what neighbours share is counted once, and a subtree is left
   as soon as the overlap so far and the remaining lengths cannot reach the bound. Links make components.
4. Pairs in one subtree but different components are all that is left. Further rounds take other pivots, and what then
   remains is verified pair by pair. So no link between components is lost, and no group of near copies is spelled out.

Defined results: a null text or one without words has an empty set and no links; texts of fewer words than ``n`` have
one n-gram; rows with equal ids (null is such an id) are nodes of their own, which are not compared with each other; null
ids rank behind all others and are null in the result; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import exchange, graph, texts
from rotorlake.operators.joins import fits_broadcast

WORDS = 5
ROUNDS = 3
BLOCK = 2000

_rng = np.random.default_rng(5)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COUNT = 0xA24BAED4963EE407
_KEY = np.uint64(0xFFFFFFFFFFFF0000)


def _sized(n: int) -> np.uint64:
    return np.uint64((n * _COUNT) & (1 << 64) - 1)


def needed(n):
    """Least overlap of a set of ``n`` with any partner: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def looked_at(n: int) -> int:
    """Number of first n-grams that are exchanged: so many that the first tenth of what a set shares with a partner
    is among them in both."""
    return n - needed(n) + -(-n // 10)


def prefix(n):
    """Number of first n-grams of which any partner shares one."""
    return n - needed(n) + 1


def sign(bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A hash of each text's words in order; 0 stands for no words. Texts with equal hashes have equal sets."""
    row, _, _, h = texts.word_hashes(bounds, data, texts.SPACED)
    at = np.searchsorted(row, np.arange(len(bounds)))
    return np.where(np.diff(at) > 0, texts.Sequences(h).between(at[:-1], at[1:]) | np.uint64(1), np.uint64(0))


def sets(bounds: np.ndarray, data: np.ndarray, words: int, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """The distinct n-grams in hash order of the wanted texts that have any, by row."""
    row, _, _, h = texts.word_hashes(bounds, data, texts.SPACED)
    first = np.searchsorted(row, np.arange(len(bounds))).tolist()
    total = np.full(max(0, len(h) - words + 1), _sized(words))
    for k in range(words):
        total += h[k : k + len(total)] * _PLACE[k]
    total, out = texts.mix(total), {}
    for r in np.flatnonzero(wanted).tolist():
        a, b = first[r], first[r + 1]
        if b - a >= words:
            own = np.sort(total[a : b - words + 1])
            new = np.empty(len(own), np.bool_)
            new[0] = True
            np.not_equal(own[1:], own[:-1], out=new[1:])
            out[r] = own[new]
        elif b > a:
            out[r] = texts.mix(np.sum(h[a:b] * _PLACE[: b - a], dtype=np.uint64, keepdims=True) + _sized(b - a))
    return out


def _run(keys: list[np.ndarray], docs: list[int], ones: bool = False) -> exchange.Run:
    """Entries of several sets with their documents; keys are cut to 48 bits, which only choose candidates."""
    sizes = list(map(len, keys))
    key = np.concatenate(keys) & _KEY if keys else np.zeros(0, np.uint64)
    value = np.repeat(exchange.ranked(np.array(docs, np.int64)), sizes)
    return exchange.condensed(key, value, value, *([np.ones(len(key), np.uint64)] if ones else []))


def _same(rows: pa.Table, _: exchange.Replies) -> dict[str, exchange.Run]:
    """Signs with their documents."""
    ids, signs = exchange.signed(rows)
    real = signs > 0
    doc = exchange.ranked(ids[real])
    return {"set": exchange.condensed(signs[real], doc, doc)}


def _leads(rows: pa.Table, replies: exchange.Replies) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, signs, first document with the same words, and whether the row stands for all of these."""
    ids, signs = exchange.signed(rows)
    hit, least, *_ = replies.find("set", signs)
    lead = np.where(hit, exchange.unranked(least), ids)
    own = np.flatnonzero((signs > 0) & (lead == ids))
    stands = np.zeros(len(ids), np.bool_)
    stands[own[np.unique(signs[own], return_index=True)[1]]] = True
    return ids, signs, lead, stands


def _standing(rows: pa.Table, replies: exchange.Replies, words: int):
    """Id and set of each text that stands for all with its words."""
    _, _, _, stands = _leads(rows, replies)
    at = 0
    for ids, bounds, data in exchange.documents(rows):
        for r, own in sets(bounds, data, words, stands[at : at + len(ids)]).items():
            yield int(ids[r]), own
        at += len(ids)


def _first(rows: pa.Table, replies: exchange.Replies, words: int) -> dict[str, exchange.Run]:
    """The first n-grams in hash order of each set."""
    made, keys, docs = [], [], []
    for doc, own in _standing(rows, replies, words):
        keys.append(own[: looked_at(len(own))])
        docs.append(doc)
        if len(keys) == 2000:
            made.append(_run(keys, docs))
            keys, docs = [], []
    made.append(_run(keys, docs))
    return {"first": exchange.condensed(*map(np.concatenate, zip(*made, strict=True)))}


def _open(own: np.ndarray, replies: exchange.Replies) -> bool:
    """Whether enough of a set's first n-grams are shared for it to have a partner."""
    lead = own[: looked_at(len(own))] & _KEY
    # The smaller partner has at least needed(n) n-grams and has sent a tenth of what is shared too.
    return int(replies.find("first", lead)[0].sum()) >= -(-needed(len(own)) // 10)


def _tokens(rows: pa.Table, replies: exchange.Replies, words: int) -> dict[str, exchange.Run]:
    """All n-grams of the sets that may have a partner."""
    made, keys, docs = [], [], []
    for doc, own in _standing(rows, replies, words):
        if _open(own, replies):
            keys.append(own)
            docs.append(doc)
            if len(keys) == 1000:
                made.append(_run(keys, docs, ones=True))
                keys, docs = [], []
    made.append(_run(keys, docs, ones=True))
    return {"token": exchange.condensed(*map(np.concatenate, zip(*made, strict=True)))}


def paths(parts: exchange.Parts, words: int) -> DataFrame:
    """One row per document: doc_id, n, set (hash), doc (first document with that set), rare, path.

    ``path`` has the shared n-grams in global order, ``rare`` is the number of the others, which come before them. Only
    the first document of a set that may have partners has a path.
    """
    same = exchange.ask(exchange.Parts(parts.table.select("part", "ids", "signs"), parts.count), _same, {"set": (1,)})
    first = exchange.ask(parts, lambda rows, back: _first(rows, back, words), {"first": ()}, same)
    known = same.unionByName(first)
    tokens = exchange.ask(parts, lambda rows, back: _tokens(rows, back, words), {"token": (3,)}, known)

    def ordered(rows: pa.Table, back: pa.Table) -> pa.Table:
        replies = exchange.Replies(back)
        ids, signs, lead, stands = _leads(rows, replies)
        size, rare, path = np.zeros(len(ids), np.int64), [None] * len(ids), [None] * len(ids)
        at = 0
        for piece, bounds, data in exchange.documents(rows):
            for r, own in sets(bounds, data, words, np.ones(len(piece), np.bool_)).items():
                size[at + r] = len(own)
                if stands[at + r] and _open(own, replies):
                    shared, count, *_ = replies.find("token", own & _KEY)
                    if int(shared.sum()) >= needed(len(own)):
                        rare[at + r] = len(own) - int(shared.sum())
                        path[at + r] = own[shared][np.argsort(count[shared], kind="stable")].tobytes()
            at += len(piece)
        none = signs == 0
        columns = [
            pa.array(ids, mask=ids == exchange.NO_ID),
            pa.array(size),
            pa.array(signs.view(np.int64), mask=none),
            pa.array(lead, mask=none),
            pa.array(rare, pa.int64()),
            pa.array(path, pa.binary()),
        ]
        return pa.table(columns, names=["doc_id", "n", "set", "doc", "rare", "path"])

    known = known.unionByName(tokens)
    schema = "doc_id long, n long, set long, doc long, rare long, path binary"
    return graph.kept(parts.table.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(ordered, schema), "paths")


def subtrees(found: DataFrame) -> DataFrame:
    """Rows (token, set, n, rare, at: place in the set's order) for the shared n-grams among each set's first ones."""

    def cut(batches):
        for batch in batches:
            made = [[], [], [], [], []]
            for s, n, rare, path in zip(*(batch.column(c).to_pylist() for c in ("set", "n", "rare", "path")), strict=True):
                own = np.frombuffer(path, np.int64)[: max(0, prefix(n) - rare)]
                for column, x in zip(made, (own, [s] * len(own), [n] * len(own), [rare] * len(own), np.arange(rare, rare + len(own))), strict=True):
                    column.append(np.asarray(x, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in made], names=["token", "set", "n", "rare", "at"])

    rows = found.where("path is not null").select("set", "n", "rare", "path")
    return graph.kept(rows.mapInArrow(cut, "token long, set long, n long, rare long, at long"), "subtrees")


def walk(pivot: list[int], pivot_size: int, members: list[tuple[int, int, list[int]]]) -> list[int]:
    """Members (id, size, path) whose similarity with the pivot reaches 0.8, by one walk over their trie.

    Paths in order visit the trie depth first: what a path shares with the one before keeps its overlap.
    """
    place = {t: k for k, t in enumerate(pivot, 1)}
    members = sorted(members, key=lambda m: m[2])
    overlap, last, before, found = [0], [0], [], []
    for name, size, path in members:
        bound = -(-4 * (size + pivot_size) // 9)
        depth, end = 0, min(len(path), len(before), len(overlap) - 1)
        while depth < end and path[depth] == before[depth]:
            depth += 1
        del overlap[depth + 1 :], last[depth + 1 :]
        before, total, reached, alive = path, overlap[-1], last[-1], True
        n = len(path)
        for k in range(depth, n):
            # What is left of either path bounds the overlap below this node.
            if total + min(n - k, len(pivot) - reached) < bound:
                alive = False
                break
            at = place.get(path[k])
            if at is not None:
                total += 1
                reached = max(reached, at)
            overlap.append(total)
            last.append(reached)
        if alive and total >= bound:
            found.append(name)
    return found


def verify(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that are links; the candidates of a ``b`` are dealt into blocks."""
    rows = found.where("path is not null").select("set", "n", "path")
    blocks = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"))
    dealt = graph.kept(dealt, "candidates")
    members = dealt.join(rows.withColumnRenamed("set", "a"), "a")
    pivots = dealt.select("b", "block").distinct().join(rows.withColumnRenamed("set", "b"), "b")
    pivots = pivots.select(F.col("b").alias("p_b"), F.col("block").alias("p_block"), F.col("n").alias("p_n"), F.col("path").alias("p_path"))

    def join(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        one = right.to_pylist()[0]
        members = [(m["a"], m["n"], np.frombuffer(m["path"], np.int64).tolist()) for m in left.to_pylist()]
        got = walk(np.frombuffer(one["p_path"], np.int64).tolist(), one["p_n"], members)
        return pa.table({"a": pa.array(got, pa.int64()), "b": pa.array([one["p_b"]] * len(got), pa.int64())})

    out = members.groupBy("b", "block").cogroup(pivots.groupBy("p_b", "p_block")).applyInArrow(join, "a long, b long")
    return graph.kept(out, "links")


def _may_link():
    """Whether two sets that meet in a subtree can be a link with nothing shared before it.

    Sizes n and m must allow a similarity of 0.8, and what either set holds from its place on must reach the overlap of
    4/9 (n + m). A link passes in the subtree of its first shared n-gram.
    """
    n, m = F.col("n"), F.col("m")
    sizes = (5 * n >= 4 * m) & (5 * m >= 4 * n)
    return sizes & (9 * (n - F.col("at")) >= 4 * (n + m)) & (9 * (m - F.col("at_b")) >= 4 * (n + m))


def join(found: DataFrame) -> DataFrame:
    """Rows (node, root) of the components of sets with more than one member."""
    trees = subtrees(found)
    typical = F.struct((F.col("rare") / F.col("n")).alias("own"), F.col("set").alias("b"), F.col("n").alias("m"), F.col("at").alias("at_b"))
    pivots = trees.groupBy("token").agg(F.min(typical).alias("p")).select("token", "p.b", "p.m", "p.at_b")
    near = trees.join(pivots, "token").where((F.col("set") != F.col("b")) & _may_link())
    # Of a set's pivots the one that it meets most often.
    near = near.groupBy("set", "b").agg(F.count(F.lit(1)).alias("c")).groupBy("set").agg(F.max(F.struct("c", "b")).alias("x"))
    pairs = graph.kept(near.select(F.col("set").alias("a"), F.col("x.b").alias("b")), "pairs")
    tried = pairs
    roots = graph.components(verify(pairs, found))
    for turn in range(ROUNDS):
        placed = trees.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
        open_ = graph.kept(placed.join(mixed, "token"), "open")
        if not open_.take(1):
            return roots
        # The component with most members of a subtree is the main one; the others look for links into it.
        size = open_.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
        main = size.groupBy("token").agg(F.max(F.struct("c", "root")).alias("x")).select("token", F.col("x.root").alias("main"))
        placed = open_.join(main, "token")
        others = placed.where("root <> main").select("token", F.col("set").alias("b"), F.col("n").alias("m"), F.col("at").alias("at_b"), F.col("root").alias("root_b"))
        if turn < ROUNDS - 1:
            draw = F.struct(F.xxhash64("b", F.lit(turn)), "b", "m", "at_b", "root_b")
            others = others.groupBy("token").agg(F.min(draw).alias("x")).select("token", "x.b", "x.m", "x.at_b", "x.root_b")
        near = placed.join(others, "token").where((F.col("root") != F.col("root_b")) & _may_link())
        near = near.select(F.least("set", "b").alias("a"), F.greatest("set", "b").alias("b")).distinct()
        near = graph.kept(near.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
        if not near.take(1):
            continue
        new = verify(near, found)
        tried = tried.union(near)
        if new.take(1):
            roots = graph.components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(new))
    return roots


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that its links reach)."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = paths(exchange.spread(source, sign=sign), words)
    roots = join(found)
    named = found.where("path is not null").select("set", "doc").join(roots.withColumnRenamed("node", "set"), "set", "left")
    named = named.withColumn("root", F.coalesce("root", "set"))
    low = named.groupBy("root").agg(F.min("doc").alias("low"))
    low = named.join(low, "root").groupBy("set").agg(F.min("low").alias("low"))
    out = found.select("doc_id", "n", "set", "doc").join(low, "set", "left")
    component = F.coalesce("low", "doc", "doc_id")
    none = F.lit(int(exchange.NO_ID))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(component != none, component).alias("component_id"))


def clean(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents with all columns, of each class exactly one row.

    That is the row with the smallest id, a null id behind all others; among equal ids the one whose hash of id and text
    is smallest, and among rows that are equal in both the one whose hash of all columns is. Rows without words are in no
    class and stay.
    """
    # Columns are found by place, so that further ones may have any name.
    names = [f"_{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    doc_id = doc_id.cast("long")
    ids = plain.groupBy(doc_id.alias("id")).agg(F.count(F.lit(1)).alias("c"))
    if not ids.where("c > 1 or id is null").take(1):
        found = classes(plain.select(doc_id.alias("doc_id"), text.alias("text")), words=words)
        gone = graph.kept(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")), "gone")
        return plain.join(F.broadcast(gone) if fits_broadcast(gone) else gone, doc_id == gone["gone"], "left_anti").toDF(*docs.columns)
    # Ids do not name rows: a hash of id and text does, so that texts of one id are compared with each other too.
    named = plain.withColumn("row", F.xxhash64(doc_id.isNull(), doc_id, text))
    found = classes(named.select(F.col("row").alias("doc_id"), text.alias("text")), words=words).where("n_shingles > 0")
    found = found.groupBy(F.col("doc_id").alias("row")).agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("c"))
    order = named.groupBy("row").agg(F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"))).alias("at"))
    found = graph.kept(found.join(order, "row"), "rows")
    stays = found.groupBy("component").agg(F.min(F.struct("at", "row")).alias("x")).select(F.col("x.row").alias("row"))
    gone = graph.kept(found.join(stays, "row", "left_anti").select("row"), "gone")
    left = named.join(F.broadcast(gone) if fits_broadcast(gone) else gone, "row", "left_anti")
    twice = graph.kept(found.where("c > 1").join(stays, "row").select("row"), "twice")
    if twice.take(1):
        twice = F.broadcast(twice) if fits_broadcast(twice) else twice
        # Aggregated where the rows lie first, so that a row repeated in all of the table is not sent.
        one = left.join(twice, "row", "left_semi").groupBy("row").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("x"))
        left = left.join(twice, "row", "left_anti").select(*names).unionByName(one.select("x.*"))
    return left.select(*names).toDF(*docs.columns)
