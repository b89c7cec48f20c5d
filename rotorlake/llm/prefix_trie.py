"""The trie of conversation prefixes, with totals of every subtree, by bands of depth.

A node is a distinct sequence of the first d turns (role, text); the root has none. Conversations are cut into bands of
``BAND`` turns. Within a band a node's name is a digest of the turns; the bands of a conversation are a sequence
themselves, which is named the same way, so that names take a number of rounds that is the logarithm of the depth to
the base ``BAND``, and no turn is hashed more than ``BAND`` times a round.

Subtree totals roll up alike. First every node explodes to its ancestors in its own band, at most ``BAND`` of them. The
tops of the bands, now with the totals of their bands, are a trie with one level for each band: it is rolled up by the
same method, after which their totals are complete. Each completed top then explodes to its ancestors in the band
above. A node takes its ancestors from the conversation that names it, so the explosion is a join on (conversation,
band), where a key has at most ``BAND`` rows, however many conversations share a node.

Defined results: turns with a null conversation take no part; a null role or text is empty; turns are ordered by number
(null first), then by the digest of role and text; repeated turns all count; a conversation that others take a head from
and that is not there has no turns; an empty table has no nodes, not even a root; other columns are ignored. Turns of
one conversation are numbered by a range sort, so one conversation may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.llm.graph import kept
from rotorlake.llm.order import lookup, numbered

BAND = 16
#: A head of at most HEAD turns comes from the first of FAMILY conversations.
HEAD, FAMILY = 8, 5
#: Rows of one conversation that meet its lengths in one join key.
CHUNK = 4096
#: Name of the root, and bytes of one piece of a list of conversations that ends at one node.
ROOT = ""
PIECE = 1 << 20


def digest(*parts: Column) -> Column:
    """128 bits of SHA-256, in hex."""
    return F.substring(F.sha2(F.concat(*parts).cast("binary"), 256), 1, 32)


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (c, turn, dig, n): a digest of each turn's role and text, and the bytes of the text."""
    r, t = (F.coalesce(F.col(x), F.lit("")) for x in (role, text))
    dig = digest(F.octet_length(r).cast("string"), F.lit(":"), r, t)
    rows = conversations.where(F.col(conv_id).isNotNull())
    return rows.select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"), dig.alias("dig"), F.octet_length(t).cast("long").alias("n"))


def sequences(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as they are: rows (c, d, dig, n, len) with places from 1, and (c, len) of all conversations."""
    rows, convs = _placed(rows)
    convs = convs.select("c", "first", F.col("own").alias("len"))
    found = rows.join(_chunks(convs, F.col("len")), ["c", "chunk"])
    return found.select("c", (F.col("g") - F.col("first") + 1).alias("d"), "dig", "n", "len"), convs.select("c", "len")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same with the first h turns, h = crc32(c) % 9, of each conversation c taken from conversation c - c % 5."""
    rows, convs = _placed(rows)
    convs = convs.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % (HEAD + 1)).withColumn("base", F.col("c") - F.col("c") % FAMILY)
    lengths = convs.select(F.col("c").alias("base"), F.least("own", F.lit(HEAD)).alias("head"))
    convs = convs.join(lengths, "base", "left").withColumn("head", F.least("h", F.coalesce("head", F.lit(0))))
    convs = kept(convs.withColumn("len", F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))), "trie-lengths")
    found = rows.join(_chunks(convs, F.col("own")), ["c", "chunk"]).withColumn("i", F.col("g") - F.col("first") + 1)
    tails = found.where("i > h").select("c", (F.col("i") - F.col("h") + F.col("head")).alias("d"), "dig", "n", "len")
    first = found.where((F.col("i") <= HEAD) & (F.col("c") % FAMILY == 0)).select(F.col("c").alias("base"), F.col("i").alias("d"), "dig", "n")
    heads = first.join(convs.select("base", "c", "head", "len"), "base").where("d <= head")
    return tails.unionByName(heads.select("c", "d", "dig", "n", "len")), convs.select("c", "len")


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their number g in the order of conversations and turns, and (c, first, own) of each conversation."""
    rows = numbered(rows, ["c", "turn", "dig", "n"], "g", "trie-turns")
    convs = rows.groupBy("c").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("own"))
    return rows.withColumn("chunk", F.floor(F.col("g") / CHUNK)), kept(convs, "trie-convs")


def _chunks(convs: DataFrame, own: Column) -> DataFrame:
    """Each conversation once for every chunk of numbers that it reaches into."""
    last = F.floor((F.col("first") + own - 1) / CHUNK)
    return convs.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("first") / CHUNK), last)))


def paths(seq: DataFrame, deepest: int, band: int, level: int = 0) -> DataFrame:
    """Rows (c, band, up, ids): the names of the nodes on a conversation's way through a band, and of the one before.

    ``seq`` has rows (c, pos, dig), positions from 0 to ``deepest``.
    """
    item = F.struct((F.col("pos") % band).alias("j"), "dig")
    rows = seq.groupBy("c", F.floor(F.col("pos") / band).alias("band")).agg(F.array_sort(F.collect_list(item))["dig"].alias("x"))
    part = F.transform("x", lambda _, j: digest(F.lit(f"{level} "), F.array_join(F.slice("x", 1, j + 1), "")))
    rows = rows.select("c", "band", part.alias("part"))
    if deepest < band:
        return rows.select("c", "band", F.lit(ROOT).alias("up"), F.col("part").alias("ids"))
    rows = kept(rows, "trie-bands")
    above = paths(rows.select("c", F.col("band").alias("pos"), F.element_at("part", -1).alias("dig")), deepest // band, band, level + 1)
    here = above.select("c", "band", "up", "ids", F.posexplode("ids").alias("j", "here"))
    before = F.when(F.col("j") == 0, F.col("up")).otherwise(F.get("ids", F.col("j") - 1))
    here = here.select("c", (F.col("band") * band + F.col("j")).alias("band"), before.alias("up"), "here")
    # The last node of a full band has the name that the level above gives to the band.
    name = F.transform("part", lambda p, j: F.when(j == band - 1, F.col("here")).otherwise(digest(F.lit(f"{level} "), F.col("up"), F.lit(" "), p)))
    return rows.join(here, ["c", "band"]).select("c", "band", "up", name.alias("ids"))


def subtree_sums(ways: DataFrame, values: DataFrame, deepest: int, band: int, sums: list[str]) -> DataFrame:
    """Rows (id, *sums): the sums of ``values`` over each node's subtree, itself included.

    ``ways`` has rows (c, band, ids); ``values`` has a row for each node: id, the conversation c that names it, its
    position pos on that conversation's way, and the values.
    """
    total = [F.sum(x).alias(x) for x in sums]
    own = values.withColumn("band", F.floor(F.col("pos") / band)).withColumn("j", F.col("pos") % band)
    own = own.join(ways.select("c", "band", "ids"), ["c", "band"])
    inside = own.select(F.explode(F.slice("ids", 1, F.col("j") + 1)).alias("id"), *sums).groupBy("id").agg(*total)
    if deepest < band:
        return inside
    inside = kept(inside, "trie-inside")
    tops = values.where(F.col("pos") % band == 0).select("id", "c", F.floor(F.col("pos") / band).alias("pos")).join(inside, "id")
    tops = kept(tops, "trie-tops")
    item = F.struct((F.col("band") % band).alias("j"), F.get("ids", 0).alias("id"))
    above = ways.groupBy("c", F.floor(F.col("band") / band).alias("up")).agg(F.array_sort(F.collect_list(item))["id"].alias("ids"))
    whole = subtree_sums(above.withColumnRenamed("up", "band"), tops, deepest // band, band, sums)
    whole = whole.join(tops.where("pos > 0").select("id", "c", (F.col("pos") - 1).alias("band")), "id")
    passed = whole.join(ways.select("c", "band", "ids"), ["c", "band"]).select(F.explode("ids").alias("id"), *sums)
    return inside.unionByName(passed).groupBy("id").agg(*total)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, c), sorted: the digest of each list that lies in this range, pieces of those that may go beyond it."""
    part, seq = TaskContext.get().partitionId(), 0
    names, sha, pieces = [], [], []
    last, held, first = None, b"", True

    def cut() -> None:
        nonlocal held, seq
        names.append((last, seq))
        sha.append(None)
        pieces.append(held)
        held, seq = b"", seq + 1

    def flush() -> pa.RecordBatch:
        n, q = [x for x, _ in names], [x for _, x in names]
        out = pa.record_batch([pa.array(n, pa.string()), pa.array([part] * len(n), pa.int64()), pa.array(q, pa.int64()), pa.array(sha, pa.string()), pa.array(pieces, pa.binary())], ["id", "part", "seq", "sha", "piece"])
        names.clear(), sha.clear(), pieces.clear()
        return out

    loose = False  # Whether pieces of the present list have gone already.
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_pylist()
        text = batch.column(1).cast(pa.string()).to_pylist()
        new = np.array([True] + [a != b for a, b in zip(ids, ids[1:], strict=False)])
        starts = np.flatnonzero(new).tolist()
        for lo, hi in zip(starts, starts[1:] + [len(ids)], strict=True):
            joined = ",".join(text[lo:hi]).encode()
            if ids[lo] != last:
                if last is not None:
                    if first or loose:
                        if held:
                            cut()
                    else:
                        names.append((last, 0))
                        sha.append(hashlib.sha256(held).hexdigest())
                        pieces.append(None)
                    first = False
                last, held, loose = ids[lo], joined, False
            else:
                held = held + b"," + joined if held else joined
            if len(held) > PIECE:
                cut()
                loose = True
        yield flush()
    if last is not None and held:
        cut()
    if names:
        yield flush()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, part, seq, sha, piece), sorted: the digest of each list, a piece at a time."""
    last, state = None, None
    for batch in batches:
        ids, sha = [], []
        for name, piece in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True):
            if name != last:
                if last is not None:
                    ids.append(last)
                    sha.append(state.hexdigest())
                last, state = name, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
        yield pa.record_batch([pa.array(ids, pa.string()), pa.array(sha, pa.string())], ["id", "sha"])
    if last is not None:
        yield pa.record_batch([pa.array([last]), pa.array([state.hexdigest()])], ["id", "sha"])


def list_digests(ends: DataFrame) -> DataFrame:
    """Rows (id, sha) of rows (id, c): SHA-256 of the decimal c of each id, ascending, joined by commas.

    Lists are cut where ranges of a sort by id and c end; only lists that reach a border, or beyond a piece, go on as
    pieces, which one task an id reads one after the other.
    """
    ranges = ends.select("id", "c").repartitionByRange("id", "c").sortWithinPartitions("id", "c")
    found = kept(ranges.mapInArrow(_digests, "id string, part long, seq long, sha string, piece binary"), "trie-ends")
    pieces = found.where("sha is null").repartition("id").sortWithinPartitions("id", "part", "seq")
    return found.where("sha is not null").select("id", "sha").unionByName(pieces.mapInArrow(_joined, "id string, sha string"))


def trie(seq: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node: id, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``seq`` has rows (c, d, dig, n, len), turns 1 to len of each conversation; ``convs`` has rows (c, len) of all,
    those without turns too.
    """
    spark = seq.sparkSession
    seq, convs = kept(seq, "trie-seq"), kept(convs, "trie-all")
    n_convs, smallest, deepest = convs.agg(F.count(F.lit(1)), F.min("c"), F.max("len")).first()
    deepest = (deepest or 0) - 1
    at = seq.select("c", (F.col("d") - 1).alias("pos"), "dig")
    ways = kept(paths(at, max(0, deepest), band), "trie-ways")

    names = ways.select("c", "band", "up", "ids", F.posexplode("ids").alias("j", "id"))
    parent = F.when(F.col("j") == 0, F.col("up")).otherwise(F.get("ids", F.col("j") - 1))
    members = names.select("c", (F.col("band") * band + F.col("j") + 1).alias("d"), "id", parent.alias("parent"))
    members = kept(members.join(seq.select("c", "d", "n", "len"), ["c", "d"]), "trie-members")
    more = (F.col("d") < F.col("len")).cast("int")
    nodes = members.groupBy("id", "parent", "d").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n").alias("n"), F.max(more).alias("more"))
    nodes = kept(nodes.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n")).withColumn("n_leaves", (1 - F.col("more")).cast("long")), "trie-nodes")

    n_nodes, saved, leaves = nodes.agg(F.count(F.lit(1)), F.sum("saved_tokens"), F.sum("n_leaves")).first()
    root = [(ROOT, smallest, 0, n_convs, saved or 0, leaves if n_nodes else 1)] if n_convs else []
    root = spark.createDataFrame(root, "id string, conv_id long, depth long, n_convs long, saved_tokens long, n_leaves long")
    sums = ["n_leaves", "saved_tokens"]
    values = nodes.select("id", F.col("conv_id").alias("c"), (F.col("d") - 1).alias("pos"), *sums)
    totals = subtree_sums(ways, values, deepest, band, sums)
    own = nodes.select("id", "parent", "conv_id", F.col("d").alias("depth"), "n_convs").join(totals, "id")
    ends = members.where("d = len").select("id", "c").unionByName(convs.where("len = 0").select(F.lit(ROOT).alias("id"), "c"))
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    whole = own.unionByName(root.withColumn("parent", F.lit(None).cast("string"))).join(children, "id", "left")
    whole = kept(whole.join(list_digests(ends), "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-whole")
    parents = whole.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("uses"))
    below = lookup(whole.where("parent is not null"), parents, "parent", "uses")
    rows = below.unionByName(whole.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends_sha = F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    return rows.select("id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *sums, ends_sha)
