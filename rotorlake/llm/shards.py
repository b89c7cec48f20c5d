"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``replicas`` virtual nodes on a ring of 2^32 places; a key's place is a hash of the key, and its home is
the shard of the next virtual node clockwise. No shard takes more rows than its capacity: keys over it continue
clockwise to the next virtual node of a shard that has room. Keys at home come first, in ring order, so that a key leaves
its home only where the home is full of its own keys; then the others walk, in ring order. With ``slack`` 0 the
capacities add up to the rows, so that the counts of two shards differ by one at most; with more slack fewer keys walk.

Rows get their number in ring order by a range sort, not in groups, so a key of any number of rows is cut between
tasks. Walking keys move as intervals of that number: the driver sees a count for each virtual node and hands back the
intervals, both bounded by ``shards`` and ``replicas`` whatever the rows. The texts are read once and not shuffled.

Defined results: a null key is the empty key; a null text has no bytes and checksum 0; rows of one key follow each
other by size, then checksum, and equal rows share their slots among them in any way; an empty table gives no rows.
Other columns are left out, or carried if named in ``carry`` (they are not part of the order: of rows with equal key,
size and checksum, any may come first).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.llm.graph import kept
from rotorlake.llm.order import numbered

SHARDS = 16
REPLICAS = 256
#: Places of the ring, and places a cell of the lookup table of virtual nodes.
RING_BITS = 32
CELL_BITS = 20


def place_of(key: str) -> int:
    """Place of a text on the ring."""
    return int(hashlib.md5(key.encode()).hexdigest()[: RING_BITS // 4], 16)


def place(key: Column) -> Column:
    """The same of a column."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(shards: int, replicas: int) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes clockwise; a new shard adds nodes and moves none."""
    return sorted((place_of(f"shard {s} node {r}"), s) for s in range(shards) for r in range(replicas))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard: an equal share, and ``slack`` of a share more."""
    if slack:
        return [-(-int(rows * (1 + slack) + 1) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def intervals(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first number, number after the last, shard, slot of the first) for arcs of so many rows in ring order."""
    room, used = list(room), [0] * len(room)
    out, walking, start = [], [], 0

    def give(arc: int, lo: int, hi: int, shard: int) -> int:
        n = min(room[shard], hi - lo)
        if n:
            out.append((arc, lo, lo + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return lo + n

    for arc, n in enumerate(counts):
        left = give(arc, start, start + n, owners[arc])
        if left < start + n:
            walking.append((arc, left, start + n))
        start += n
    # The next arc clockwise of a shard that has room; paths over full shards are shortened as they are walked.
    after = [(a + 1) % len(owners) for a in range(len(owners))]
    for arc, lo, hi in walking:
        at = after[arc]
        while lo < hi:
            path = []
            while not room[owners[at]]:
                path.append(at)
                at = after[at]
            for a in path:
                after[a] = at
            lo = give(arc, lo, hi, owners[at])
    return out


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    replicas: int = REPLICAS,
    slack: float = 0.0,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (key, size, text_crc32, place, home, shard, slot) and the carried columns."""
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        F.struct(F.lit(0).alias(""), *[F.col(x) for x in carry]).alias("row"),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        place(F.col(key)).alias("place"),
        F.monotonically_increasing_id().alias("read"),
    ).withColumn("id", F.col("key").cast("string"))
    rows = numbered(kept(rows, "ring"), ["place", "id", "size", "text_crc32", "read"], "number", "ring-order")

    nodes = ring(shards, replicas)
    # One more arc: places after the last node belong to the first.
    owners = [s for _, s in nodes] + [nodes[0][1]]
    cells, first = [], 0
    for cell in range(1 << (RING_BITS - CELL_BITS)):
        last = first
        while last < len(nodes) and nodes[last][0] >> CELL_BITS == cell:
            last += 1
        cells.append((cell, [(nodes[a][0], a) for a in range(first, last)], last))
        first = last
    cells = spark.createDataFrame(cells, "cell long, nodes array<struct<at long, arc int>>, beyond int")
    ahead = F.filter("nodes", lambda n: n["at"] >= F.col("place"))
    arc = F.when(F.size(ahead) > 0, F.get(ahead, 0)["arc"]).otherwise(F.col("beyond"))
    rows = rows.withColumn("cell", F.shiftright("place", CELL_BITS)).join(F.broadcast(cells), "cell").withColumn("arc", arc)

    found = {r.arc: r.n for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [found.get(a, 0) for a in range(len(owners))]
    taken = intervals(counts, owners, capacities(sum(counts), shards, slack))
    taken = [(arc, lo, hi, owners[arc], shard, slot) for arc, lo, hi, shard, slot in taken]
    taken = spark.createDataFrame(taken, "own long, lo long, hi long, home int, shard int, slot0 long")
    own = (F.col("arc") == F.col("own")) & (F.col("number") >= F.col("lo")) & (F.col("number") < F.col("hi"))
    slot = (F.col("slot0") + F.col("number") - F.col("lo")).alias("slot")
    rows = rows.join(F.broadcast(taken), own)
    return rows.select(F.col("key").alias(key), "size", "text_crc32", "place", "home", "shard", slot, *[F.col("row")[x].alias(x) for x in carry])


def write(docs: DataFrame, path: str, rows_per_file: int = 100_000, key: str = "doc_id", **options) -> str:
    """All columns of the documents below ``path``, a folder for each shard, files in the order of slots.

    Gives the name that the folders carry: ``shard``, with underscores added while the documents have such a column.
    """
    others = tuple(x for x in docs.columns if x != key)
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    packed = docs.select(key, F.struct(*others).alias("row"), *[F.col(options.get("text", "text")).alias("text")])
    rows = assign(packed, key=key, carry=("row",), **(options | {"text": "text"}))
    rows = rows.repartition("shard", F.floor(F.col("slot") / rows_per_file)).sortWithinPartitions("shard", "slot")
    rows = rows.select(key, "row.*", F.col("shard").alias(folder)).select(*docs.columns, folder)
    rows.write.partitionBy(folder).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return folder
