"""Places in a total order, and lookups by keys that many rows may share; no task gets an unbounded group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlake.llm.graph import kept

#: Most keys that ``lookup`` broadcasts, and uses up to which a key is never called frequent.
FREQUENT_KEYS = 100_000
FEW_USES = 10_000


def numbered(df: DataFrame, order: list[str], place: str, name: str) -> DataFrame:
    """``df`` with the place (from 0) of each row in the order of the columns ``order``, written to the shared folder.

    Ranges of the order are sorted each by itself; the number of rows before a range comes from a table with a row a
    range. Rows that are equal in ``order`` must be equal altogether, or which comes first is not defined.
    """
    at, here, before = f"{place}_at", f"{place}_range", f"{place}_before"
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    rows = kept(rows, name).withColumn(here, F.shiftrightunsigned(at, 33))
    ranges = rows.groupBy(here).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.orderBy(here).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    rows = rows.join(F.broadcast(ranges), here)
    return rows.withColumn(place, F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(at, here, before)


def lookup(rows: DataFrame, table: DataFrame, key: str, uses: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row a key; every key of ``rows`` must be there.

    ``uses`` is a column of ``table`` that says how many of the rows have the key; it is dropped. Keys that more than
    one row in ``FREQUENT_KEYS`` has are fewer than that number, whatever the size: they are broadcast. All others are
    joined by a shuffle, in which no key has many rows.
    """
    total = table.agg(F.sum(uses)).first()[0] or 0
    frequent = F.col(uses) > max(FEW_USES, total // FREQUENT_KEYS)
    found = table.where(frequent).drop(uses).withColumn("_found", F.lit(True))
    rows = rows.join(F.broadcast(found), key, "left")
    rest = rows.where("_found is null").select(*[x for x in rows.columns if x == key or x not in found.columns])
    return rows.where("_found").drop("_found").unionByName(rest.join(table.where(~frequent).drop(uses), key))
