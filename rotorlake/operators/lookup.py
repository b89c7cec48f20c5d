"""Ordered lookups: greatest knot at or below a value, and the two knots around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotorlake.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, row_hash, salted_join

#: Rows and points of one key from which they are cut into buckets of about so many, and most buckets of a key.
BUCKET_ROWS = 1_000_000
CUTS = 1000


def newest_points(points: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """One row per key: the value of the row that is last by ``order``, then by value."""
    last = F.max_by(F.col(value), F.struct(*order, value))
    return points.groupBy(*keys).agg(last.alias(value))


def _knots_below(knots: Column, steps: Column, rank: str, value: Column) -> Column:
    """How many knots of a sorted array are at or below the value; null without a value.

    ``steps`` are the powers of two up to the array's size, falling: each is taken if the knot that far is not above.
    """
    taken = F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(knots, n + s - 1)[rank] <= value, n + s).otherwise(n))
    return F.when(value.isNotNull(), taken)


def unique_points(points: DataFrame, key: str, rank: str, sets: dict[str, Column]) -> DataFrame:
    """One row per (key, rank), for each named subset a struct ``_in<name>`` with its point, null if it has none.

    Points without key or rank match nothing and go. Of several points of one (key, rank) the greatest counts, column
    by column.
    """
    rest = [c for c in points.columns if c not in (key, rank)]
    point = F.struct(rank, *rest)
    known = points.where(F.col(key).isNotNull() & F.col(rank).isNotNull())
    return known.groupBy(key, rank).agg(*[F.max(F.when(chosen, point)).alias("_in" + name) for name, chosen in sets.items()])


def _knot_arrays(unique: DataFrame, key: str, sets: dict[str, Column]) -> DataFrame:
    """The sorted knots of each key and set, and the steps of a search in them."""
    arrays = [F.array_sort(F.collect_list("_in" + name)).alias("_knots" + name) for name in sets]
    steps = {}
    for name in sets:
        powers = F.sequence(F.floor(F.log2(F.size("_knots" + name))).cast("int"), F.lit(0), F.lit(-1))
        steps["_steps" + name] = F.when(F.size("_knots" + name) > 0, F.transform(powers, lambda p: F.pow(F.lit(2), p).cast("int"))).otherwise(F.array().cast("array<int>"))
    return unique.groupBy(key).agg(*arrays).withColumns(steps)


def bracket_sets(
    df: DataFrame,
    points: DataFrame,
    key: str,
    value: str,
    rank: str,
    sets: dict[str, Column],
    max_bytes: int = MAX_BROADCAST_BYTES,
    measured: bool = False,
) -> DataFrame:
    """For each named subset of the points add ``<name>_lo`` and ``<name>_hi``, the knots around the value.

    All subsets share one pass over the points and, if these are few, one broadcast. With ``measured`` the caller has
    measured the points and gives a negative limit if they are too many.
    """
    unique = unique_points(points, key, rank, sets)
    # The rows before de-duplication bound what is sent and need no shuffle to measure.
    if max_bytes >= 0 if measured else fits_broadcast(points, max_bytes):
        looked = df.join(F.broadcast(_knot_arrays(unique, key, sets)), key, "left")
        # One search of the array gives both neighbours.
        found, places = {}, {}
        for name in sets:
            knots, at = F.col("_knots" + name), F.col("_at" + name)
            places["_at" + name] = _knots_below(knots, F.col("_steps" + name), rank, F.col(value))
            found[name + "_lo"] = F.get(knots, at - 1)
            found[name + "_hi"] = F.get(knots, at)
        done = [prefix + name for name in sets for prefix in ("_knots", "_steps", "_at")]
        return looked.withColumns(places).withColumns(found).drop(*done)
    return merge_sets(df, unique, key, value, rank, list(sets))


def asof_lookup(
    df: DataFrame,
    points: DataFrame,
    key: str,
    value: str,
    rank: str,
    out: str = "below",
    above: str | None = None,
    known: str | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add struct ``out``: the point of the row's key with the greatest ``rank`` <= ``value``, null if none.

    With ``above`` also add the point with the least ``rank`` > ``value``, with ``known`` whether the key
    has any point. Of several points of one (key, rank) the greatest counts; points without key or rank match
    nothing. All rows of ``df`` stay. A small point table
    goes out as one sorted array per key; a larger one is matched by ``merge_sets``.
    """
    every = {"": F.lit(True)}
    unique = unique_points(points, key, rank, every)
    if not fits_broadcast(points, max_bytes):
        looked = merge_sets(df, unique, key, value, rank, list(every))
        if known:
            # A key with points has one on either side of any value; only rows without value have to ask.
            near = F.col("_lo").isNotNull() | F.col("_hi").isNotNull()
            asked = looked.where(F.col(value).isNull())
            keys = unique.select(key).distinct().withColumn(known, F.lit(True))
            asked = salted_join(asked, keys, [key], "left").withColumn(known, F.coalesce(known, F.lit(False)))
            looked = looked.where(F.col(value).isNotNull()).withColumn(known, near).unionByName(asked)
        looked = looked.withColumnRenamed("_lo", out)
        return looked.withColumnRenamed("_hi", above) if above else looked.drop("_hi")
    looked = df.join(F.broadcast(_knot_arrays(unique, key, every)), key, "left")
    found = {out: F.get("_knots", F.col("_at") - 1)}
    if above:
        found[above] = F.get("_knots", F.col("_at"))
    if known:
        found[known] = F.col("_knots").isNotNull()
    placed = looked.withColumn("_at", _knots_below(F.col("_knots"), F.col("_steps"), rank, F.col(value)))
    return placed.withColumns(found).drop("_knots", "_steps", "_at")


def merge_sets(df: DataFrame, unique: DataFrame, key: str, value: str, rank: str, names: list[str]) -> DataFrame:
    """``bracket_sets`` for points of any number: rows and points meet in one shuffle and both neighbours in its sort.

    ``unique`` is what ``unique_points`` gives. Rows and points of a key with more than ``BUCKET_ROWS`` of them are cut at
    quantiles of both together; a value so frequent that several cuts fall on it is dealt over these by a hash of the
    row. Cuts are fewer than rows by that factor, so their table is broadcast. Each bucket gets the last point of the
    buckets before it and the first one of those behind. Rows without key or value match nothing and are not shuffled.
    """
    ins = ["_in" + n for n in names]
    at = lambda c: F.col(c).cast("double")
    open_ = F.col(key).isNotNull() & F.col(value).isNotNull()
    rows = df.where(open_)

    both = rows.select(key, at(value).alias("_at")).unionByName(unique.select(key, at(rank).alias("_at")))
    shares = [k / CUTS for k in range(1, CUTS)]
    spans = both.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_at", shares, 20 * CUTS).alias("_q"))
    wanted = F.least(F.lit(CUTS), F.ceil(F.col("_n") / BUCKET_ROWS)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), wanted - 1), lambda k: F.get("_q", F.floor(k * CUTS / wanted).cast("int") - 1))
    cuts = spans.where(F.col("_n") > BUCKET_ROWS).select(key, picked.alias("_cuts"))

    def placed(side: DataFrame, value_at: Column, tie: Column) -> DataFrame:
        below = F.size(F.filter("_cuts", lambda c: c < value_at))
        equal = F.size(F.filter("_cuts", lambda c: c == value_at))
        bucket = F.when(F.col("_cuts").isNull(), 0).otherwise(below + F.pmod(tie, equal + 1)).cast("int")
        return side.join(F.broadcast(cuts), key, "left").withColumn("_b", bucket).drop("_cuts")

    none = F.lit(None)
    points = placed(unique, at(rank), F.lit(0)).select(key, "_b", at(rank).alias("_at"), F.lit(0).alias("_is_row"), *ins)
    ends = points.groupBy(key, "_b").agg(*[F.max(c).alias("_last" + c) for c in ins], *[F.min(c).alias("_first" + c) for c in ins])
    buckets = cuts.select(key, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_b")).join(ends, [key, "_b"], "left")
    order = Window.partitionBy(key).orderBy("_b")
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    handed = []
    for end, found in (
        (float("-inf"), [F.last("_last" + c, ignorenulls=True).over(before).alias(c) for c in ins]),
        (float("inf"), [F.first("_first" + c, ignorenulls=True).over(behind).alias(c) for c in ins]),
    ):
        handed.append(buckets.select(key, "_b", F.lit(end).alias("_at"), F.lit(0).alias("_is_row"), *found))
    facts = placed(rows.select(F.col(key), F.struct(*df.columns).alias("_row"), at(value).alias("_at"), row_hash(rows).alias("_tie")), F.col("_at"), F.col("_tie"))
    facts = facts.select(key, "_b", "_at", F.lit(1).alias("_is_row"), *[none.cast(points.schema[c].dataType).alias(c) for c in ins], "_row")
    merged = facts
    for side in (points, *handed):
        merged = merged.unionByName(side, allowMissingColumns=True)
    up = Window.partitionBy(key, "_b").orderBy("_at", "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(key, "_b").orderBy(F.col("_at").desc(), F.col("_is_row").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = {n + "_lo": F.last("_in" + n, ignorenulls=True).over(up) for n in names}
    found |= {n + "_hi": F.last("_in" + n, ignorenulls=True).over(down) for n in names}
    done = merged.withColumns(found).where("_is_row = 1").select("_row.*", *found)
    return done.unionByName(df.where(~open_), allowMissingColumns=True)
