"""Time-series operators: de-duplication, regular grids, deltas, carry-over, padding and spreading.

Windows run per (key, measuring day) on rows that are already reduced to one per mark or second, so a
group has a bound set by the clock, whatever the number of raw rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotorlake.functions import calendar

STEP = 600
DAY = 86400
#: Rows that one task of an expansion makes at most, if the groups can be split so far.
ROWS_PER_TASK = 8_000_000


def last_per(df: DataFrame, keys: list[str], order: str | Column, cols: list[str] | None = None) -> DataFrame:
    """The last row by ``order`` of each key, combined on the map side; of equally late ones the greatest by ``cols``."""
    order = F.col(order) if isinstance(order, str) else order
    cols = [c for c in df.columns if c not in keys] if cols is None else cols
    rows = df.groupBy(*keys).agg(F.max(F.struct(order.alias("_order"), F.struct(*cols).alias("_row"))).alias("_last"))
    return rows.select(*keys, "_last._row.*")


def last_record(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Carry-over state: the latest row of each key."""
    return last_per(df, [key], ts).select(*df.columns)


def carry_union(previous: DataFrame, today: DataFrame) -> DataFrame:
    """Carried rows on top of today's rows; columns only one side has are null on the other."""
    return previous.unionByName(today, allowMissingColumns=True)


def with_carry(df: DataFrame, ts: str, day: str = "day") -> DataFrame:
    """Add the measuring day; a row at midnight is also given to the day that starts there.

    This is the carried record of the previous run, made locally instead of by a join with yesterday.
    """
    own = calendar.measuring_day(F.col(ts))
    days = F.when(calendar.is_midnight(F.col(ts)), F.array(own, F.date_add(own, 1))).otherwise(F.array(own))
    return df.withColumn(day, F.explode(days))


def fill_grid(
    df: DataFrame,
    key: str,
    ts: str,
    step: int = STEP,
    last_day: str | None = None,
    keep_carry: bool = True,
    days: DataFrame | None = None,
) -> DataFrame:
    """Regular grid per (key, day): every mark from day + step to the next midnight, and the carried midnight.

    Input holds one row per (key, mark); rows off the grid are left out (see ``off_grid``). Missing marks get null
    measures and ``is_filled``. Each row fills the gap up to the next one, so the grid needs no join: 144 rows per day
    at 10 minutes, 145 with carry. Every day from a key's first to its last is there, silent ones too, and up to
    ``last_day``, the last day of the run. ``days`` gives these days (``days_of``) where they can be had from fewer
    columns than the rows take to compute.
    """
    df = df.where(~off_grid(F.col(ts), step))
    measures = [c for c in df.columns if c not in (key, ts)]
    group = Window.partitionBy(key, "day")
    ordered = group.orderBy(ts)
    start = F.col("day").cast("timestamp_ntz")
    end = calendar.shift(start, DAY)
    gap = F.expr(f"interval '{step}' second")

    # A row without time for each day of the span; it stands for the day where there is no other.
    seed = (days_of(df, key, ts, last_day) if days is None else days).withColumn("_seed", F.lit(True))
    present = with_carry(df, ts).withColumn("_seed", F.lit(False)).unionByName(seed, allowMissingColumns=True)
    marked = present.withColumns(
        {
            "_next": F.lead(ts).over(ordered),
            "_previous": F.lag(ts).over(ordered),
            "_wanted": F.max("_seed").over(group),
            "_real": F.count(F.col(ts)).over(group),
        }
    ).withColumn(ts, F.coalesce(F.col(ts), start))
    wanted = F.col("_wanted") & (~F.col("_seed") | (F.col("_real") == 0))
    # The first row of a day also opens the gap before it.
    first_mark = F.when(F.col("_previous").isNull(), F.least(F.col(ts), calendar.shift(start, step))).otherwise(F.col(ts))
    stop = F.coalesce(F.col("_next"), calendar.shift(end, step))
    marks = F.sequence(first_mark, stop - gap, gap)
    filled = (
        marked.where(wanted)
        .withColumn("_mark", F.explode(marks))
        .withColumn("is_filled", (F.col("_mark") != F.col(ts)) | F.col("_seed"))
        .where(~F.col("_seed") | (F.col("_mark") > start))
    )
    if not keep_carry:
        filled = filled.where(F.col("_mark") > start)
    values = [F.when(~F.col("is_filled"), F.col(c)).alias(c) for c in measures]
    return filled.select(key, "day", F.col("_mark").alias(ts), *values, "is_filled")


def off_grid(ts: Column, step: int = STEP) -> Column:
    """Whether a time lies between the marks of its day; a missing time does too."""
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.to_date(ts).cast("timestamp_ntz").cast("timestamp"))
    return F.coalesce(F.pmod(micros, F.lit(step * 1_000_000)) != 0, F.lit(True))


def days_of(df: DataFrame, key: str, ts: str, last_day: str | None = None) -> DataFrame:
    """All measuring days (key, day) from a key's first row to its last, or to ``last_day`` if that is later.

    Rows at midnight belong to the day that ends there.
    """
    span = day_span(df.where(F.col(ts).isNotNull()), [key], ts)
    first, last = calendar.measuring_day(F.col("first_time")), calendar.measuring_day(F.col("last_time"))
    if last_day is not None:
        last = F.greatest(last, F.lit(last_day).cast("date"))
    return span.select(key, F.explode(F.sequence(first, last)).alias("day"))


def spread_groups(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Hash-partition by ``keys`` into a number of tasks that stays, made for ``rows`` expanded rows.

    Rows that are about to be expanded some hundredfold look tiny to the adaptive planner, which would
    join them into one task. There are as many tasks as the session's shuffle partitions, or more if these would
    get over ``ROWS_PER_TASK`` rows each.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, -(-rows // ROWS_PER_TASK)), *keys)


def add_previous(df: DataFrame, key: str, ts: str, cols: list[str], prefix: str = "previous_") -> DataFrame:
    """Value of the row before within the (key, day) group, which starts with the carried row."""
    window = Window.partitionBy(key, "day").orderBy(ts)
    return df.withColumns({prefix + c: F.lag(c).over(window) for c in cols})


def counter_delta(df: DataFrame, key: str, ts: str, cols: list[str], suffix: str = "_delta") -> DataFrame:
    """Difference of each cumulative counter to the row before; null if either side is."""
    with_previous = add_previous(df, key, ts, cols, "_p_")
    deltas = {c + suffix: F.col(c) - F.col("_p_" + c) for c in cols}
    return with_previous.withColumns(deltas).drop(*["_p_" + c for c in cols])


def day_span(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """First and last time of each group."""
    return df.groupBy(*keys).agg(F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def last_event_per_second(events: DataFrame, keys: list[str], ts: str, msec: str, state: str) -> DataFrame:
    """Events of one second reduced to the last by time and millisecond; equal ones by the greatest state."""
    moments = events.withColumns({"_at": F.struct(ts, msec, state), ts: whole_second(F.col(ts))})
    return moments.groupBy(*keys, ts).agg(F.max("_at").alias("_at")).select(*keys, ts, F.col(f"_at.{state}").alias(state))


def whole_second(ts: Column) -> Column:
    """A plain time without the fraction of its second."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.second(ts).cast("decimal(16,6)"))


def state_intervals(logs: dict[str, DataFrame], roster: DataFrame, key: str = "wtg_id", seconds: int | None = None) -> DataFrame:
    """State logs merged to intervals ``[start_time, end_time)`` in which no state changes.

    ``logs`` maps an output column to a log (key, starttime, msec, state_id). A state holds from the second of its
    time on; within a second the latest by time and millisecond counts, of equal ones the greatest state.
    ``roster`` holds the (key, day) pairs to cover. A day runs from its first second to the next
    midnight; it opens with the last state of any earlier day, and a null state is carried as null.

    The logs are read once: changes are dealt by (key, day) in one exchange, which the summary of the days and the
    intervals both read; the carry from day to day runs over that summary, one row a day. The rows leave dealt by
    (key, day) into tasks for the seconds of the roster, which are counted if not given.
    """
    kinds = list(logs)
    seconds = DAY * roster.select(key, "day").distinct().count() if seconds is None else seconds
    tagged = None
    for kind, log in logs.items():
        second = whole_second(F.col("starttime"))
        one = log.where(F.col("starttime").isNotNull()).select(
            key, second.alias("start_time"), F.struct("starttime", "msec", "state_id").alias("moment"), F.lit(kind).alias("kind")
        )
        tagged = one if tagged is None else tagged.unionByName(one)

    def held(kind: str) -> Column:
        return F.when(F.col("has_" + kind), F.struct(F.col(kind).alias("v")))

    # One row per (key, second): the last event of each log in that second.
    changes = (
        tagged.withColumn("day", calendar.measuring_day(F.col("start_time")))
        .groupBy(key, "day", "start_time")
        .agg(*[F.max(F.when(F.col("kind") == k, F.col("moment"))).alias(k) for k in kinds])
        .select(key, "day", "start_time", *[F.col(k)["state_id"].alias(k) for k in kinds], *[F.col(k).isNotNull().alias("has_" + k) for k in kinds])
    )
    changes = spread_groups(changes, key, "day", rows=seconds)
    # One row per (key, day): the last state of the day; a running "last" over days gives the carry.
    day_last = changes.groupBy(key, "day").agg(
        *[F.max(F.when(F.col("has_" + k), F.struct("start_time", F.col(k).alias("v")))).alias(k) for k in kinds]
    )
    days = day_last.withColumn("in_roster", F.lit(False)).unionByName(
        roster.select(key, "day").distinct().withColumn("in_roster", F.lit(True)), allowMissingColumns=True
    )
    per_day = days.groupBy(key, "day").agg(*[F.max(k).alias(k) for k in kinds], F.max("in_roster").alias("in_roster"))
    any_event = reduce(Column.__or__, [F.col(k).isNotNull() for k in kinds])
    by_day = Window.partitionBy(key).orderBy("day")
    until_now = by_day.rowsBetween(Window.unboundedPreceding, 0)
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        per_day.withColumns(
            {
                "_seen": F.max(any_event).over(until_now),
                **{"_c_" + k: F.last(k, ignorenulls=True).over(before) for k in kinds},
            }
        )
        .where("in_roster and _seen")
        .select(
            key,
            "day",
            calendar.shift(F.col("day").cast("timestamp_ntz"), 1).alias("start_time"),
            *[F.col("_c_" + k)["v"].alias(k) for k in kinds],
            *[F.lit(True).alias("has_" + k) for k in kinds],
            F.lit(True).alias("_opens"),
        )
    )
    group = Window.partitionBy(key, "day").orderBy("start_time", F.col("_opens").desc())
    so_far = group.rowsBetween(Window.unboundedPreceding, 0)
    end_of_day = calendar.shift(F.col("day").cast("timestamp_ntz"), DAY + 1)
    # Both sides are dealt alike, so the window takes the union as it is.
    merged = changes.withColumn("_opens", F.lit(False)).unionByName(spread_groups(opening, key, "day", rows=seconds))
    return (
        merged.withColumns(
            {
                "_covered": F.first("_opens").over(so_far),
                "end_time": F.coalesce(F.lead("start_time").over(group), end_of_day),
                **{k: F.last(held(k), ignorenulls=True).over(so_far)["v"] for k in kinds},
            }
        )
        .where("_covered and end_time > start_time")
        .select(key, "day", "start_time", "end_time", *kinds)
    )


def expand_seconds(
    intervals: DataFrame, start: str = "start_time", end: str = "end_time", out: str = "ts", second: str | None = None, day: str = "day"
) -> DataFrame:
    """One row per second of ``[start, end)``.

    ``second`` names a further column for the second since the midnight that ``day`` starts with. It is taken from the
    interval's start and counted along: taking it from every row's time would cost more than the row.
    """
    step = F.expr("interval '1' second")
    seconds = F.sequence(F.col(start), F.col(end) - step, step)
    if second is None:
        return intervals.withColumn(out, F.explode(seconds)).drop(start, end)
    kept = [c for c in intervals.columns if c not in (start, end)]
    first = F.datediff(F.to_date(start), F.col(day)).cast("long") * DAY + F.hour(start) * 3600 + F.minute(start) * 60 + F.second(start)
    spread = intervals.withColumn("_first", first).select(*kept, "_first", F.posexplode(seconds).alias("_place", out))
    return spread.select(*kept, out, (F.col("_first") + F.col("_place")).alias(second))


def pad_states(logs: dict[str, DataFrame], roster: DataFrame, key: str = "wtg_id", second: str | None = None) -> DataFrame:
    """One row per (key, second) with the state of each log; ``second`` as in ``expand_seconds``."""
    return expand_seconds(state_intervals(logs, roster, key), second=second)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def split_energy(df: DataFrame, cols: dict[str, str], step: int = STEP, digits: int = 5) -> DataFrame:
    """Even share per second of each energy column, and what is left for the last second of the mark."""
    out = {}
    for col, name in cols.items():
        share = half_even(F.col(col) / F.lit(float(step)), digits)
        out[name] = share
        out[name + "_last"] = half_even(F.col(col) - F.lit(float(step - 1)) * share, digits)
    return df.withColumns(out)


def energy_runs(
    df: DataFrame,
    ts: str,
    cols: dict[str, str],
    step: int = STEP,
    digits: int = 5,
    on_runs: Callable[[DataFrame], DataFrame] | None = None,
    start: str = "start_time",
    end: str = "end_time",
) -> DataFrame:
    """The seconds ``(mark - step, mark]`` of each mark as two runs ``[start, end)`` in which no column changes.

    Both take the mark's row and an even share of its energies per second, the mark's own second what is left of them.
    ``on_runs`` may add columns: what is computed there is computed once a run instead of once a second.
    """
    mark = F.col(ts)
    bounds = [(calendar.shift(mark, 1 - step), mark, False), (mark, calendar.shift(mark, 1), True)]
    parts = F.array(*[F.struct(a.alias("start"), b.alias("end"), F.lit(last).alias("last")) for a, b, last in bounds])
    cut = split_energy(df, cols, step, digits).withColumn("_run", F.explode(parts)).where("_run.start < _run.end")
    shares = [F.when(F.col("_run.last"), F.col(n + "_last")).otherwise(F.col(n)).alias(n) for n in cols.values()]
    times = [F.col("_run.start").alias(start), F.col("_run.end").alias(end)]
    runs = cut.select(*[c for c in df.columns if c != ts], *times, *shares)
    return on_runs(runs) if on_runs else runs


def spread_energy(
    df: DataFrame,
    ts: str,
    cols: dict[str, str],
    step: int = STEP,
    digits: int = 5,
    rows: int | None = None,
    on_runs: Callable[[DataFrame], DataFrame] | None = None,
    second: str | None = None,
) -> DataFrame:
    """Every second of ``(mark - step, mark]`` takes the mark's row; energies are split, the rest on the mark.

    Turbine-days are dealt by their marks, into tasks for the ``rows`` to come; these are the counted marks times
    ``step`` if they are not known from fewer columns. ``on_runs`` as in ``energy_runs``, ``second`` as in
    ``expand_seconds``.
    """
    groups = [c for c in ("wtg_id", "day") if c in df.columns]
    spread = spread_groups(df, *groups, ts, rows=df.count() * step if rows is None else rows)
    runs = energy_runs(spread, ts, cols, step, digits, on_runs, "_start", "_end")
    return expand_seconds(runs, "_start", "_end", ts, second)


def date_spine(start: Column, end: Column, step: str) -> Column:
    """Array of the times from ``start`` to ``end``, both included."""
    return F.sequence(start, end, F.expr(f"interval '1' {step}"))


def avg_windows(
    df: DataFrame, ts: str, cols: list[str], keys: tuple[str, ...] = (), size: str = "10 minutes", watermark: str | None = None
) -> DataFrame:
    """Mean of every value column per tumbling window, labelled by the window start. Batch or streaming."""
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    means = df.groupBy(F.window(ts, size), *keys).agg(*[F.avg(c).alias(c) for c in cols])
    return means.select(F.col("window.start").alias(ts), *keys, *cols)


def row_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """User function on an iterator of pandas batches of a partition, row by row in and out."""
    return df.mapInPandas(fn, schema)


def grouped_map(df: DataFrame, key: str, ts: str, fn: Callable, schema: str) -> DataFrame:
    """User function on the pandas frame of one (key, measuring day).

    Give it rows that are already one per mark: then the clock bounds a group's size.
    """
    if "day" not in df.columns:
        df = df.withColumn("day", calendar.measuring_day(F.col(ts)))
    return df.groupBy(key, "day").applyInPandas(fn, schema)
