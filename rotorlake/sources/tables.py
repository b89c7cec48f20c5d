"""Partitioned table writes, partition registration and rolling reloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlake.functions import calendar
from rotorlake.operators.joins import lookup_join

ROWS_PER_FILE = 100_000
RELOAD_BACK = 2
#: Tasks that partitions are dealt to by a hash, at least; many more than a run's days, so that few days meet in one.
WRITERS = 512


def overwrite_partitions(
    df: DataFrame, path: str, keys: list[str], rows_per_file: int = ROWS_PER_FILE, spread: list[str] | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``; running a day twice gives the same table.

    ``spread`` names columns that split a large partition over tasks before the write, so that a day is
    neither one task nor thousands of tiny files.
    """
    if spread:
        df = df.repartition(*keys, *spread)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*keys)
        .parquet(path)
    )


def read_partitions(spark: SparkSession, path: str, condition: Column | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if condition is None else df.where(condition)


def write_by_name(df: DataFrame, table: str, keys: list[str]) -> None:
    """Add rows to a catalog table in its own layout; each partition is written by one task.

    Its files then enter the table with their folder, in one step. The tasks are given, since the adaptive planner would
    join partitions of few bytes, however many files they are cut into, and since few tasks get several partitions each
    by chance.
    """
    spark = df.sparkSession
    tasks = max(WRITERS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.repartition(tasks, *keys).select(*spark.table(table).columns).write.insertInto(table)


def days_present(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The days that a partitioned table has, as text yyyyMMdd; its folders may have either form of a day."""
    days = spark.read.parquet(path).select(F.col(key).cast("string").alias("day")).distinct()
    return days.select(F.regexp_replace("day", "-", "").alias("day"))


def days_to_run(runs: DataFrame, present: dict[str, DataFrame], offsets: dict[str, tuple[int, int]], epoch: str = "epoch") -> DataFrame:
    """Rows (job, day) that the runs should have made and that no partition holds.

    ``offsets`` gives for each job the hours from a run back to its day, and how many days before that it reloads;
    ``present`` the days (column ``day``, yyyyMMdd) that each job's table has.
    """
    wanted, had = None, None
    for job, (hours, back) in offsets.items():
        last = F.to_date(calendar.run_day(F.col(epoch), hours), "yyyyMMdd")
        one = runs.select(F.explode(F.sequence(F.date_sub(last, back), last)).alias("day")).distinct()
        one = one.select(F.lit(job).alias("job"), F.date_format("day", "yyyyMMdd").alias("day"))
        there = present[job].select(F.lit(job).alias("job"), "day")
        wanted, had = (one, there) if wanted is None else (wanted.unionByName(one), had.unionByName(there))
    return wanted.join(had.distinct(), ["job", "day"], "left_anti")


def register_partitions(spark: SparkSession, table: str, partitions: DataFrame, batch: int = 500) -> int:
    """``ADD IF NOT EXISTS PARTITION`` for each row (``spec`` like ``site="1", day="2"``, ``location``).

    The rows are partition names of one run, not data; they come to the driver one by one because
    registering is a catalog call. Returns how many were named.
    """
    clauses, count = [], 0

    def flush() -> None:
        if clauses:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(clauses))
            clauses.clear()

    for row in partitions.select("spec", "location").distinct().toLocalIterator():
        clauses.append(f"PARTITION ({row['spec']}) LOCATION '{row['location']}'")
        count += 1
        if len(clauses) >= batch:
            flush()
    flush()
    return count


def reload_window(df: DataFrame, day_col: str, day: str | Column, back: int = RELOAD_BACK) -> DataFrame:
    """Rows of the day and the ``back`` days before it, the span in which late files still arrive."""
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return df.where(F.col(day_col).between(F.date_sub(day, back), day))


def reload_days(df: DataFrame, path: str, day_col: str, day: str, keys: list[str], back: int = RELOAD_BACK) -> None:
    """Rewrite the partitions of the reload window and leave all others alone."""
    overwrite_partitions(reload_window(df, day_col, day, back), path, keys)


def reload_touched(df: DataFrame, path: str, day_col: str, touched: DataFrame, keys: list[str]) -> None:
    """Rewrite the partitions of the days in ``touched`` and leave all others alone."""
    days = touched.where(F.col(day_col).isNotNull()).distinct()
    overwrite_partitions(lookup_join(df, days, day_col), path, keys)


def ring_export(df: DataFrame, path: str, day_col: str, size: int = 100) -> None:
    """Write each day into its slot of a ring of ``size`` partitions, replacing what the slot held."""
    overwrite_partitions(df.withColumn("ring", calendar.ring_number(F.col(day_col), size)), path, ["ring"])
