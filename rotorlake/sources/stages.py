"""Stage tables: what one daily job hands to the next, laid out so that the next job's windows need no exchange.

A stage is a catalog table with a partition a day and the rows of a day in buckets of turbines, sorted by turbine and
time. A job replaces the days that it computed; running it twice gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


def create_stage(
    spark: SparkSession, table: str, rows: DataFrame, path: str, order: str, key: str = "wtg_id", day: str = "day", buckets: int = BUCKETS
) -> None:
    """An empty stage for rows like these; nothing happens if it exists."""
    names = [c for c in rows.columns if c != day]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names, day).schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY (`{day}`) CLUSTERED BY (`{key}`) SORTED BY (`{key}`, `{order}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def write_stage(
    rows: DataFrame, table: str, path: str, order: str, key: str = "wtg_id", day: str = "day", buckets: int = BUCKETS
) -> DataFrame:
    """Replace the days of ``rows`` in the stage, making it if need be; gives the whole stage.

    Each bucket of each day is written by one task, as one file.
    """
    spark = rows.sparkSession
    create_stage(spark, table, rows, path, order, key, day, buckets)
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    spread = rows.repartition(F.col(day), bucket).select(*spark.table(table).columns)
    spread.write.insertInto(table, overwrite=True)
    return spark.table(table)


def read_stage(spark: SparkSession, table: str, days: Column | None = None) -> DataFrame:
    """The stage's rows, clustered by turbine; a condition on the day reads only its partitions."""
    rows = spark.table(table)
    return rows if days is None else rows.where(days)
