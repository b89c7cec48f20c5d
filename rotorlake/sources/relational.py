"""Relational source and sink through Spark's JDBC format."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from rotorlake.functions.calendar import within_day

BATCH_SIZE = 1000


def reader_options(
    url: str, table: str, split_by: str | None = None, bounds: tuple[str, str] | None = None, parts: int = 16
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if split_by:
        if bounds is None:
            raise ValueError("a split column needs its bounds")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(parts),
        }
    return options


def read_table(spark: SparkSession, options: dict[str, str], columns: list[str]) -> DataFrame:
    """The named columns only; later filters are pushed to the database."""
    reader: DataFrameReader = spark.read.format("jdbc").options(**options)
    return reader.load().select(*columns)


def time_range(df: DataFrame, ts: str, day: str, columns: list[str] | None = None, days: int = 1) -> DataFrame:
    """Rows with ``day < ts <= day + days``: the midnight that ends a day belongs to it."""
    ranged = df.where(within_day(F.col(ts), day, days))
    return ranged.select(*columns) if columns else ranged


def append_table(df: DataFrame, options: dict[str, str], batch: int = BATCH_SIZE) -> None:
    writer: DataFrameWriter = df.write.format("jdbc").options(**options)
    writer.option("batchsize", batch).mode("append").save()
