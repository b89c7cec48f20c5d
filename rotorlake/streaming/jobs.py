"""Ten-minute means from a growing file, late-file reload, carry-over state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rotorlake.operators.series import avg_windows
from rotorlake.sources.tables import reload_touched


STAMP = "yyyy-MM-dd HH:mm:ss"


def follow_seconds(
    spark: SparkSession, folder: str, values: list[str], files_per_batch: int = 100, stamp: str = STAMP, mark: str | None = None
) -> DataFrame:
    """Stream of ``yyyy-MM-dd HH:mm:ss,v1,v2,...`` files; with ``mark`` a last column of that name tells marks of ``close_day``."""
    schema = T.StructType([T.StructField("ts", T.TimestampType())] + [T.StructField(v, T.DoubleType()) for v in values])
    if mark:
        schema = schema.add(mark, T.StringType())
    return (
        spark.readStream.schema(schema)
        .option("timestampFormat", stamp)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def close_day(spark: SparkSession, folder: str, day: str, values: list[str], stamp: str = STAMP) -> None:
    """Add a file that tells a stream with marks that the day is over: its last second, without values."""
    last = F.date_format(F.lit(f"{day} 23:59:59").cast("timestamp"), stamp)
    row = spark.range(1).select(last.alias("ts"), *[F.lit(None).cast("string").alias(v) for v in values], F.lit("end").alias("mark"))
    row.write.mode("append").csv(folder)


def ten_minute_means(stream: DataFrame, values: list[str], watermark: str = "10 minutes") -> DataFrame:
    """Closed windows with their day; rows later than the watermark are dropped."""
    means = avg_windows(stream, "ts", values, watermark=watermark)
    return means.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))


def write_by_day(means: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """One folder per day, everything that is available, then stop."""
    return (
        means.writeStream.format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def append_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that is available to Parquet files, then stop."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def latest_per_key(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """Carry-over state of a stream: the latest row of each key, one small state row per key."""
    rest = [c for c in stream.columns if c != key]
    latest = stream.groupBy(key).agg(F.max_by(F.struct(*rest), ts).alias("_row"))
    return latest.select(key, "_row.*")


def reload_each_batch(stream: DataFrame, table: str, source, day_col: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """On each batch of late rows rewrite the days it touches, from all rows ``source()`` holds for them.

    Each day is replaced as a whole, so a repeated batch changes nothing.
    """

    def rewrite(batch: DataFrame, _: int) -> None:
        reload_touched(source(), table, day_col, batch.select(day_col), keys)

    return (
        stream.writeStream.foreachBatch(rewrite)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
