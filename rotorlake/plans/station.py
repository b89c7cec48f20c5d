"""Daily weather station extract of the 10-minute fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.schemas import STATION_MEASURES


def weather_station(fact: DataFrame, day: str) -> DataFrame:
    """Wind and power statistics of one calendar day, the day as data and as partition value.

    The month filter prunes partitions; the day filter is a text range on ``data_time`` that reaches the scan.
    """
    of_day = (
        (F.col("hp_yyyymm") == day[:4] + day[5:7])
        & (F.col("data_time") >= day)
        & (F.col("data_time") < F.concat(F.lit(day), F.lit("~")))
    )
    return fact.where(of_day).select(
        F.col("hp_site").alias("site_id"),
        "wtg_id",
        F.col("data_time").alias("date_time"),
        F.lit(day).alias("p_date"),
        *STATION_MEASURES,
        F.lit(day).alias("hp_date"),
        "hp_ds",
    )
