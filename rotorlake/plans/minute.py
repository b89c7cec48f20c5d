"""Daily 1-minute chain: raw text, warehouse, clean, staging, ideal-power feature.

From text to feature every step is narrow; only the curve points are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.functions import physics
from rotorlake.operators.cleaning import clean_ranges, parse_kv
from rotorlake.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join, salted_join
from rotorlake.operators.lookup import newest_points
from rotorlake.schemas import FEATURE_STAGING

MISSING_POWER = -1.0
STEP = 0.5
SITE_TYPES = (1, 2)


def staging(
    clean: DataFrame, turbines: DataFrame, types: DataFrame, columns: list[str] | None = None, day: str | None = None
) -> DataFrame:
    """Clean fact with the turbine's type and rating, for turbines of the two site types.

    ``day`` (yyyymmdd) keeps one day; on a table partitioned by ``date`` only its folder is read.
    """
    if day is not None:
        clean = clean.where(F.col("date") == day)
    chosen = turbines.where(F.col("site_type").isin(*SITE_TYPES)).select("wtg_id", "wtg_type_id")
    named = types.select("wtg_type_id", "wtg_type_name", "rated_power")
    # The two dimensions are joined first: the fact meets one small table.
    joined = lookup_join(clean, chosen.join(named, "wtg_type_id"), "wtg_id")
    return joined.select(*(columns or FEATURE_STAGING.names))


def _interpolated(speed: Column, low: Column, high: Column, low_power: Column, high_power: Column) -> Column:
    between = physics.interpolate(low, low_power, high, high_power, speed)
    power = F.when(low == high, low_power).otherwise(between)
    return F.coalesce(power, F.lit(MISSING_POWER))


def ideal_power(
    fact: DataFrame, curve: DataFrame, speed_col: str = "read_wind_speed", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Add ``ideal_active_power``: the turbine's curve, read linearly on its 0.5 grid, -1 where it has no point.

    Of several points of one speed the newest counts. Turbines without any curve row drop out.
    """
    # Rows without turbine or speed are no points.
    curve = curve.where(F.col("wtg_id").isNotNull() & F.col("wind_speed_rank").isNotNull())
    points = newest_points(curve, ["wtg_id", "wind_speed_rank"], "active_power", ["created_time"]).select(
        "wtg_id", "wind_speed_rank", F.col("active_power").alias("_power")
    )
    speed = F.col(speed_col)
    low, high = physics.grid_neighbours(speed, STEP)
    entry = F.struct("wind_speed_rank", "_power")
    curves = points.groupBy("wtg_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_curve"))
    # The rows before de-duplication bound the points from above and need no shuffle to measure. Beyond the bound the
    # fact is shuffled once, to its turbines' curves.
    if fits_broadcast(curve, max_bytes) or fits_broadcast(points, max_bytes):
        joined = fact.join(F.broadcast(curves), "wtg_id")
    else:
        joined = salted_join(fact, curves, ["wtg_id"])
    low_power, high_power = F.try_element_at("_curve", low), F.try_element_at("_curve", high)
    power = _interpolated(speed, low, high, low_power, high_power)
    return joined.withColumn("ideal_active_power", power).select(*fact.columns, "ideal_active_power")


def minute_chain(
    raw: DataFrame, turbines: DataFrame, types: DataFrame, curve: DataFrame, day: str | None = None, tz: str | None = None
) -> DataFrame:
    """All steps of one or many days in one plan."""
    return ideal_power(staging(clean_ranges(parse_kv(raw, tz=tz)), turbines, types, day=day), curve)
