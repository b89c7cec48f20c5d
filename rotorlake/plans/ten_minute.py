"""Daily 10-minute chain: clean with quality flags, then density, transfer speed, energy and predicted power."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.functions import bits, physics
from rotorlake.operators.cleaning import convert_units, remap_ids
from rotorlake.operators.joins import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join
from rotorlake.operators.lookup import asof_lookup, bracket_sets, merge_sets, unique_points
from rotorlake.operators.quality import quality_flags, real_energy
from rotorlake.operators.series import days_of, fill_grid, last_per, off_grid
from rotorlake.schemas import TEN_MINUTE_MEASURES

RATINGS = ["rated_power", "rated_torque", "on_grid_rotor_speed", "on_grid_generator_speed"]
# Power curve type of the contract and of the actual curve.
CURVES = {"theory": 1, "active": 3}


def unique_marks(raw: DataFrame, order: str = "loaded_at") -> DataFrame:
    """The last loaded row of each (turbine, mark); rows between the marks are left out."""
    return last_per(raw.where(~off_grid(F.col("datatime"))), ["wtg_id", "datatime"], order, TEN_MINUTE_MEASURES)


def clean(
    raw: DataFrame,
    turbines: DataFrame,
    aliases: DataFrame | None = None,
    last_day: str | None = None,
    missing_rows: str = "fields",
    keep_carry: bool = True,
) -> DataFrame:
    """Regular grid with units converted and ``clean_flag``; a day starts with the carried midnight row."""
    if aliases is not None:
        raw = remap_ids(raw, aliases, "wtg_id", "idx", "mdm_id")
    # The ratings join also keeps only turbines of the dimension. It comes last: rows added by the grid get ratings
    # too, where they change nothing, and the row windows below move fewer columns.
    days = days_of(raw.where(~off_grid(F.col("datatime"))), "wtg_id", "datatime", last_day)
    grid = fill_grid(unique_marks(raw), "wtg_id", "datatime", days=days)
    rated = lookup_join(grid, turbines.select("wtg_id", *RATINGS), "wtg_id")
    flagged = quality_flags(convert_units(rated), missing_rows).drop(*RATINGS)
    return flagged if keep_carry else without_carry(flagged)


def without_carry(df: DataFrame) -> DataFrame:
    return df.where(F.col("datatime") > F.col("day").cast("timestamp_ntz"))


CLEAN_COLUMNS = ["wtg_id", "datatime", *TEN_MINUTE_MEASURES, "clean_flag"]


def with_site(clean_rows: DataFrame, turbines: DataFrame, sites: DataFrame, how: str = "inner") -> DataFrame:
    """Add the turbine's heights, transfer function and site density."""
    heights = turbines.select("wtg_id", "site_id", "altitude", "hub_height", "scada_ntf_id")
    densities = sites.select("site_id", F.col("air_density").alias("site_air_density"))
    return lookup_join(clean_rows, heights.join(densities, "site_id").drop("site_id"), "wtg_id", how)


def transfer_speeds(sited: DataFrame, ntf: DataFrame) -> DataFrame:
    """Nacelle-transfer wind speed from the function's row with the greatest rotor speed not above the measured one.

    Null if rotor or wind speed is flagged or no row is low enough.
    """
    points = ntf.select(F.col("ntf_id").alias("scada_ntf_id"), "rotor_speed", "a", "b", "c")
    looked = asof_lookup(sited, points, "scada_ntf_id", "rotorspdave", "rotor_speed", "_ntf", known="has_ntf")
    flag = F.col("clean_flag")
    usable = bits.is_normal(flag, "rotorspdave") & bits.is_normal(flag, "windspeedave")
    speed = physics.transfer_speed(F.col("windspeedave"), F.col("_ntf.a"), F.col("_ntf.b"), F.col("_ntf.c"))
    return looked.withColumn("ntf_wind_speed", F.when(usable, speed)).drop("_ntf")


def corrected_speeds(df: DataFrame, kelvin_input: bool = False) -> DataFrame:
    """Air density where the temperature is normal, and the speed corrected to site and standard density."""
    density = physics.air_density(F.col("temoutave"), F.col("altitude"), F.col("hub_height"), kelvin_input)
    usable = bits.is_normal(F.col("clean_flag"), "temoutave")
    if "has_ntf" in df.columns:
        usable = usable & F.col("has_ntf")
    dense = df.withColumn("air_density", F.when(usable, density))
    speed, air = F.col("ntf_wind_speed"), F.col("air_density")
    return dense.withColumns(
        {
            "ntf_wind_speed_site": physics.density_corrected_speed(speed, air, F.col("site_air_density")),
            "ntf_wind_speed_standard": physics.density_corrected_speed(
                speed, air, F.lit(physics.STANDARD_AIR_DENSITY)
            ),
        }
    )


def predicted_power(df: DataFrame, curves: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Power between the two curve points around the standard speed, energy of 10 minutes; null outside the curve.

    Both curve types are read in one pass.
    """
    value, rank = "ntf_wind_speed_standard", "wind_speed_rank"
    sets = {name: F.col("pc_type") == pc_type for name, pc_type in CURVES.items()}
    looked = bracket_sets(df, curves, "wtg_id", value, rank, sets, max_bytes)
    out = {}
    for name in CURVES:
        low, high = F.col(name + "_lo"), F.col(name + "_hi")
        power = physics.interpolate(low[rank], low["power"], high[rank], high["power"], F.col(value))
        out |= {f"{name}_power_10m": power, f"{name}_approduction_10m": power / F.lit(6.0)}
    return looked.withColumns(out).drop(*[name + side for name in CURVES for side in ("_lo", "_hi")])


def assigned_power(df: DataFrame, assignment: DataFrame, points: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``predicted_power`` for curves that many turbines share.

    The fact gets the ids of its turbine's curves, and the points are read by curve, so they are not repeated for
    each turbine; where they are too many to send, they are repeated for each two curves that occur together, so that
    the fact is shuffled once for both. Of several curves of one type the greatest id counts.
    """
    value, rank = "ntf_wind_speed_standard", "wind_speed_rank"
    ids = [f"_{n}_pc" for n in CURVES]
    own = assignment.groupBy("wtg_id").agg(*[F.max(F.when(F.col("pc_type") == t, F.col("pc_id"))).alias(i) for t, i in zip(CURVES.values(), ids, strict=True)])
    looked = lookup_join(df, own, "wtg_id", "left")
    if fits_broadcast(points, max_bytes):
        for name, pc_id in zip(CURVES, ids, strict=True):
            curve = points.select(F.col("pc_id").alias(pc_id), rank, "power")
            looked = bracket_sets(looked, curve, pc_id, value, rank, {name: F.lit(True)}, max_bytes, measured=True)
    else:
        # Rows meet the points of all their curves at once, by the ids that occur together.
        together = own.select(F.struct(*ids).alias("_pcs")).distinct()
        known = None
        for name, pc_id in zip(CURVES, ids, strict=True):
            one = together.join(points.select(F.col("pc_id").alias("_pc"), rank, "power"), F.col(f"_pcs.{pc_id}") == F.col("_pc"))
            one = one.select("_pcs", rank, "power", F.lit(name).alias("_of"))
            known = one if known is None else known.unionByName(one)
        sets = {n: F.col("_of") == n for n in CURVES}
        unique = unique_points(known, "_pcs", rank, sets)
        looked = merge_sets(looked.withColumn("_pcs", F.struct(*ids)), unique, "_pcs", value, rank, list(sets)).drop("_pcs")
    out = {}
    for name in CURVES:
        low, high = F.col(name + "_lo"), F.col(name + "_hi")
        power = physics.interpolate(low[rank], low["power"], high[rank], high["power"], F.col(value))
        out |= {f"{name}_power_10m": power, f"{name}_approduction_10m": power / F.lit(6.0)}
    return looked.withColumns(out).drop(*ids, *[name + side for name in CURVES for side in ("_lo", "_hi")])


def calculate(
    clean_rows: DataFrame, turbines: DataFrame, sites: DataFrame, ntf: DataFrame, assignment: DataFrame, points: DataFrame
) -> DataFrame:
    """The full 10-minute calculation of all turbines and days; carried rows only serve the deltas."""
    speeds = corrected_speeds(transfer_speeds(with_site(clean_rows, turbines, sites, "left"), ntf))
    energy = without_carry(real_energy(speeds))
    return assigned_power(energy, assignment, points).drop(
        "altitude", "hub_height", "scada_ntf_id", "site_air_density", "has_ntf", "is_filled"
    )
