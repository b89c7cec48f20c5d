"""Quality flags of the 10-minute table and energy per 10 minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.functions import bits
from rotorlake.operators.series import add_previous, counter_delta
from rotorlake.schemas import COUNTERS, RATED_RULES, TEN_MINUTE_RULES

FREEZE_RATIO = 0.01


def range_terms(rules: dict[str, tuple[float, float]] = TEN_MINUTE_RULES) -> list[Column]:
    """Null and out-of-range codes of the fields with fixed bounds, and the extra wind speed checks."""
    terms = []
    for field, (low, high) in rules.items():
        value = F.col(field)
        outside = (value < low) | (value > high)
        if field == "windspeedave":
            outside = outside | (value == 0)
            frozen = F.try_divide(F.col("windspeedstd"), value) < FREEZE_RATIO
            terms.append(bits.set_code(field, bits.FREEZE, frozen))
        terms.append(bits.set_code(field, bits.NULL, value.isNull()))
        terms.append(bits.set_code(field, bits.OUT_OF_RANGE, outside))
    return terms


def rated_terms(rules: dict[str, tuple[str, float, float]] = RATED_RULES) -> list[Column]:
    """Null and out-of-range codes of the fields bounded by turbine ratings; no rating, no range code."""
    terms = []
    for field, (rating, low, high) in rules.items():
        value, rated = F.col(field), F.col(rating)
        floor = F.lit(0.0) if low == 0 else F.lit(low) * rated
        terms.append(bits.set_code(field, bits.NULL, value.isNull()))
        terms.append(bits.set_code(field, bits.OUT_OF_RANGE, (value < floor) | (value > F.lit(high) * rated)))
    return terms


def counter_terms(counter: str = "approduction", previous: str = "previous_approduction") -> list[Column]:
    value, before = F.col(counter), F.col(previous)
    delta = value - before
    return [
        bits.set_code(counter, bits.COUNTER_NULL, value.isNull()),
        bits.set_code(counter, bits.PREVIOUS_NULL, value.isNotNull() & before.isNull()),
        bits.set_code(counter, bits.DECREASE, delta < 0),
        bits.set_code(counter, bits.TOO_LARGE, delta > F.col("rated_power") / F.lit(6.0)),
    ]


def quality_flags(grid: DataFrame, missing_rows: str = "fields") -> DataFrame:
    """Add ``clean_flag`` to a filled grid that carries the turbine ratings.

    A filled row gets the null code of every field; ``missing_rows="flag"`` gives it the single
    missing-row code instead.
    """
    with_previous = add_previous(grid, "wtg_id", "datatime", ["approduction"])
    flag = bits.build_flag(range_terms() + rated_terms() + counter_terms())
    if missing_rows == "flag":
        flag = F.when(F.col("is_filled"), bits.set_code("missing", bits.NULL, F.lit(True))).otherwise(flag)
    return with_previous.withColumn("clean_flag", flag).drop("previous_approduction")


def real_energy(df: DataFrame) -> DataFrame:
    """Energy of each 10 minutes from the counters, nulled with an error map where it cannot be trusted."""
    flag = F.col("clean_flag")
    temperature_bad = ~bits.is_normal(flag, "temoutave")
    no_speed = {
        "NO_NTF_WIND_SPEED": F.col("ntf_wind_speed").isNull(),
        "NO_NTF_SITE_WIND_SPEED": F.col("ntf_wind_speed_site").isNull(),
        "NO_NTF_STANDARD_WIND_SPEED": F.col("ntf_wind_speed_standard").isNull(),
        "NO_TEMP_OUT": temperature_bad,
    }
    errors = bits.error_bits(bits.field_code(flag, "approduction"), no_speed)
    names = {c + "_d": f"real_{c}_10m" for c in COUNTERS}
    return (
        counter_delta(df, "wtg_id", "datatime", COUNTERS, "_d")
        .withColumn("real_approduction_10m_errors", errors)
        .withColumn("approduction_d", F.when(F.col("real_approduction_10m_errors") == 0, F.col("approduction_d")))
        .withColumnsRenamed(names)
    )
