"""Quality flag (four bits per field) and energy error map as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rotorlake.schemas import ENERGY_ERRORS, FLAG_FIELDS

NULL, OUT_OF_RANGE, FREEZE = 1, 2, 4
DECREASE, TOO_LARGE, COUNTER_NULL, PREVIOUS_NULL = 1, 2, 4, 8

# The text of each code; the energy counter has its own.
COMMON_LABELS = {NULL: "null", OUT_OF_RANGE: "out of range"}
WIND_LABELS = {**COMMON_LABELS, FREEZE: "wind speed freeze"}
COUNTER_LABELS = {COUNTER_NULL: "null", PREVIOUS_NULL: "pre null", DECREASE: "decrease", TOO_LARGE: "too large"}


def _shift(field: str) -> int:
    return 4 * FLAG_FIELDS.index(field)


def set_code(field: str, code: int, condition: Column) -> Column:
    """The bits of one code where the condition holds, else 0. Terms of one flag are added up."""
    return F.when(condition, F.lit(code << _shift(field)).cast("long")).otherwise(F.lit(0).cast("long"))


def build_flag(terms: list[Column]) -> Column:
    total = F.lit(0).cast("long")
    for term in terms:
        total = total + term
    return total


def field_code(flag: Column, field: str) -> Column:
    return F.shiftright(flag, _shift(field)).bitwiseAND(F.lit(15).cast("long")).cast("int")


def is_normal(flag: Column, field: str) -> Column:
    return field_code(flag, field) == 0


def _labels(field: str) -> dict[int, str]:
    return {"windspeedave": WIND_LABELS, "approduction": COUNTER_LABELS}.get(field, COMMON_LABELS)


def flag_labels(flag: Column) -> Column:
    """Array of ``field: reason`` texts, in field order."""
    texts = [
        F.when(field_code(flag, field).bitwiseAND(F.lit(bit)) != 0, F.lit(f"{field}: {text}"))
        for field in FLAG_FIELDS
        for bit, text in _labels(field).items()
    ]
    return F.array_compact(F.array(*texts))


def error_bits(code: Column, conditions: dict[str, Column]) -> Column:
    """Counter code as the low bits, one more bit per named condition that holds."""
    total = code
    for name, condition in conditions.items():
        total = total.bitwiseOR(F.when(condition, F.lit(1 << ENERGY_ERRORS.index(name))).otherwise(F.lit(0)))
    return total


def error_labels(bits: Column) -> Column:
    texts = [F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(ENERGY_ERRORS)]
    return F.array_compact(F.array(*texts))
