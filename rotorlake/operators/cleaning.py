"""Row-level operators: ``key:value`` parsing, range rules, id remaps, unit conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorlake.functions import physics
from rotorlake.functions.text import local_text_to_epoch, missing_to_null, pick, reversed_pairs, to_number
from rotorlake.operators.joins import lookup_join
from rotorlake.schemas import MINUTE_POINTS, MINUTE_RULES, MINUTE_WAREHOUSE


def tokens_of(row: Column) -> Column:
    return F.split(F.trim(row), ",")


def is_valid_kv(row: Column) -> Column:
    """Every token has one colon, or three (a value with a time). Rows may be of any length."""
    colons = lambda t: F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit("")))
    return F.forall(tokens_of(row), lambda t: colons(t).isin(1, 3))


def kv_pairs(row: Column) -> tuple[Column, Column]:
    """Lower-cased keys and the values of a valid row, last pair first."""
    tokens = tokens_of(row)
    names = F.transform(tokens, lambda t: F.lower(F.substring_index(t, ":", 1)))
    values = F.transform(tokens, lambda t: F.substring(t, F.instr(t, ":") + F.lit(1), F.length(t)))
    return reversed_pairs(names, values)


def parse_kv(df: DataFrame, col: str = "all_key_value", tz: str | None = None) -> DataFrame:
    """``key:value`` text rows to the typed 1-minute warehouse columns; broken rows are left out.

    Keys keep no case, the last pair of a key wins, a missing key is null. ``occur_time`` gives epoch
    seconds and date; its text is in zone ``tz``, by default the session's. ``readwindspeed`` is scaled
    down.
    """
    keep = [c for c in df.columns if c != col]
    names, values = kv_pairs(F.col(col))
    parsed = df.where(is_valid_kv(F.col(col))).select(*keep, names.alias("_names"), values.alias("_values"))
    # Texts first, types after: a text that is looked at several times is picked once.
    texts = parsed.select(*keep, *[pick(F.col("_names"), F.col("_values"), p).alias("_" + p) for p in MINUTE_POINTS])

    out = []
    for point, column in MINUTE_POINTS.items():
        text = F.col("_" + point)
        kind = MINUTE_WAREHOUSE[column].dataType
        if point == "occur_time":
            epoch, date = local_text_to_epoch(missing_to_null(text), tz)
            out += [epoch.alias("data_time"), date.alias("date")]
        elif point == "readwindspeed":
            out.append((to_number(text) / F.lit(physics.WIND_SPEED_SCALE)).alias(column))
        elif isinstance(kind, T.StringType):
            out.append(missing_to_null(text).alias(column))
        else:
            out.append(to_number(text, kind.simpleString()).alias(column))
    return texts.select(*keep, *out)


def kv_rejects(df: DataFrame, col: str = "all_key_value") -> DataFrame:
    return df.where(~F.coalesce(is_valid_kv(F.col(col)), F.lit(False)))


def clean_ranges(df: DataFrame, rules: dict[str, tuple[float, float]] = MINUTE_RULES, upper_factor: float = 2.0) -> DataFrame:
    """Null every value outside ``[min, upper_factor * max]`` of its rule; rows stay."""
    checked = {
        field: F.when(F.col(field).between(F.lit(low), F.lit(high * upper_factor)), F.col(field))
        for field, (low, high) in rules.items()
        if field in df.columns
    }
    return df.withColumns(checked)


def split_arity(df: DataFrame, col: str, width: int, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows with ``width`` fields, the other rows)."""
    good = F.coalesce(F.size(F.split(F.col(col), sep)) == width, F.lit(False))
    return df.where(good), df.where(~good)


def parse_warehouse_text(df: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """Comma text of the 1-minute table to typed columns; missing markers become null."""
    good, _ = split_arity(df, col, len(MINUTE_WAREHOUSE), sep)
    fields = F.split(F.col(col), sep)
    out = []
    for i, f in enumerate(MINUTE_WAREHOUSE.fields):
        text = F.trim(fields[i])
        if isinstance(f.dataType, T.StringType):
            out.append(missing_to_null(text).alias(f.name))
        else:
            out.append(to_number(text, f.dataType.simpleString()).alias(f.name))
    return good.select(*out)


def remap_ids(
    df: DataFrame, mapping: DataFrame, key: str, source: str, target: str, keep_unmapped: bool = False
) -> DataFrame:
    """Replace ``key`` by ``target`` where ``source`` equals it. Unmapped rows drop, or keep their id.

    Of several targets of one source the greatest counts, so no row is doubled.
    """
    pairs = mapping.where(F.col(source).isNotNull()).groupBy(F.col(source).alias(key)).agg(F.max(target).alias("_target"))
    joined = lookup_join(df, pairs, key, "left" if keep_unmapped else "inner")
    new = F.coalesce("_target", key) if keep_unmapped else F.col("_target")
    return joined.withColumn(key, new).select(*df.columns)


def convert_units(df: DataFrame) -> DataFrame:
    """Nacelle position into [0, 360), outdoor temperature from Celsius to Kelvin."""
    return df.withColumns(
        {
            "nacellepositionave": physics.full_circle(F.col("nacellepositionave")),
            "temoutave": physics.to_kelvin(F.col("temoutave")),
        }
    )
