"""Text helpers: missing markers, positional lookup, pairs, ids in paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
MISSING_MARKERS = ["N/A", "NULL", "\\N", ""]


def missing_to_null(col: Column) -> Column:
    return F.when(~F.trim(col).isin(MISSING_MARKERS), col)


def to_number(col: Column, kind: str = "double") -> Column:
    """Typed value, null for a missing marker (none of them is a number), a bad number or NaN."""
    number = col.try_cast(kind)
    return nan_to_null(number) if kind == "double" else number


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def pick(names: Column, values: Column, name: str) -> Column:
    """Value at the last place where ``names`` holds ``name``; null if there is none.

    Both arrays come reversed from ``reversed_pairs``, so the first hit is the last pair of the row.
    """
    return F.get(values, F.array_position(names, name) - 1)


def reversed_pairs(names: Column, values: Column) -> tuple[Column, Column]:
    return F.reverse(names), F.reverse(values)


def pairs_text(names: Column, values: Column, pair: str = ":", sep: str = ",") -> Column:
    """``name:value,name:value`` over two arrays of equal length."""
    return F.array_join(F.zip_with(names, values, lambda n, v: F.concat(n, F.lit(pair), v)), sep)


def ten_minute_text(col: Column) -> Column:
    """Floor a ``yyyy-MM-dd HH:mm:ss`` text to its ten minutes."""
    return F.concat(F.substring(col, 1, 15), F.lit("0:00"))


def partition_spec(path: Column, levels: int = 2) -> Column:
    """``k1="v1", k2="v2"`` from the last ``k=v`` parts of a path."""
    parts = F.slice(F.split(F.rtrim(path, F.lit("/")), "/"), -levels, levels)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.replace(p, F.lit("="), F.lit('="')), F.lit('"'))), ", ")


def local_text_to_epoch(col: Column, tz: str | None = None) -> tuple[Column, Column]:
    """(epoch seconds, ``yyyyMMdd``) of a local ``yyyy-MM-dd HH:mm:ss`` text, two nulls if it does not parse.

    ``tz`` is the zone of the text, by default that of the session.
    """
    ts = F.try_to_timestamp(col, F.lit("yyyy-MM-dd HH:mm:ss"))
    if tz is not None:
        ts = F.convert_timezone(F.lit(tz), F.current_timezone(), ts.cast("timestamp_ntz")).cast("timestamp")
    return F.unix_seconds(ts), F.when(ts.isNotNull(), F.replace(F.substring_index(col, " ", 1), F.lit("-"), F.lit("")))
