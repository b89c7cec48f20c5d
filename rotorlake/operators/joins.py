"""Dimension joins: broadcast behind a measured size, salted shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 << 20
SALTS = 16
ROW_OVERHEAD = 16

_FIXED = {T.DoubleType: 8, T.LongType: 8, T.TimestampType: 8, T.TimestampNTZType: 8}


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``: fixed widths times the row count plus the length of texts and nested values.

    One distributed aggregate; only its single row comes to the driver.
    """
    fixed = ROW_OVERHEAD + sum(_FIXED.get(type(f.dataType), 4) for f in df.schema.fields)
    texts = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    nested = (T.ArrayType, T.MapType, T.StructType)
    texts += [F.to_json(F.struct(f.name)) for f in df.schema.fields if isinstance(f.dataType, nested)]
    sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    row = df.agg(F.count(F.lit(1)), *sizes).first()
    return row[0] * fixed + sum(row[1:])


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def row_hash(df: DataFrame):
    """A hash of the row's content only, so a re-run task gives every row the same one."""
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def row_salt(df: DataFrame, salts: int = SALTS):
    """Salt that depends on the row's content only."""
    return F.pmod(row_hash(df), F.lit(salts)).cast("int")


def salted_join(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Shuffle join that spreads each key of ``fact`` over ``salts`` tasks; ``dim`` is copied per salt."""
    if salts == 1:
        return fact.join(dim, on, how)
    left = fact.withColumn("_salt", row_salt(fact, salts))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join a fact with a dimension on equal keys without shuffling the fact when the dimension is small.

    Only inner and left joins: others would repeat unmatched rows of the dimension for every salt. Where no key can have
    more rows than a task takes, one salt spares the copies of the dimension.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join takes inner or left, not {how}")
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim, max_bytes):
        return fact.join(F.broadcast(dim), keys, how)
    return salted_join(fact, dim, keys, how, salts)
