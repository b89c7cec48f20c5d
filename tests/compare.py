"""Order-free comparison of a Spark result with DuckDB SQL over the same tables."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for name in sorted(frame.columns):
        col = frame[name]
        if pd.api.types.is_bool_dtype(col) or set(map(type, col.dropna().unique())) <= {bool}:
            out[name] = [None if pd.isna(v) else str(bool(v)) for v in col]
        elif pd.api.types.is_numeric_dtype(col):
            # Minus zero is zero.
            out[name] = [None if pd.isna(v) else float(v) + 0.0 for v in col]
        elif pd.api.types.is_datetime64_any_dtype(col):
            out[name] = [None if pd.isna(v) else v.isoformat() for v in col]
        else:
            out[name] = [None if v is None or v is pd.NaT else str(v).removesuffix(" 00:00:00") for v in col]
    plain = pd.DataFrame(out, dtype=object)
    return plain.sort_values(list(plain.columns), key=lambda c: c.map(str)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """Text of the first difference, None if both hold the same rows."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(set(spark_frame.columns) ^ set(sql_frame.columns))}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    for name in ours.columns:
        differs = ours[name].map(str) != theirs[name].map(str)
        if differs.any():
            at = differs.idxmax()
            return f"{name}: {int(differs.sum())} rows, first {ours.loc[at].to_dict()} / {theirs.loc[at].to_dict()}"
    return None
