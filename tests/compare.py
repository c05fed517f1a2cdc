"""Run a query and its SQL form on the same Parquet files and compare the results."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Values as objects, None where there is none. A whole-number column with gaps may arrive as floats or as integers."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns[frame.isna().any()]:
        kind = frame[name].dtype
        if pd.api.types.is_integer_dtype(kind) or (pd.api.types.is_float_dtype(kind) and (frame[name].dropna() % 1 == 0).all()):
            frame[name] = frame[name].astype("Int64")
    return frame.astype(object).where(frame.notna(), None)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None when both hold the same rows in any order: exact, but for the last digit of doubles."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    for name in spark_rows.columns:
        kinds = {c: spark_rows[name].dtype if c == 0 else sql_rows[name].dtype for c in (0, 1)}
        if spark_rows[name].notna().all() and kinds[0] != kinds[1] and "object" not in str(kinds) and "str" not in str(kinds):
            return f"type of {name}: {kinds[0]} != {kinds[1]}"
    a, b = (sorted(map(tuple, _plain(f).itertuples(index=False)), key=repr) for f in (spark_rows, sql_rows))
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    return None
