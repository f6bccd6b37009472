"""Frame comparison against an independent SQL engine on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def sql_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con.execute(sql).df()


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[c]):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(frame[c]):
            frame[c] = frame[c].astype(float)
        elif pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype(float)
        elif frame[c].map(lambda v: v is None or isinstance(v, (int, float))).all():
            frame[c] = frame[c].astype(float)
        else:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    return frame.sort_values(list(frame.columns), kind="stable", na_position="last").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows, otherwise a short account of the first difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    a, b = _plain(got), _plain(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} values of {c}, first {a[c][i]!r} against {b[c][i]!r}"
    return None
