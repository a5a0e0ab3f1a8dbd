"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(9) + 0.0
        elif pd.api.types.is_integer_dtype(df[c]) or pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("int64") if not df[c].isna().any() else df[c].astype("float64")
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else str(v))
    return df.sort_values(list(df.columns), kind="stable", na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = _plain(ours), _plain(theirs)
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype.kind == "f" or y.dtype.kind == "f":
            same = np.isclose(x.astype(float), y.astype(float), rtol=1e-12, atol=1e-9, equal_nan=True)
        else:
            same = ((x == y) | (x.isna() & y.isna())).to_numpy()
        if not same.all():
            i = int(np.argmin(same))
            return f"column {c!r} row {i}: {x.iloc[i]!r} != {y.iloc[i]!r} ({(~same).sum()} differ)"
    return None


def type_notes(ours: pd.DataFrame, theirs: pd.DataFrame) -> list[str]:
    return [f"{c}: {ours[c].dtype}/{theirs[c].dtype}" for c in ours.columns
            if c in theirs.columns and ours[c].dtype.kind != theirs[c].dtype.kind]


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from lateline.session import local_session

    spark = local_session()
    con = connect(folder)
    queries, sql, bad = entry.queries(), entry.oracle_sql(), 0
    picked = [n for n in queries if not names or any(n.startswith(p) for p in names)]
    for name in picked:
        start = time.time()
        try:
            ours = queries[name](spark, folder).toPandas()
            took, problem, notes = time.time() - start, None, []
            if name in sql:
                theirs = con.execute(sql[name]).df()
                problem, notes = differences(ours, theirs), type_notes(ours, theirs)
        except Exception as error:
            took, problem, notes, ours = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", [], []
        bad += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {len(ours)} rows {took:.1f}s {problem or ''} {notes or ''}",
              flush=True)
    print(f"{len(picked)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
