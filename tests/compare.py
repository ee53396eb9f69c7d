"""Run a registered query and its SQL, and list where they differ."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf, t)}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, (bool, int)):
            return str(int(v))
        if isinstance(v, float):
            return repr(v + 0.0) if v != int_or_inf(v) else str(int(v))
        return str(v)

    def int_or_inf(v):
        return int(v) if abs(v) < 1e15 else float("nan")

    ordered = df[sorted(df.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    ours = pd.DataFrame([tuple(r) for r in spark_df.collect()], columns=spark_df.columns, dtype=object)
    cur = con.execute(sql)
    theirs = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description], dtype=object)
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"]
    a, b = _canonical(ours), _canonical(theirs)
    if len(a) != len(b):
        return [f"rows {len(a)} / {len(b)}"]
    return [f"{x} / {y}" for x, y in zip(a, b) if x != y]
