"""Spark-vs-DuckDB comparison used by the tests and by ``check_oracles.py``:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

import duckdb
import pandas as pd

from tessera.sources.registry import TEST_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v.is_integer() and abs(v) < 2 ** 53:
            return repr(int(v))
        return repr(round(v, 6))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pd.notna(pdf[cols]), None)
    return sorted(tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None))


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("\x1f".join(r).encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    res = {
        "rows_spark": len(a), "rows_oracle": len(b),
        "cols_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
        "hash_match": digest(a) == digest(b),
    }
    res["ok"] = res["cols_match"] and res["hash_match"] and len(a) == len(b)
    if not res["ok"]:
        res["cols"] = (sorted(spark_pdf.columns), sorted(duck_pdf.columns))
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["only_spark"], res["only_oracle"] = diff_a, diff_b
    return res
