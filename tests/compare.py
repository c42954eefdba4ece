"""Rows of Spark and of DuckDB in one comparable form."""

import os

import duckdb
import pandas as pd


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df.reindex(sorted(df.columns), axis=1)

    def text(v) -> str:
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "NULL"
        # A column of whole numbers with nulls is one of floats in one of the two, and not in the other.
        return str(int(v)) if isinstance(v, float) and v.is_integer() else repr(round(float(v), 6)) if isinstance(v, float) else str(v)

    return sorted(tuple(map(text, row)) for row in df.astype(object).itertuples(index=False))


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in os.listdir(folder):
        db.sql(f"create view {name.removesuffix('.parquet')} as select * from '{folder}/{name}'")
    return db
