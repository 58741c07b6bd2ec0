"""Comparing a Spark result with a DuckDB result over the same Parquet files."""

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events".split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(pdf.columns)
    return pdf[columns].sort_values(columns, ignore_index=True)


def differences(spark_result: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> str:
    """Empty when both give the same rows, else a short description."""
    left, right = ordered(spark_result.toPandas()), ordered(con.execute(sql).df())
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for name in left.columns:
        a, b = left[name], right[name]
        if a.dtype != b.dtype and {a.dtype.kind, b.dtype.kind} != {"O"} and len(a):
            if not (str(a.dtype) in ("object", "str") and str(b.dtype) in ("object", "str")):
                return f"{name}: type {a.dtype} != {b.dtype}"
        if a.dtype.kind == "f":
            same = (a == b) | (a.isna() & b.isna()) | ((a - b).abs() <= 1e-9 * b.abs())
        else:
            same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            row = same.idxmin()
            return f"{name}: {(~same).sum()} of {len(same)} differ, first {a[row]!r} != {b[row]!r}"
    return ""
