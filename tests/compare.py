"""Spark result against DuckDB result of one registered query."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=_key)


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted((tuple(_cell(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    return [columns[i] for i in order], rows


def difference(df, con, sql) -> str | None:
    """None when both sides agree, else a short account of the first differences."""
    names, got = spark_rows(df)
    expected_names, expected = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got == expected:
        return None
    only_got = sorted(set(got) - set(expected), key=_key)[:3]
    only_expected = sorted(set(expected) - set(got), key=_key)[:3]
    return f"{len(got)} vs {len(expected)} rows; spark only {only_got}; duckdb only {only_expected}"
