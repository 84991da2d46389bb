"""Spark results against DuckDB on the same tables: columns by name, rows in any order."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return round(value, 6)
    return list(map(plain, value)) if isinstance(value, list) else value


def differences(df, con, sql):
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return [f"columns {names} and {sorted(columns)}"]
    at = [columns.index(c) for c in names]
    want = sorted((tuple(plain(r[k]) for k in at) for r in result.fetchall()), key=repr)
    if len(got) != len(want):
        return [f"{len(got)} rows and {len(want)}"]
    return [f"{a!r}\n{b!r}" for a, b in zip(got, want, strict=True) if a != b][:3]
