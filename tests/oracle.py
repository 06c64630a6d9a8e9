"""Side-by-side comparison of a Spark query and its DuckDB SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def same(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    assert columns == sorted(c[0] for c in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted((tuple(plain(v) for v in r) for r in con.execute(f"SELECT {names} FROM ({sql})").fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
