"""Run a registered query and its SQL, and compare rows, columns and types."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN"}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def connect(folder):
    c = duckdb.connect()
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            c.sql(f"create view {t} as select * from '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return c


def assert_same(df, sql, folder):
    rel = connect(folder).sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    cols = sorted(df.columns)
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        assert KINDS.get(kind, kinds[name]) == kinds[name], (name, kind, kinds[name])
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == want
