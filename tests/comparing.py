"""Spark's result of a query against DuckDB's result of its SQL."""

import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    return v


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, data, query, sql):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = query(spark, data)
    mine = rows_of([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = rows_of(cur.fetchall(), names)
    assert sorted(df.columns) == sorted(names)
    assert len(mine) == len(theirs)
    assert mine == theirs
