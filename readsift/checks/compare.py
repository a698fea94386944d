"""Run registered queries in Spark and their SQL twins in DuckDB, and compare the rows."""

import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(spark, sf_dir, name, fn, sql, con=None):
    """(message, Spark seconds, DuckDB seconds); the message is empty when all rows agree."""
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return ("" if got else "no rows"), len(got), t1 - t0, 0.0
    con = con or connect(sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got), t1 - t0, t2 - t1
    a, b = _rows(df.columns, got), _rows(names, want)
    message = ""
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        message = f"{len(a)} vs {len(b)} rows; Spark only {only_a[:2]}; SQL only {only_b[:2]}"
    return message, len(got), t1 - t0, t2 - t1
