"""Run a registered query and its SQL over the same tables and compare the rows."""

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def compare(con, df, sql) -> list[str]:
    """Problems found, empty if both give the same columns and rows."""
    mine = sorted(df.columns)
    rel = con.sql(sql)
    theirs = sorted(rel.columns)
    if mine != theirs:
        return [f"columns {mine} != {theirs}"]
    a = sorted(tuple(_norm(r[c]) for c in mine) for r in (x.asDict() for x in df.collect()))
    at = [rel.columns.index(c) for c in mine]
    b = sorted(tuple(_norm(r[i]) for i in at) for r in rel.fetchall())
    if a == b:
        return []
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return [f"rows {len(a)} vs {len(b)}", str(mine), f"spark only {only_a}", f"sql only {only_b}"]
