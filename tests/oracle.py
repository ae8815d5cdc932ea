"""Run a registered query and its SQL twin on the same tables and compare the whole results."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(query, sql: str, spark, con, sf_dir: str) -> int:
    """Row count when equal; raises with the first difference otherwise."""
    frame = query(spark, sf_dir)
    got = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _sorted(names, cursor.fetchall())
    assert sorted(frame.columns) == sorted(names), (frame.columns, names)
    for mine, theirs in zip(got, want):
        assert repr(mine) == repr(theirs), f"\n  spark  {mine}\n  duckdb {theirs}"
    assert len(got) == len(want), (len(got), len(want))
    return len(got)
