"""Run a query beside its SQL on the same tables, and compare the rows."""

import glob
import os

import duckdb

from forumlens.llm.queries import ORACLES, QUERIES


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def compare(spark, name, sf_dir):
    names, want = sql_rows(ORACLES[name], sf_dir)
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    rows = [tuple(r) for r in got.select(*names).collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    return names, rows
