"""Compare a registered Spark query with its DuckDB oracle.

Mirrors the driver's gate: row count, column names (sorted) and an
order-insensitive hash of the values.  Used by the tests and by hand:

    python -m forumlens.plans.oracle_check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import sys
import time

from ..sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, int):
        return v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def _digest(cols: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return len(rows), [cols[i] for i in order], h


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_oracle(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def run_spark(spark, fn, sf_dir: str):
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    return list(df.columns), rows


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    scols, srows = run_spark(spark, fn, sf_dir)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    ocols, orows = run_oracle(con, sql)
    sd, od = _digest(scols, srows), _digest(ocols, orows)
    res.update(oracle_rows=len(orows), rows_match=sd[0] == od[0], schema_match=sd[1] == od[1],
               hash_match=sd[2] == od[2])
    res["status"] = "ok" if (sd == od) else "MISMATCH"
    if sd[1] != od[1]:
        res["spark_cols"], res["oracle_cols"] = sd[1], od[1]
    if sd != od and sd[1] == od[1]:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_o = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
        b = sorted(repr(tuple(_norm(r[i]) for i in order_o)) for r in orows)
        sa, sb = set(a), set(b)
        res["only_spark"] = [x[:400] for x in sorted(sa - sb)[:3]]
        res["only_oracle"] = [x[:400] for x in sorted(sb - sa)[:3]]
    return res


def main(argv: list[str]) -> int:
    from .. import session
    from .registry import entries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = session.build_session()
    con = duck_connect(sf_dir)
    bad = 0
    for name, e in entries().items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, e.fn, e.sql, sf_dir)
        except Exception as ex:  # report and continue
            r = {"name": name, "status": "ERROR", "error": repr(ex)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"bad={bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
