"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, Spark vs DuckDB column types, row counts and the
order-insensitive multiset of rows (floats rounded to 6 places).
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                    f"read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        dt = dict(zip(d_cols, d_types))
        for c, t in zip(s_cols, s_types):
            want = SPARK_TO_DUCK.get(t, t.upper())
            if dt[c] != want:
                problems.append(f"type {c}: spark {t} duck {dt[c]}")
    if len(s_rows) != len(d_rows):
        problems.append("row count")
    if not problems or all(p.startswith("type") for p in problems):
        a = rows_of(s_cols, s_rows)
        b = rows_of(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") \
        else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from chorus.session import build_session
    import __spark_entry__ as e
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in names or list(qs):
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), sf_dir)
        except Exception as ex:  # report and go on
            r = {"name": n, "status": "ERROR", "error": repr(ex)[:600]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print(f"{len(names or qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
