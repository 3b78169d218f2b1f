"""Spark query vs DuckDB oracle: row count, column names/types and an
order-insensitive comparison of all values.

CLI: ``python tests/oracle_check.py [--sf DIR] [name ...]``
"""

from __future__ import annotations

import argparse
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "StringType()": "VARCHAR",
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "BooleanType()": "BOOLEAN",
    "DateType()": "DATE",
    "ShortType()": "SMALLINT",
    "FloatType()": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _spark_type(dt) -> str:
    s = repr(dt)
    if s.startswith("DecimalType"):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return SPARK_TO_DUCK.get(s, s)


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if isinstance(v, decimal.Decimal):
        return (1, str(v))
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (1, str(v))
    return (1, str(v))


def compare(spark, name: str, sf_dir: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    scols = df.columns
    stypes = [_spark_type(f.dataType) for f in df.schema.fields]
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    else:
        dmap = dict(zip(dcols, dtypes))
        for c, t in zip(scols, stypes):
            if dmap[c] != t:
                problems.append(f"type {c}: spark={t} duck={dmap[c]}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        a = sorted(tuple(_norm(r[i]) for i in si) for r in rows)
        b = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
        if len(a) != len(b):
            problems.append(f"rows spark={len(a)} duck={len(b)}")
        if a != b:
            sa, sb = set(a), set(b)
            only_s = [x for x in a if x not in sb][:3]
            only_d = [x for x in b if x not in sa][:3]
            problems.append(f"values differ; spark-only {only_s}; duck-only {only_d}")
    res["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="a default session, as the driver may use")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    import __spark_entry__ as entry
    from strata.session import local_session

    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    qs, oracles = entry.queries(), entry.oracle_sql()
    names = args.names or list(qs)
    con = duck(args.sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, args.sf, qs[n], oracles.get(n), con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
