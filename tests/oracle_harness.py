"""Run registered queries beside their DuckDB oracles and compare results.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
Compares row count, column names, arrow types (reported) and an
order-insensitive multiset of rows (exact, and with floats at 9 digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(table, cols, digits):
    d = table.to_pydict()
    n = table.num_rows
    out = [tuple(_norm(d[c][i], digits) for c in cols) for i in range(n)]
    return sorted(out, key=repr)


def compare(spark, con, key, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    st = sdf.toArrow()
    t1 = time.time()
    res = {"key": key, "spark_rows": st.num_rows, "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    dt = con.sql(sql).arrow()
    if hasattr(dt, "read_all"):
        dt = dt.read_all()
    res["oracle_rows"] = dt.num_rows
    scols, dcols = sorted(st.column_names), sorted(dt.column_names)
    if scols != dcols:
        res["status"] = f"COLUMNS {sorted(set(scols) ^ set(dcols))}"
        return res
    tmis = []
    for c in scols:
        a, b = str(st.schema.field(c).type), str(dt.schema.field(c).type)
        a, b = a.replace("large_string", "string"), b.replace("large_string", "string")
        if a != b:
            tmis.append(f"{c}:{a}/{b}")
    res["type_mismatch"] = tmis
    if st.num_rows != dt.num_rows:
        res["status"] = "ROWCOUNT"
        return res
    if rows_of(st, scols, None) == rows_of(dt, scols, None):
        res["status"] = "exact" if not tmis else "TYPES"
    elif rows_of(st, scols, 9) == rows_of(dt, scols, 9):
        res["status"] = "approx9" if not tmis else "TYPES"
    else:
        a, b = rows_of(st, scols, 9), rows_of(dt, scols, 9)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["status"] = "VALUES"
        res["diff"] = repr(diff)[:600]
    return res


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    keys = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            keys.append(a)
    from pyspark.sql import SparkSession
    import __spark_entry__ as E
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    tally = {}
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "err": str(e)[:800]}
        if r["status"] not in ("exact", "approx9", "rows-only"):
            bad += 1
        tally[r["status"]] = tally.get(r["status"], 0) + 1
        print(r, flush=True)
    print("SUMMARY", tally)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
