"""Run registered Spark queries and their DuckDB oracle side by side.

    python -m tests.oracle_compare [sf_dir] [key ...]

Columns are compared by name (sorted), rows as an order-free multiset; floats
are compared exactly after ``repr`` (use ``--tol`` to allow a relative error).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol: bool):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if tol else repr(v)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), tol)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), tol)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, tol)) for k, x in v.items()))
    return v


def spark_type_name(t) -> str:
    from pyspark.sql import types as T

    if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(t, T.LongType):
        return "BIGINT"
    if isinstance(t, T.DoubleType):
        return "DOUBLE"
    if isinstance(t, T.FloatType):
        return "FLOAT"
    if isinstance(t, T.StringType):
        return "VARCHAR"
    if isinstance(t, T.BooleanType):
        return "BOOLEAN"
    if isinstance(t, T.DateType):
        return "DATE"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(t, T.ArrayType):
        return spark_type_name(t.elementType) + "[]"
    return str(t)


def type_mismatches(df, con, sql: str) -> dict:
    rel = con.sql(sql)
    dt = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    st = {f.name: spark_type_name(f.dataType) for f in df.schema.fields}
    return {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}


def compare(spark, sf_dir: str, key: str, con=None, tol: bool = False) -> dict:
    from __spark_entry__ import oracle_sql, queries

    q = queries()[key]
    t0 = time.time()
    df = q(spark, sf_dir)
    cols = df.columns
    rows = df.collect()
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(rows), "spark_sec": round(t_spark, 2)}
    sql = oracle_sql().get(key)
    if sql is None:
        out["oracle"] = "none"
        return out
    con = con or duck(sf_dir)
    out["type_mismatches"] = type_mismatches(df, con, sql)
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    out["oracle_rows"] = len(orows)
    if sorted(cols) != sorted(ocols):
        out["match"] = False
        out["why"] = f"columns differ: spark-only {sorted(set(cols) - set(ocols))} " \
                     f"oracle-only {sorted(set(ocols) - set(cols))}"
        return out
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    a = Counter(tuple(_norm(r[i], tol) for i in si) for r in rows)
    b = Counter(tuple(_norm(r[i], tol) for i in oi) for r in orows)
    out["match"] = a == b
    if a != b:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        out["why"] = f"cols={order}\n spark-only={only_a}\n oracle-only={only_b}"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from leadsmith.session import get_spark
    from __spark_entry__ import queries

    tol = "--tol" in argv
    argv = [a for a in argv if a != "--tol"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(queries())
    spark = get_spark()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con, tol)
        except Exception as e:  # report and continue
            r = {"key": k, "match": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("match", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + f"{k}: " +
              ", ".join(f"{x}={r[x]}" for x in ("spark_rows", "oracle_rows", "spark_sec", "oracle") if x in r))
        if not ok:
            print("    " + r.get("why", ""))
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
