"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the correctness gate: row count, column names, order-insensitive values.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def spark_rows(df):
    """(columns, rows) of a Spark result; nulls stay None, also in columns of whole numbers."""
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


def rows_of(result):
    names, rows = result
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    out = []
    for rec in ([r[i] for i in at] for r in rows):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_result, duck_result, tol=1e-9):
    sc, sr = rows_of(spark_result)
    dc, dr = rows_of(duck_result)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duck={len(dr)}"
    exact = sr == dr
    if exact:
        return "ok"
    bad = 0
    for a, b in zip(sr, dr):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, (float, int)) and y is not None:
                if not (abs(x - y) <= tol * max(1.0, abs(y))):
                    bad += 1
            elif x != y:
                bad += 1
    if bad == 0:
        return "close"
    first = next(((a, b) for a, b in zip(sr, dr) if a != b), None)
    return f"values differ ({bad} cells); first: spark={first[0]} duck={first[1]}"


def main():
    import faulthandler
    if os.environ.get("ORACLE_TRACE"):
        faulthandler.dump_traceback_later(int(os.environ["ORACLE_TRACE"]), exit=True)
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from ranklift.session import get_spark
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    names = names or list(qs)
    summary = {}
    for n in names:
        t0 = time.time()
        try:
            sp = spark_rows(qs[n](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            summary[n] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(n, summary[n], flush=True)
            continue
        t1 = time.time()
        if n not in sql:
            summary[n] = f"no-sql rows={len(sp[1])}"
        else:
            try:
                dk = duck_rows(con, sql[n])
                summary[n] = compare(sp, dk)
            except Exception as e:  # noqa: BLE001
                summary[n] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
        print(f"{n:32s} {t1 - t0:6.2f}s rows={len(sp[1]):6d} {summary[n]}", flush=True)
    bad = [n for n, v in summary.items() if not (v in ("ok", "close") or v.startswith("no-sql"))]
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
