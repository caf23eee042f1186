"""Run catalogue queries in Spark and their SQL in DuckDB, and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names, type families and an order-insensitive
multiset of rows (floats compared after rounding to 9 decimals; ORACLE_EXACT=1 compares them bit for bit).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

EXACT = bool(os.environ.get("ORACLE_EXACT"))  # compare doubles bit for bit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0 if EXACT else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _family(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "long", "int64"):
        return "int64"
    if t in ("int", "integer", "int32"):
        return "int32"
    if t in ("double", "float64"):
        return "double"
    if t in ("string", "varchar"):
        return "string"
    if t == "date":
        return "date"
    return t


def spark_rows(df):
    cols = df.columns
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    types = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    return cols, rows, types


def duck_rows(con, sql):
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")  # the driver makes a view, too
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    types = {}
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    for name, typ, *_ in desc:
        types[name] = _family(typ)
    return cols, rows, types


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            scols, srows, stypes = spark_rows(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only ({len(srows)} rows)"
            if verbose:
                print(f"{name:28s} {results[name]}  {ts:.1f}s", flush=True)
            continue
        try:
            dcols, drows, dtypes = duck_rows(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            results[name] = f"SQL ERROR {e}"
            print(name, results[name], flush=True)
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"columns {sorted(scols)} vs {sorted(dcols)}")
        else:
            tdiff = {c: (stypes[c], dtypes.get(c)) for c in scols if stypes[c] != dtypes.get(c)}
            if tdiff:
                problems.append(f"types {tdiff}")
            order = sorted(scols)
            si = [scols.index(c) for c in order]
            di = [dcols.index(c) for c in order]
            sset = sorted((tuple(r[i] for i in si) for r in srows), key=repr)
            dset = sorted((tuple(r[i] for i in di) for r in drows), key=repr)
            if len(srows) != len(drows):
                problems.append(f"rows {len(srows)} vs {len(drows)}")
            if sset != dset:
                extra = [r for r in sset if r not in dset][:3]
                missing = [r for r in dset if r not in sset][:3]
                problems.append(f"values differ; spark-only {extra} oracle-only {missing}")
        results[name] = "OK" if not problems else "; ".join(problems)
        if verbose:
            print(f"{name:28s} {results[name][:600]}  ({len(srows)} rows, {ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from quarry.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok or rows-only; failing: {sorted(bad)}")
