"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/check_oracle.py [SF_DIR] [name-substring ...]
Order-insensitive: both results are normalised (columns sorted by name,
floats rounded to 6 places), then compared as multisets of rows.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans import ORACLES, QUERIES, load_all  # noqa: E402
from tessera.session import local_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 6)
    return v


SPARK_FAMILY = {"tinyint": "int32", "smallint": "int32", "int": "int32", "bigint": "int64", "double": "float64",
                "float": "float32", "string": "str", "boolean": "bool"}
DUCK_FAMILY = {"INTEGER": "int32", "SMALLINT": "int32", "TINYINT": "int32", "BIGINT": "int64", "HUGEINT": "int128",
               "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "str", "BOOLEAN": "bool"}


def type_report(sdf, desc):
    s = {n: SPARK_FAMILY.get(t, t) for n, t in sdf.dtypes}
    d = {x[0]: DUCK_FAMILY.get(str(x[1]), str(x[1])) for x in desc}
    return {n: (s[n], d.get(n)) for n in s if n in d and s[n] != d[n]}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [cols[i] for i in order]


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if not os.path.isdir(a)]
    load_all()
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name, fn in sorted(QUERIES.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception:
            print(f"FAIL-SPARK {name}\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = ORACLES.get(name)
        if sql is None:
            print(f"ROWS-ONLY  {name}: {len(srows)} rows ({dt:.1f}s)")
            ok += 1
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:
            print(f"FAIL-DUCK  {name}: {e}")
            bad += 1
            continue
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        if ac != bc:
            print(f"MISMATCH-COLS {name}: spark={ac} duck={bc}")
            bad += 1
        elif a != b:
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            print(f"MISMATCH   {name}: rows {len(a)} vs {len(b)}\n   spark-only {diff_a}\n   duck-only  {diff_b}")
            bad += 1
        else:
            diff = type_report(sdf, res.description)
            note = f"  TYPES {diff}" if diff else ""
            print(f"OK         {name}: {len(a)} rows ({dt:.1f}s){note}")
            ok += 1
    print(f"== {ok} ok, {bad} bad")


if __name__ == "__main__":
    main()
