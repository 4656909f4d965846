"""Compare every registered Spark query with its DuckDB oracle.

usage: python tools/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows (spark/oracle), column match, value match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from rankforge.session import get_session  # noqa: E402
from rankforge.plans.registry import load_all  # noqa: E402
from rankforge.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(df: pd.DataFrame) -> tuple[str, list[str]]:
    cols = sorted(df.columns)
    rows = sorted("|".join(norm(r[c]) for c in cols) for r in
                  df[cols].astype(object).where(df[cols].notna(), None).to_dict("records"))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest(), rows


def main():
    args = sys.argv[1:]
    root = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    keys = [a for a in args if not os.path.isdir(a)]
    if os.environ.get("DRIVER_LIKE"):
        # A plain session with default settings, as a driver would create it.
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    if os.environ.get("DRIVER_LIKE"):
        import importlib.util
        spec = importlib.util.spec_from_file_location(
            "spark_entry", os.path.join(os.path.dirname(os.path.dirname(
                os.path.abspath(__file__))), "__spark_entry__.py"))
        entry_mod = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry_mod)
        n = len(entry_mod.entry(spark).collect())
        print(f"entry rows={n}")
    reg = load_all()
    bad = 0
    for key, q in reg.items():
        if keys and key not in keys:
            continue
        t0 = time.time()
        try:
            sdf = q.run(spark, root).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{key:24s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = q.oracle()
        if sql is None:
            print(f"{key:24s} rows={len(sdf)} (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"{key:24s} ORACLE ERROR {str(e)[:300]}")
            bad += 1
            continue
        cols_ok = sorted(sdf.columns) == sorted(odf.columns)
        hs, rs = digest(sdf) if cols_ok else ("", [])
        ho, ro = digest(odf) if cols_ok else ("", [])
        ok = cols_ok and len(sdf) == len(odf) and hs == ho
        bad += 0 if ok else 1
        if cols_ok:
            dt = {c: (str(sdf[c].dtype), str(odf[c].dtype)) for c in sdf.columns
                  if str(sdf[c].dtype) != str(odf[c].dtype)}
            if dt:
                print(f"   dtype differences {key}: {dt}")
        print(f"{key:24s} {'OK ' if ok else 'BAD'} rows={len(sdf)}/{len(odf)} "
              f"cols={'ok' if cols_ok else (sorted(sdf.columns), sorted(odf.columns))} "
              f"{ts:.1f}s")
        if not ok and cols_ok:
            diff_s = sorted(set(rs) - set(ro))[:3]
            diff_o = sorted(set(ro) - set(rs))[:3]
            print("   spark-only:", diff_s)
            print("   oracle-only:", diff_o)
            print("   dtypes spark:", dict(sdf.dtypes.astype(str)),
                  "oracle:", dict(odf.dtypes.astype(str)))
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main()
