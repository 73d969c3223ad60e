"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usable from pytest and standalone:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    try:
        import pandas as pd

        if v is pd.NaT or (not isinstance(v, (str, bytes, list, tuple, dict)) and pd.isna(v)):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return f"{v:.6f}"
    if isinstance(v, int) and not isinstance(v, bool):
        return str(v)
    return str(v)


def canon(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted(tuple(_cell(x) for x in row) for row in pdf[cols].itertuples(index=False, name=None))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, str]:
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK_ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = f"rows-only {len(sdf)}"
        else:
            try:
                ddf = con.execute(sqls[name]).df()
            except Exception as e:  # noqa: BLE001
                results[name] = f"DUCK_ERROR {str(e)[:300]}"
                if verbose:
                    print(name, results[name], flush=True)
                continue
            if sorted(sdf.columns) != sorted(ddf.columns):
                results[name] = f"SCHEMA {sorted(sdf.columns)} vs {sorted(ddf.columns)}"
            elif len(sdf) != len(ddf):
                results[name] = f"ROWS {len(sdf)} vs {len(ddf)}"
            else:
                a, b = canon(sdf), canon(ddf)
                if a == b:
                    results[name] = f"OK {len(sdf)}"
                else:
                    bad = [(x, y) for x, y in zip(a, b) if x != y]
                    results[name] = f"VALUES {len(bad)} differ; cols={sorted(sdf.columns)}; first={bad[:2]}"
        if verbose:
            print(f"{name}: {results[name][:600]}  ({t1 - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from forgeline.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v[:300])
