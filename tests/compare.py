"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (round(v, 6) + 0.0)
    if isinstance(v, int):
        return float(v)
    if type(v).__name__ == "Decimal":
        return float(v)
    if hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def compare(spark, con, sf_dir, fn, sql) -> str:
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((tuple(cell(r[n]) for n in names) for r in df.collect()), key=repr)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns differ: {names} / {sorted(rel.columns)}"
    at = [rel.columns.index(n) for n in names]
    want = sorted((tuple(cell(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if len(got) != len(want):
        return f"rows differ: {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        close = all(_close(g, w) for g, w in bad)
        return f"{len(bad)} of {len(got)} rows differ{' (last digit)' if close else ''}: {names} {bad[0]}"
    return "" if got else "no rows"


def _close(g, w) -> bool:
    return all(a == b or (isinstance(a, float) and isinstance(b, float)
                          and abs(a - b) <= 2e-6 * max(1, abs(b))) for a, b in zip(g, w))


def main(sf: str, *only: str) -> None:
    import __spark_entry__ as entry
    from tests.sparksession import local_spark

    spark, con = local_spark(), connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            if name in oracle:
                out = compare(spark, con, sf, fn, oracle[name]) or "ok"
            else:
                out = f"rows only: {fn(spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            out = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:32s} {time.time() - t0:6.1f}s  {out[:900]}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
