"""Compare a Spark query with its DuckDB oracle (row count, schema, values).

Usage: ``python -m polyvox.plans.check [sf_dir] [name ...]``. Mirrors the
driver's gate: columns sorted by name, rows compared order-insensitively.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from polyvox.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, sf_dir: str, q) -> dict:
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_pdf = pd.DataFrame(s_rows, columns=sdf.columns)
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_pdf), "spark_sec": round(t1 - t0, 2)}
    if q.sql is None:
        out["status"] = "rows-only"
        return out
    d_pdf = con.execute(q.sql).fetchdf()
    out["oracle_rows"] = len(d_pdf)
    if sorted(s_pdf.columns) != sorted(d_pdf.columns):
        out["status"] = f"SCHEMA spark={sorted(s_pdf.columns)} oracle={sorted(d_pdf.columns)}"
        return out
    a, b = frame_rows(s_pdf), frame_rows(d_pdf)
    if a == b:
        out["status"] = "OK"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["status"] = f"VALUES differ (rows {len(a)} vs {len(b)}): {diff}"[:800]
    return out


def main(argv: list[str]) -> int:
    from polyvox.plans.catalog import load_all
    from polyvox.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    reg = load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, sf_dir, q)
        except Exception as e:  # noqa: BLE001 - report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:600]}"}
        bad += r["status"] not in ("OK", "rows-only")
        print(r, flush=True)
    print(f"{bad} failing", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
