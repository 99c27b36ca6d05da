"""Run registered Spark queries and their DuckDB oracle SQL side by side.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and order-insensitive values (floats
rounded to 6 places). Used by pytest and by hand while iterating."""
from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plaint.sources.fixtures import TABLES  # noqa: E402,F401


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:19]
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, con=None, verbose=True):
    from plaint.plans.registry import load_all
    e = load_all()[name]
    t0 = time.time()
    sdf = e.fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t0
    if e.sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "sec": ts}
    con = con or duck(sf_dir)
    t0 = time.time()
    res = con.execute(e.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t0
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "sec": ts, "oracle_sec": td}
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return out
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a == b:
        out["ok"] = True
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out.update(ok=False, why=f"values differ; first: {diff}" if len(a) == len(b)
                   else f"row count {len(a)} vs {len(b)}")
    return out


def main(argv):
    from plaint.plans.registry import load_all
    from plaint.session import local_session
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(load_all())
    spark = local_session(8, 8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf, n, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok-or-unchecked")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
