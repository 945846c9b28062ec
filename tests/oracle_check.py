"""Compare registered queries with their SQL: ``python tests/oracle_check.py SF_DIR [QUERY...]``."""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402


def normal(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(round(v, 6))
    return str(v)


def compare(spark, con, name, query, sql, sf_dir):
    import pandas as pd

    ours = query(spark, sf_dir).toPandas()
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    cols = sorted(ours.columns)
    clean = lambda df: sorted(tuple("null" if v is None or (not isinstance(v, (list, str)) and pd.isna(v)) else normal(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))
    a, b = clean(ours), clean(theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"{len(a)} rows against {len(b)}; e.g.\n   {str(only_a[:1])[:700]}\n   {str(only_b[:1])[:700]}"
    return ""


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


if __name__ == "__main__":
    import __spark_entry__ as e
    from loomspark.session import build_session

    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls = connect(sys.argv[1]), e.queries(), e.oracle_sql()
    for n in sys.argv[2:] or [q for q in qs if q in sqls]:
        t = time.time()
        try:
            why = compare(spark, con, n, qs[n], sqls[n], sys.argv[1])
        except Exception as x:  # noqa: BLE001
            why = f"{type(x).__name__}: {str(x)[:600]}"
        print(f"{'ok  ' if not why else 'DIFF'} {n} {time.time() - t:.1f}s {why}", flush=True)
