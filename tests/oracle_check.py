"""Run queries() against oracle_sql() the way the driver does (local tool).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
        return "NULL"
    if isinstance(v, float):
        # pandas turns a long column with nulls into floats
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(v) for v in row) for row in df[cols].itertuples(index=False))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    oracles = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in oracles:
            print(f"ROWS {name}: {len(sdf)} rows ({dt:.1f}s)")
            continue
        odf = con.execute(oracles[name]).df()
        same_cols = sorted(sdf.columns) == sorted(odf.columns)
        ok = same_cols and len(sdf) == len(odf) and digest(sdf) == digest(odf)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: spark={len(sdf)} oracle={len(odf)} "
              f"cols={'same' if same_cols else (sorted(sdf.columns), sorted(odf.columns))} ({dt:.1f}s)")
        if not ok and same_cols:
            print("   spark dtypes:", dict(sdf.dtypes.astype(str)), "\n   duck dtypes:", dict(odf.dtypes.astype(str)))
            print("   spark head:", sdf.sort_values(sorted(sdf.columns)).head(3).to_dict("records"))
            print("   duck  head:", odf.sort_values(sorted(odf.columns)).head(3).to_dict("records"))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
