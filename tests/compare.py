"""Compare a registered Spark query with its DuckDB oracle (order-insensitive).

Usable from tests and from the command line:
    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if v != v else v
    if isinstance(v, (np.floating,)):
        f = float(v)
        return None if f != f else f
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, (np.ndarray, list, tuple)):
        return tuple(_canon(x) for x in v)
    if v is pd.NaT:
        return None
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_canon(v) for v in rec))
    return out


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(spark, con, name: str, sf_dir: str, show: int = 5) -> dict:
    from __spark_entry__ import oracle_sql, queries

    t0 = time.time()
    sdf = queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    cur = con.execute(oracle_sql()[name])
    odf = pd.DataFrame.from_records(cur.fetchall(), columns=[d[0] for d in cur.description])
    t2 = time.time()
    res = {"query": name, "spark_rows": len(sdf), "oracle_rows": len(odf), "spark_s": round(t1 - t0, 2),
           "oracle_s": round(t2 - t1, 2)}
    if sorted(sdf.columns) != sorted(odf.columns):
        res["ok"] = False
        res["columns"] = (sorted(sdf.columns), sorted(odf.columns))
        return res
    a, b = sorted(_rows(sdf), key=_key), sorted(_rows(odf), key=_key)
    res["ok"] = a == b
    if not res["ok"]:
        cols = sorted(sdf.columns)
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:show]
        only_o = [r for r in b if r not in sa][:show]
        res["cols"] = cols
        res["only_spark"] = only_s
        res["only_oracle"] = only_o
        res["n_only_spark"] = sum(1 for r in a if r not in sb)
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from holdwise.session import local_session
    from __spark_entry__ import oracle_sql

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(oracle_sql())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        r = compare(spark, con, n, sf_dir)
        bad += not r["ok"]
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
