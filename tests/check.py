"""Compare registered queries with their SQL in DuckDB: names, row counts and exact values.

Usage: python tests/check.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x) or x is pd.NA:
            return "~"
        if isinstance(x, bool):
            return str(x)
        if hasattr(x, "isoformat"):
            return str(pd.Timestamp(x))
        if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
            return str([cell(y) for y in x])
        try:
            f = float(x)
            return repr(0.0 if f == 0 else f) if not isinstance(x, str) else x
        except (TypeError, ValueError):
            return str(x)

    cols = sorted(pdf.columns)
    return sorted(tuple(cell(v) for v in row) for row in pdf[cols].astype(object).itertuples(index=False, name=None))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} / {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"rows differ: {len(spark_pdf)} / {len(duck_pdf)}"
    a, b = canonical(spark_pdf), canonical(duck_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {sorted(spark_pdf.columns)}, first:\n   {bad[0][0]}\n   {bad[0][1]}"
    kinds = []
    for c in spark_pdf.columns:
        x, y = spark_pdf[c].dtype.kind, duck_pdf[c].dtype.kind
        if x != y and {x, y} & {"f"} and not spark_pdf[c].isna().any():
            kinds.append(f"{c}:{spark_pdf[c].dtype}/{duck_pdf[c].dtype}")
    return "ok" + (f" (types {kinds})" if kinds else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from salesline import get_session

    spark = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(args.sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args.names and not any(name == n or name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            pdf = fn(spark, args.sf).toPandas()
            took = time.time() - start
            if name in sqls:
                start = time.time()
                result = compare(pdf, con.execute(sqls[name]).df())
                duck = f"{time.time() - start:.1f}"
            else:
                result, duck = "no SQL", "-"
        except Exception as e:  # report and go on with the next query
            took, duck, result = time.time() - start, "-", f"ERROR {type(e).__name__}: {str(e)[:900]}"
        failed += not result.startswith(("ok", "no SQL"))
        print(f"{name:34s} spark {took:6.2f}s duck {duck}s rows {len(pdf) if 'pdf' in locals() else 0} {result}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
