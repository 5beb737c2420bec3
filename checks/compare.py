"""Run check queries against their SQL and print the differences.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import oracle, registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rulefold-checks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in one order, values as text."""
    def text(value) -> str:
        if pd.api.types.is_scalar(value) and pd.isna(value):
            return "NULL"
        if isinstance(value, float) and value == int(value):
            return str(int(value))
        return str(value)

    out = pd.DataFrame({c: [text(v) for v in df[c].astype(object)] for c in sorted(df.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    if a.equals(b):
        return None
    rows = (a != b).any(axis=1)
    got_rows, want_rows = (x[rows].head(2).to_dict("records") for x in (a, b))
    return f"{int(rows.sum())} rows differ, e.g.\n{got_rows}\n{want_rows}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), duckdb_over(args.sf)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, query in registry.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            got = query(spark, args.sf).toPandas()
            seconds = time.time() - start
            sql = oracle.queries().get(name)
            problem = difference(got, con.execute(sql).df()) if sql else None
        except Exception as error:  # a failing query must not hide the others
            seconds, problem, got = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}", []
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} rows={len(got)} {seconds:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
