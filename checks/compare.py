"""Run registered queries against DuckDB: python -m checks.compare [folder] [name part ...]"""

from __future__ import annotations

import sys
import time
import traceback
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks import registry


def open_tables(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con, folder: str, name: str, query, sql: str) -> str | None:
    got = query(spark, folder)
    ran = con.execute(sql)
    want_names = [d[0] for d in ran.description]
    if sorted(got.columns) != sorted(want_names):
        return f"columns {sorted(got.columns)} != {sorted(want_names)}"
    ours, theirs = rows_of(got.columns, got.collect()), rows_of(want_names, ran.fetchall())
    if ours == theirs:
        return None
    extra = [r for r in ours if r not in set(theirs)][:3]
    missing = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows != {len(theirs)}; ours only {extra}; theirs only {missing}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = open_tables(folder), registry.oracle_sql()
    bad = 0
    for name, query in registry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            found = differences(spark, con, folder, name, query, sql[name]) if name in sql else None
        except Exception:
            found = traceback.format_exc(limit=-2)[-1500:]
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
