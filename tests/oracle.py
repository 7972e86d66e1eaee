"""Compare registered queries with their DuckDB oracles.

Run as a script:  python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, run, sql):
    """None when both sides agree, else what differs."""
    df = run(spark, sf_dir)
    got = df.collect()
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        expected = DUCK_TYPES.get(kind, kind.upper())
        if expected.replace(" ", "") != duck_types[name].replace(" ", ""):
            return f"type of {name}: spark {kind}, duckdb {duck_types[name]}"
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    if a != b:
        return f"rows {len(got)} vs {len(want)}\n  only spark  {list((a - b).items())[:3]}\n" \
               f"  only duckdb {list((b - a).items())[:3]}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args[1:] or queries:
        started = time.time()
        try:
            fault = compare(spark, con, sf_dir, queries[name], oracles[name])
        except Exception as e:  # report and go on with the next query
            fault = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if fault is None else 'FAIL'} {name} {time.time() - started:.1f}s"
              + ("" if fault is None else f"\n  {fault}"), flush=True)
        bad += fault is not None
    print(f"{bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
