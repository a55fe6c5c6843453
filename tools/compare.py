"""Run the registered queries and their SQL on the same tables and report differences.

Values must be equal to the last digit, and column types must correspond.

Usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.plans import registry  # noqa: E402


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = registry.load()
    names = sys.argv[2:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = df.collect()
            spent = time.time() - started
            if name not in oracle:
                print(f"ok    {name}: {len(got)} rows, no SQL ({spent:.1f}s)")
                continue
            cursor = con.execute(oracle[name])
            sql_names = [d[0] for d in cursor.description]
            want = cursor.fetchall()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:1500]}")
            continue
        types = [(n, str(d[1])) for n, d in zip(sql_names, cursor.description)]
        if sorted((c, SQL_TYPES.get(t, t)) for c, t in df.dtypes) != sorted(types):
            bad += 1
            print(f"BAD   {name}: columns {df.dtypes} / {types}")
            continue
        a, b = rows_of(df.columns, got), rows_of(sql_names, want)
        if a == b:
            print(f"ok    {name}: {len(a)} rows ({spent:.1f}s)")
            continue
        bad += 1
        only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
        print(f"BAD   {name}: {len(a)} / {len(b)} rows, {len(only_a)} / {len(only_b)} differ; {sorted(sql_names)}")
        for x in only_a[:3]:
            print("   spark ", x)
        for x in only_b[:3]:
            print("   sql   ", x)
    print(f"{bad} bad of {len(names)}")


if __name__ == "__main__":
    main()
