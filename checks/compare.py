"""Run queries on Spark and their SQL on DuckDB and compare: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def session(cpus: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]").appName("urlsieve")
            .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.codegen.hugeMethodLimit", "8000")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
            .getOrCreate())


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(t: str) -> str:
    t = t.lower()
    if t in ("boolean", "string", "varchar", "double"):
        return {"string": "varchar"}.get(t, t)
    return t


def _cell(v):
    return "NULL" if v is None or v != v else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, name, fn, sql, sf_dir) -> str:
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    spent = time.time() - start
    if sql is None:
        return f"rows {len(got)}  {spent:.1f}s" if got else "EMPTY"
    start = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]).lower() for d in cur.description}
    want = cur.fetchall()
    a, b = rows_of(df.columns, got), rows_of(names, want)
    times = f"{len(got)} rows  {spent:.1f}s  duckdb {time.time() - start:.1f}s"
    if a[0] != b[0]:
        return f"COLUMNS {a[0]} != {b[0]}"
    odd = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes
           if {"bigint": "bigint", "int": "integer", "string": "varchar"}.get(t, t) != types[c]]
    if a[1] != b[1]:
        bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]
        return f"VALUES differ {len(a[1])}/{len(b[1])} {a[0]} {bad}"
    return ("TYPES " + str(odd) + " " if odd else "ok  ") + times


def main(argv) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from checks.registry import QUERIES, SQL
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in wanted:
        try:
            result = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
        except Exception as err:  # report and go on to the next query
            result = f"ERROR {type(err).__name__} {str(err)[:700]}"
        bad += not result.startswith(("ok", "rows"))
        print(f"{name:28s} {result}", flush=True)
    print(f"{len(wanted)} queries, {bad} not matching", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
