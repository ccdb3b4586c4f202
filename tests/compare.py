"""Run registered queries on Spark and their SQL on DuckDB; compare strictly.

python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, float):
        return f"f{v!r}"
    return f"{type(v).__name__}:{v}"


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, con, folder, query, sql) -> str | None:
    df = query(spark, folder)
    ours = canonical(df.columns, [tuple(row) for row in df.collect()])
    if sql is None:
        return None if ours[1] else "no rows"
    cursor = con.execute(sql)
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    if ours[1] != theirs[1]:
        bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
        return f"{len(bad)} of {len(ours[1])} rows differ, first {bad[0]}"
    return None if ours[1] else "no rows"


def main() -> None:
    from tidemark.plans.catalog import ORACLE, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = session(), database(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, folder, QUERIES[name], ORACLE.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name:28s} {kind} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")


if __name__ == "__main__":
    main()
