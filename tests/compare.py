"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf] [name ...]``."""

import datetime
import decimal
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(record[i]) for i in order) for record in records)


def compare(spark, connection, folder, name, query, sql):
    """None when both agree, otherwise what differs."""
    df = query(spark, folder)
    got_columns, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    want_columns, want = rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(differing)} of {len(got)} differ, first {differing[0]}" if differing else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "8").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in queries().items():
        if (sys.argv[2:] and name not in sys.argv[2:]) or name not in oracle_sql():
            continue
        start = time.time()
        try:
            problem = compare(session, connection, folder, name, query, oracle_sql()[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print("failed:", failed)
    sys.exit(bool(failed))
