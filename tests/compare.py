"""Run registered queries against their SQL and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _key(row):
    return tuple((value is None, str(type(value)), value) if value is not None else (True, "", 0) for value in row)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()), key=_key)


def duck_rows(connection, sql: str):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=_key)


def main():
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = duck(sf_dir), oracle_sql(), []
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.monotonic()
        try:
            got = spark_rows(query(spark, sf_dir))
            took = time.monotonic() - started
            if name not in oracles:
                print(f"{name}: {len(got[1])} rows, no oracle ({took:.2f}s)", flush=True)
                continue
            want = duck_rows(connection, oracles[name])
        except Exception as err:
            print(f"{name}: ERROR {str(err)[:1500]}", flush=True)
            bad.append(name)
            continue
        same = got == want
        print(f"{name}: {'same' if same else 'DIFFERENT'} {len(got[1])}/{len(want[1])} rows ({took:.2f}s)", flush=True)
        if not same:
            bad.append(name)
            print("  spark", got[0], [r for r in got[1] if r not in set(want[1])][:3])
            print("  duck ", want[0], [r for r in want[1] if r not in set(got[1])][:3])
    print("bad:", bad)


if __name__ == "__main__":
    main()
