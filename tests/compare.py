"""Runs registered queries next to their SQL counterparts: python tests/compare.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({c: [_cell(v) for v in frame[c]] for c in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return str(value)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else a short description."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    a, b = canonical(spark_rows), canonical(sql_rows)
    if a.equals(b):
        return None
    unlike = (a != b).any(axis=1)
    at = unlike.idxmax()
    return f"{int(unlike.sum())} of {len(a)} rows differ, first:\n  {a.loc[at].to_dict()}\n  {b.loc[at].to_dict()}"


def main() -> None:
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            start = time.time()
            rows = query(spark, sf_dir).toPandas()
            spark_time = time.time() - start
            if name not in sql:
                print(f"{name}: {len(rows)} rows, no SQL, {spark_time:.1f}s", flush=True)
                continue
            start = time.time()
            expected = connection.sql(sql[name]).df()
            sql_time = time.time() - start
            schema = {n: t for n, t in zip(connection.sql(sql[name]).columns, connection.sql(sql[name]).types)}
            kinds = {n: str(t) for n, t in schema.items()}
            result = difference(rows, expected)
            print(f"{name}: {result or 'same'}, {len(rows)} rows, {spark_time:.1f}s / {sql_time:.1f}s", flush=True)
            if len(sys.argv) > 2:
                print("   ", kinds, query(spark, sf_dir).dtypes)
        except Exception as error:  # show every query
            print(f"{name}: FAILED {type(error).__name__} {str(error)[:1500]}", flush=True)


if __name__ == "__main__":
    main()
