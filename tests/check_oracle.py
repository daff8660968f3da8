"""Compare registered queries with their SQL: ``check_oracle.py [sf] [name ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(
        tuple("" if v is None or v is pd.NA or v != v else str(v) for v in row)
        for row in df.itertuples(index=False)
    )


def compare(spark, con, name, sf_dir):
    got = contract.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(contract.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}", len(got)
    a, b = normal(got), normal(want)
    if a == b:
        return "", len(got)
    left = [r for r in a if r not in set(b)][:2]
    right = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} vs {len(b)}; only spark {left}; only sql {right}", len(got)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    names = sys.argv[2:] or list(contract.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            fault, n = compare(spark, con, name, sf_dir)
        except Exception as e:
            fault, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        bad += bool(fault)
        print(f"{'FAIL' if fault else 'ok'} {name} {n} {time.time() - start:.1f}s {fault}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main()
