"""Run every named query on Spark and its SQL on DuckDB, and compare all values.

    python -m workload.check [folder of tables] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from visitfold.lake import SPARK_SETTINGS
from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
)


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("visitfold")
        .config(map=SPARK_SETTINGS)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(Path(tempfile.gettempdir()) / "visitfold-scratch"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(rows: pd.DataFrame) -> list[tuple]:
    names = sorted(rows.columns)
    values = rows[names].astype(object).where(rows[names].notna(), None)
    return sorted((tuple(map(str, row)) for row in values.itertuples(index=False)))


def compare(answer: DataFrame, database: duckdb.DuckDBPyConnection, sql: str) -> str:
    got, want = answer.toPandas(), database.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns differ: {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows differ: {len(got)} / {len(want)}"
    for name in want.columns:
        # whole numbers with nulls come from Spark as floats
        if str(want[name].dtype) == "Int64" and got[name].dtype == "float64":
            got[name] = got[name].astype("Int64")
    for left, right in zip(canonical(got), canonical(want)):
        if left != right:
            return f"values differ: {left} / {right}"
    kinds = [
        f"{name} {got[name].dtype}/{want[name].dtype}"
        for name in got.columns
        if got[name].dtype != want[name].dtype
    ]
    return f"ok {len(got)} rows" + (f"  types {kinds}" if kinds else "")


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> None:
    spark, database = session(), duckdb.connect()
    database.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    for name, run in QUERIES.items():
        if names and name not in names:
            continue
        begin = time.perf_counter()
        try:
            result = compare(run(spark, folder), database, ORACLE[name])
        except Exception as error:
            result = f"failed: {str(error)[:400]}"
        print(f"{name:28} {time.perf_counter() - begin:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
