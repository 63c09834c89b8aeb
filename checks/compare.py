"""Run registered queries in Spark and DuckDB on the same tables and compare the rows.

    python -m checks.compare [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import time
from collections import Counter

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import QUERIES, SQL

TABLES = ["documents", "embeddings", "benchmark", "conversations"]


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
            return "NULL"
        if isinstance(v, float):
            return repr(v + 0.0)
        return repr(v.item() if hasattr(v, "item") else v)

    return sorted(tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False, name=None))


def differences(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str, queries: dict = QUERIES, sql: dict = SQL
) -> list[str]:
    """What differs between both engines; empty if nothing does."""
    mine = queries[name](spark, sf).toArrow()
    if name not in sql:
        return [] if mine.num_rows >= 0 else ["no rows"]
    theirs = con.sql(sql[name]).to_arrow_table()
    found = []
    types = lambda t: {f.name: str(f.type).replace("large_", "") for f in t.schema}
    if types(mine) != types(theirs):
        found.append(f"types {types(mine)} != {types(theirs)}")
    a, b = _canonical(mine.to_pandas()), _canonical(theirs.to_pandas())
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        extra, missing = Counter(a) - Counter(b), Counter(b) - Counter(a)
        found.append(f"only spark {str(list(extra)[:2])[:600]} only sql {str(list(missing)[:2])[:600]}")
    if not a:
        found.append("both empty")
    return found


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = []
    for name in args.names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, name, args.sf)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        state = "ok" if not found else "DIFFERS"
        print(f"{state:8} {name:28} {time.time() - start:6.2f}s {'' if name in SQL else '(rows only)'}", *found, sep="\n    " if found else " ", flush=True)
        bad += [name] if found else []
    print("all equal" if not bad else f"{len(bad)} differ: {bad}")


if __name__ == "__main__":
    main()
