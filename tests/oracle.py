"""Run every registered query next to its SQL and compare the results.

    python -m tests.oracle [folder of tables] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=lambda r: [(v is None, v) for v in r])


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What is different, None if names, types and rows are the same."""
    expected, actual = con.sql(sql).to_arrow_table(), result.toArrow()
    types = [{f.name: str(f.type).removeprefix("large_") for f in t.schema} for t in (actual, expected)]
    if types[0] != types[1]:
        return f"types {types[0]} instead of {types[1]}"
    if actual.num_rows != expected.num_rows:
        return f"{actual.num_rows} rows instead of {expected.num_rows}"
    if rows(actual.to_pandas()) != rows(expected.to_pandas()):
        return "other values"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from twinview.session import build_session, drop_table_dirs

    spark: SparkSession = build_session(
        "oracle", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            if name in oracles:
                problem = difference(result, con, oracles[name])
                outcome = problem or f"equal, {result.count()} rows"
            else:
                problem, outcome = None, f"no SQL, {result.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = outcome = f"{type(error).__name__}: {str(error)[:600]}"
        drop_table_dirs(spark)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32} {time.time() - start:6.1f}s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
