"""Compare every registered query with its comparison SQL.

    python -m workload.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple(map(repr, row)) for row in frame.itertuples(index=False)))


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None if both hold the same columns and the same rows in any order."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for mine, theirs in zip(rows_of(left), rows_of(right)):
        if mine != theirs:
            return f"{mine}\n   against {theirs}"
    return None


def check(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[str | None, int]:
    mine = QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLE[name]).df()
    for frame in (mine, theirs):
        for column in frame.columns:
            if "date" in column.lower() and column != "AsOfDate":
                frame[column] = frame[column].astype(str).str[:10]
    return differences(_plain(mine), _plain(theirs)), len(mine)


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole and fractional numbers as plain Python values."""
    return pd.DataFrame(
        {c: pd.Series(frame[c].tolist(), dtype=object) for c in frame.columns}
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            problem, rows = check(spark, con, name, sf_dir)
        except Exception as error:  # show which query broke and go on with the others
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} rows={rows} {time.time() - start:.1f}s {problem or ''}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
