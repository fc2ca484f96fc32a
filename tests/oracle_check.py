"""Run every query against its SQL oracle: `python tests/oracle_check.py [sf_dir] [names...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    frame = frame[sorted(frame.columns)]
    out = pd.DataFrame()
    for column in frame.columns:
        values = frame[column]
        if str(values.dtype).startswith("datetime64"):
            values = values.astype("datetime64[us]")
        out[column] = [None if pd.isna(v) else _text(v) for v in values]
    return out.sort_values(list(out.columns), na_position="first").reset_index(drop=True)


def _text(value) -> str:
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype") and value.dtype.kind in "iuf":
        return repr(float(value))
    return str(value)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(spark: SparkSession, sf_dir: str, name: str, query, sql: str) -> str | None:
    mine = comparable(query(spark, sf_dir).toPandas())
    theirs = comparable(oracle_connection(sf_dir).execute(sql).df())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} / {list(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    unequal = ~((mine == theirs) | (mine.isna() & theirs.isna()))
    if unequal.to_numpy().any():
        column = unequal.any().idxmax()
        row = unequal[column].idxmax()
        return f"{column}: {mine.loc[row, column]!r} / {theirs.loc[row, column]!r}"
    return None if len(mine) else "no rows"


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = difference(spark, sf_dir, name, queries[name], oracles[name])
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
