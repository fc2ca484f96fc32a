"""The load job: product CSV files to a product table, file by file."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from granulake.schemas import REJECT_SCHEMA
from granulake.sinks.product_tables import REJECTS, ProductTables
from granulake.sources.product_csv import read_product_files


def load_files(spark: SparkSession, folder: str, table: str, tables: ProductTables, run: str) -> None:
    """Load the files of a folder; those with a bad line go to the rejects instead.

    `run` names the load: loading under the same name again replaces what it
    gave before, in the table and in the rejects.
    """
    rows, refused = read_product_files(spark, folder, table)
    known = {"table_name": F.lit(table), "reason": F.lit("bad_file")}
    rejects = refused.select(*[known.get(name, F.col(name)).alias(name) for name in REJECT_SCHEMA.names])
    tables.ensure()
    # rejects of several tables may be loaded under one name
    tables.load(rows, table, f"{run}-{table}", 0)
    tables.load(rejects, REJECTS, f"{run}-{table}", 0)
