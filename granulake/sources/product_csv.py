"""Product rows from CSV files with the table's fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.functions.csv_text import CSV_OPTIONS
from granulake.operators.once import with_computed
from granulake.schemas import PRODUCT_SCHEMAS
from granulake.session import working_path

_CORRUPT = "_corrupt_record"
_FILE = "_file"


def _lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Every line as `_row`: the table's columns, its text if it does not load, and its file.

    The first line of each file is skipped and columns are taken by position,
    whatever the header says. All columns are parsed whichever are used later,
    so a row is judged by all of them. Folders below are read too.
    """
    schema = T.StructType(
        [*PRODUCT_SCHEMAS[table].fields, T.StructField(_CORRUPT, T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", True)
        .option("columnPruning", False)
        .option("timeZone", "UTC")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("recursiveFileLookup", True)
        .csv(folder)
        .withColumn(_FILE, F.col("_metadata.file_path"))
    )
    return with_computed(rows, "_row", F.struct(*rows.columns))


def read_product_csv(spark: SparkSession, folder: str, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that load, and rows that do not with their text in `_corrupt_record`."""
    row = F.col("_row")
    whole = _lines(spark, folder, table)
    good = whole.filter(row[_CORRUPT].isNull()).select("_row.*").drop(_CORRUPT, _FILE)
    bad = whole.filter(row[_CORRUPT].isNotNull()).select("_row.*").drop(_FILE)
    return good, bad


def read_product_files(spark: SparkSession, folder: str, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the files of which every line loads, and the other files.

    A file is loaded as a whole or not at all. Of a refused file: its path as
    `name`, and as `value` its first bad line in text order. Refused
    files are found by one pass, written to the shared folder, and kept out by an anti join on their
    paths, so a file may be read by many tasks, and is read twice in all.
    """
    row = F.col("_row")
    whole = _lines(spark, folder, table).select("_row")
    bad = whole.filter(row[_CORRUPT].isNotNull())
    refused = bad.groupBy(row[_FILE].alias("name")).agg(F.min(row[_CORRUPT]).alias("value"))
    path = working_path(spark, "refused")
    refused.write.parquet(path)
    refused = spark.read.schema(refused.schema).parquet(path)
    good = whole.filter(row[_CORRUPT].isNull()).select("_row.*").drop(_CORRUPT)
    kept = good.join(refused.select(F.col("name").alias(_FILE)), _FILE, "left_anti")
    return kept.drop(_FILE), refused
