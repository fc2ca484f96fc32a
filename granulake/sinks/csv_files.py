"""CSV output: product datasets and the ordered metadata export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granulake.functions.csv_text import CSV_OPTIONS
from granulake.operators.mapping import mapped_header_line
from granulake.operators.tracking import QUEUE_ORDER, exportable


def write_product_csv(
    rows: DataFrame, folder: str, mode: str = "errorifexists", partitions: Sequence[str] = ()
) -> None:
    """Product rows as CSV files, each with a header line, in a folder per value of `partitions`."""
    (
        rows.write.mode(mode)
        .partitionBy(*partitions)
        .options(**CSV_OPTIONS)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timeZone", "UTC")
        .csv(folder)
    )


def write_export(
    tracking: DataFrame,
    config: dict,
    project: str,
    file_type: str,
    folder: str,
    mode: str = "errorifexists",
) -> None:
    """Header line, then the stored lines oldest first.

    One global sort; part files in name order are the export.
    """
    spark = tracking.sparkSession
    lines = exportable(tracking, project, file_type)
    header = spark.range(1).select(
        F.lit(mapped_header_line(config, file_type)).alias("data"),
        *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in QUEUE_ORDER],
        F.lit(0).alias("_part"),
    )
    (
        lines.withColumn("_part", F.lit(1))
        .unionByName(header)
        .orderBy("_part", *QUEUE_ORDER)
        .select("data")
        .write.mode(mode)
        .text(folder)
    )


def read_export(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of an export with their `position`; 0 is the header line.

    Parts follow each other by name, lines by their place in a part. Only the
    number of lines of each part is put in one order.
    """
    parts = (
        spark.read.text(folder, wholetext=True)
        .select(F.col("_metadata.file_name").alias("part"), F.split(F.col("value"), "\n").alias("lines"))
    )
    # text files end each line, so what follows the last end is no line
    lengths = parts.select("part", (F.size("lines") - 1).cast("bigint").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), "n")
    placed = parts.join(starts, "part").select("start", "n", F.posexplode("lines").alias("at", "line"))
    return placed.filter(F.col("at") < F.col("n")).select((F.col("start") + F.col("at")).alias("position"), "line")
