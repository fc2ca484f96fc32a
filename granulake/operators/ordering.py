"""Global order at any size: positions, pages and first-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granulake.session import shared_folder

_ROW_BITS = 33  # of monotonically_increasing_id, below the partition number


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Number rows from 1 in a global order without a single-task window.

    Rows are range-partitioned and sorted over all order columns, so ties on
    the first are split too. The sorted rows are checkpointed because range
    bounds are sampled anew in each run; positions are then the row number
    inside a partition plus the row count of the partitions before it. Only
    those counts, one per partition, are broadcast.
    """
    shared_folder(df.sparkSession)
    ordered = df.orderBy(*order).checkpoint()
    placed = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name)
    )


def page(df: DataFrame, order: list[str], offset: int, rows: int) -> DataFrame:
    """Rows `offset + 1 .. offset + rows` of a total order, cut by position whatever their number."""
    position = F.col("_position")
    return (
        with_position(df, order, "_position")
        .filter((position > offset) & (position <= offset + rows))
        .drop("_position")
    )


def first_rows(df: DataFrame, order: list[str], rows: int | None) -> DataFrame:
    """The first rows of a total order; all rows, unsorted, when `rows` is None."""
    return df if rows is None else page(df, order, 0, rows)
