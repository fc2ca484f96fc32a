"""Evaluate-once boundary for expensive expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, alias: str, value: Column) -> DataFrame:
    """Add a struct column that later filters read instead of recomputing.

    A filter on a projected expression is pushed below the projection and the
    expression is copied into it, so a JSON parse would run once for the filter
    and once more for the output. Filters on a generated column stay above the
    generator. The generated array has one element: no row is added or lost.
    """
    return df.select("*", F.explode(F.array(value)).alias(alias))
