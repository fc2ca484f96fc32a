"""Mapping config file."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from granulake.operators.mapping import mapped_columns


def load_mapping(spark: SparkSession, path: str) -> dict:
    """Read and check a mapping config from any file system Spark can read."""
    config = json.loads(spark.read.text(path, wholetext=True).first()[0])
    for type_config in config.values():
        mapped_columns(type_config)
    return config
