"""Queue steps on the tracking table. Each returns rows; none changes a table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granulake.operators.joins import join_unique
from granulake.operators.ordering import first_rows
from granulake.schemas import CLAIMED, DONE, QUEUED

# Files per claim, and the cap meaning "all".
DEFAULT_BATCH_SIZE = 50
NO_CAP = -1

# Oldest first; the path settles equal times.
QUEUE_ORDER = ["mtime", "path"]
_KEY = ["project", "filename"]


def claim_rows(batch_size: int, max_to_process: int) -> int | None:
    """How many rows a run claims: whole batches until the cap is reached."""
    if batch_size < 1:
        raise ValueError(f"batch size {batch_size}")
    if max_to_process == NO_CAP:
        return None
    return math.ceil(max(max_to_process, 0) / batch_size) * batch_size


def claim(tracking: DataFrame, project: str, rows: int | None) -> DataFrame:
    """Queued rows to work on, as they were before being claimed."""
    queued = tracking.filter((F.col("inqueue") == QUEUED) & (F.col("project") == project))
    return first_rows(
        queued.select("filename", "path", "mtime", "file_type"), QUEUE_ORDER, rows
    )


def apply_updates(tracking: DataFrame, updates: DataFrame, keys: list[str] = _KEY) -> DataFrame:
    """Replace `data, inqueue` of every row with an updated key, by default
    project + filename.

    `updates` holds one row per key. Rows sharing a key are all updated;
    other rows pass through.
    """
    new = updates.select(
        *keys, F.struct(F.col("data").alias("data"), F.col("inqueue").alias("inqueue")).alias("_new")
    )
    joined = join_unique(tracking, new, keys, "left")
    changed = F.col("_new").isNotNull()
    value = {
        "data": F.when(changed, F.col("_new.data")).otherwise(F.col("data")),
        "inqueue": F.when(changed, F.col("_new.inqueue")).otherwise(F.col("inqueue")),
    }
    return joined.select(*[value.get(c, F.col(c)).alias(c) for c in tracking.columns])


def changed_rows(files: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates by file name as one update for each row they reach.

    `files` holds `project, filename, path`; the result `project, path, data, inqueue`.
    """
    return join_unique(files, updates, _KEY, "inner").select("project", "path", "data", "inqueue")


def claimed_updates(claimed: DataFrame, project: str) -> DataFrame:
    """The updates of a claim: state 2 and cleared data."""
    names = claimed.select(F.lit(project).alias("project"), "filename").distinct()
    return names.withColumns({"data": F.lit(""), "inqueue": F.lit(CLAIMED)})


def done_updates(lines: DataFrame, project: str) -> DataFrame:
    """The updates of a completion: state 0 and, of each file name, the last line
    in queue order.

    `lines` holds `filename, path, mtime, csv_line`.
    """
    last = F.max(F.struct(*QUEUE_ORDER, "csv_line")).alias("_last")
    return (
        lines.groupBy("filename")
        .agg(last)
        .select(
            F.lit(project).alias("project"),
            "filename",
            F.col("_last.csv_line").alias("data"),
            F.lit(DONE).alias("inqueue"),
        )
    )


def queue_counts(tracking: DataFrame) -> DataFrame:
    """Files per project and state."""
    return tracking.groupBy("project", "inqueue").agg(F.count("*").alias("files"))


def exportable(tracking: DataFrame, project: str, file_type: str) -> DataFrame:
    """Rows with a stored line, in whatever state."""
    return tracking.filter(
        (F.col("file_type") == file_type)
        & (F.col("data") > "")
        & (F.col("project") == project)
    ).select("data", *QUEUE_ORDER)
