"""The catalogue jobs: walk, process, export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from granulake.operators.catalog import match_locations, new_tracking_rows, unseen_files
from granulake.functions.paths import day_folder, object_name
from granulake.operators.joins import join_unique, likely
from granulake.operators.mapping import own_line, with_csv_line, with_csv_lines
from granulake.operators.tracking import (
    DEFAULT_BATCH_SIZE,
    NO_CAP,
    changed_rows,
    claim,
    claim_rows,
    claimed_updates,
    done_updates,
)
from granulake.plans.ingest import NO_VERSION, latest_named, newest_header
from granulake.schemas import QUEUED
from granulake.session import working_path
from granulake.sinks.csv_files import write_export
from granulake.sinks.tracking_table import TrackingStore

_KEYS = ["name", "day"]


@dataclass(frozen=True)
class Processed:
    """Accounting of one process run."""

    claimed: int
    processed: int
    rejected: int
    still_queued: int


def _written(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Store an intermediate result in the shared folder and read it back, so
    that later steps neither repeat it nor depend on lost executors. The rows
    are counted as they are written."""
    path = working_path(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def walk(
    store: TrackingStore,
    listing: DataFrame,
    location_root: str,
    locations: list[str],
    file_types: list[str],
) -> None:
    """Queue listed files the project does not track yet: one join, one append."""
    files = match_locations(listing, location_root, locations, file_types)
    unseen = unseen_files(files, store.files(), store.project)
    store.append(new_tracking_rows(unseen, store.project))


def located_headers(claimed: DataFrame, headers: DataFrame, location_root: str) -> DataFrame:
    """Claimed files with their latest header from a header store.

    An object's name is its path below the root. Days are part of the key, so a
    small claim opens only the days it names. A claim holds a path once or a few times, so
    no key is hot and the headers stay where they were grouped: their texts are shuffled once.
    """
    named = _named(claimed, location_root)
    return named.join(latest_named(headers, named, _KEYS), _KEYS).drop(*_KEYS)


def _named(claimed: DataFrame, location_root: str) -> DataFrame:
    """Claimed files below the root with the `name` and `day` of their header."""
    # Spark prunes days at run time only for a side that is filtered
    below = claimed.filter(F.col("path").startswith(location_root.rstrip("/") + "/"))
    named = below.withColumn("name", object_name(F.col("path"), location_root))
    return named.withColumn("day", day_folder(F.col("name")))


def located_lines(
    claimed: DataFrame, headers: DataFrame, config: dict, store_prefix: str, location_root: str
) -> DataFrame:
    """Claimed files with the `csv_line` of their latest header from a header store.

    Lines are read out of the headers where they are stored, and only lines are shuffled. Texts are
    shuffled where several headers of one name have its latest version, since of these the greatest text counts.
    """
    named = _named(claimed, location_root)
    headers = headers.join(named.select("day").distinct(), "day", "left_semi")
    headers = likely(headers, named.select("name"), "name").withColumn(
        "path", F.concat(F.lit(location_root.rstrip("/") + "/"), "name")
    )
    lined = with_csv_lines(headers, config, store_prefix)
    best = lined.groupBy(*_KEYS).agg(F.max_by("csv_lines", "version").alias("csv_lines"))

    versions = headers.groupBy(*_KEYS, "version").agg(F.count("*").alias("n"))
    # an unknown version is the earliest
    known = F.coalesce("version", F.lit(NO_VERSION))
    tied = versions.groupBy(*_KEYS).agg(F.max_by("n", known).alias("n")).filter("n > 1").select(*_KEYS)
    # a name that only looks tied gets the same line again
    greatest = likely(headers, tied, "name").groupBy(*_KEYS, "path").agg(newest_header())
    greatest = with_csv_lines(greatest, config, store_prefix).select(*_KEYS, F.struct("csv_lines").alias("_tied"))

    found = named.join(best, _KEYS).join(greatest, _KEYS, "left")
    lines = F.when(F.col("_tied").isNotNull(), F.col("_tied.csv_lines")).otherwise(F.col("csv_lines"))
    found = found.withColumn("csv_line", own_line(F.col("file_type"), lines, config))
    return found.drop(*_KEYS, "csv_lines", "_tied")


def extract_lines(
    claimed: DataFrame,
    headers: DataFrame,
    config: dict,
    store_prefix: str,
    location_root: str | None = None,
) -> DataFrame:
    """`filename, path, mtime, csv_line` of the claimed files that can be read
    and typed.

    `headers` holds `path, header`, or with a `location_root` is a header store.
    """
    if location_root is None:
        files = claimed.join(headers.select("path", "header"), "path")
        lines = with_csv_line(files, config, store_prefix)
    else:
        lines = located_lines(claimed, headers, config, store_prefix, location_root)
    return lines.filter(F.col("csv_line").isNotNull()).select("filename", "path", "mtime", "csv_line")


def process(
    store: TrackingStore,
    headers: DataFrame,
    config: dict,
    store_prefix: str,
    batch_size: int = DEFAULT_BATCH_SIZE,
    max_to_process: int = NO_CAP,
    rejects: str | None = None,
    location_root: str | None = None,
) -> Processed:
    """Claim queued files, extract their fields, store each file's CSV line.

    Both steps add updates as large as the claim; `TrackingStore.fold` merges them
    into the table now and then. `headers` as in `extract_lines`.
    Files without a header, of a type the config lacks, or with a header that
    cannot be read stay claimed and are added to the `rejects` folder if one
    is given.
    """
    project = store.project
    table = store.read()
    claimed, count = _written(claim(table, project, claim_rows(batch_size, max_to_process)), "claimed")
    queued = F.col("inqueue") == QUEUED
    if count == 0:
        return Processed(0, 0, 0, table.filter(queued).count())
    store.update(changed_rows(store.files(), claimed_updates(claimed, project)))
    lines, processed = _written(extract_lines(claimed, headers, config, store_prefix, location_root), "lines")
    store.update(changed_rows(store.files(), done_updates(lines, project)))
    if rejects is not None:
        rejected_files(claimed, lines).write.mode("append").parquet(rejects)
    return Processed(count, processed, count - processed, store.read().filter(queued).count())


def rejected_files(claimed: DataFrame, lines: DataFrame) -> DataFrame:
    """Claimed files without a line."""
    return join_unique(claimed, lines.select("path").distinct(), ["path"], "left_anti")


def export(store: TrackingStore, config: dict, file_type: str, folder: str) -> None:
    """Write the stored lines of one file type as ordered CSV text."""
    write_export(store.read(), config, store.project, file_type, folder)
