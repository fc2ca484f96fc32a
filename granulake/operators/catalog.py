"""Listed files against the tracking table."""

from __future__ import annotations

import posixpath
import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granulake.functions.paths import basename, glob_prefix, matches_glob
from granulake.operators.joins import join_unique
from granulake.schemas import QUEUED, TRACKING_SCHEMA

# What is walked unless told otherwise.
DEFAULT_LOCATIONS = ["ABI-L2-MCMIPM/2017/*/*/*.nc", "ABI-L1b-RadM/2017/*/*/*.nc"]
DEFAULT_FILE_TYPES = ["mcm", "rad"]


def location_patterns(location_root: str, locations: list[str]) -> list[str]:
    """Globs of the locations; one that is absolute, by a slash or a scheme, wins
    over the root."""
    return [
        location if re.match("[A-Za-z][A-Za-z0-9+.-]*:/", location) else posixpath.join(location_root, location)
        for location in locations
    ]


def match_locations(
    listing: DataFrame, location_root: str, locations: list[str], file_types: list[str]
) -> DataFrame:
    """Files under any location, typed by the first location they match.

    One row per path: `path, mtime, file_type`. The patterns are plan inputs,
    so matching is one expression per row and no join. Literal pattern starts
    are a separate filter that reaches the scan. A path listed again and again
    is reduced in each task before the exchange; while grouped, the type is
    kept as the number of its location, which hash aggregation can hold.
    """
    if len(locations) != len(file_types):
        raise ValueError(f"{len(locations)} locations but {len(file_types)} file types")
    if not locations:
        return listing.select("path", "mtime", F.lit(None).cast("string").alias("file_type")).limit(0)
    patterns = location_patterns(location_root, locations)
    path = F.col("path")
    first = F.coalesce(
        *[F.when(matches_glob(path, pattern), F.lit(i)) for i, pattern in enumerate(patterns)]
    )
    reachable = reduce(or_, [path.startswith(glob_prefix(p)) for p in patterns])
    files = (
        listing.filter(reachable)
        .select("path", "mtime", first.alias("location"))
        .filter(F.col("location").isNotNull())
        .groupBy("path")
        .agg(F.max("mtime").alias("mtime"), F.min("location").alias("location"))
    )
    types = F.array(*[F.lit(file_type) for file_type in file_types])
    return files.select("path", "mtime", F.get(types, F.col("location")).alias("file_type"))


def existing_paths(tracking: DataFrame, listed: DataFrame, project: str) -> DataFrame:
    """`path, filename` of the project's tracked files that are listed."""
    tracked = tracking.filter(F.col("project") == project).select("path", "filename")
    return join_unique(tracked, listed.select("path").distinct(), ["path"], "left_semi")


def unseen_files(files: DataFrame, tracking: DataFrame, project: str) -> DataFrame:
    """Matched files the project does not track, whatever their type.

    Both sides hold one row per path and are partitioned by it, so the anti
    join adds no exchange of its own.
    """
    tracked = tracking.filter(F.col("project") == project).select("path").distinct()
    return files.join(tracked, "path", "left_anti")


def new_tracking_rows(unseen: DataFrame, project: str) -> DataFrame:
    """Queue entries for unseen files."""
    row = {
        "project": F.lit(project),
        "filename": basename(F.col("path")),
        "path": F.col("path"),
        "data": F.lit(""),
        "mtime": F.col("mtime"),
        "file_type": F.col("file_type"),
        "inqueue": F.lit(QUEUED),
    }
    return unseen.select(
        *[row[field.name].cast(field.dataType).alias(field.name) for field in TRACKING_SCHEMA]
    )
