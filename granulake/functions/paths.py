"""Path and URI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder of the per-object CSV files, and the suffix change.
CSV_FOLDER = "goes/"
GRANULE_SUFFIX = ".nc"
CSV_SUFFIX = ".csv"


def basename(path: Column) -> Column:
    """What follows the last slash; empty when the path ends with one."""
    return F.substring_index(path, "/", -1)


def join_path(left: Column, right: Column) -> Column:
    """Join with exactly one slash; an absolute right side wins."""
    return (
        F.when(right.startswith("/"), right)
        .when((left == "") | left.endswith("/"), F.concat(left, right))
        .otherwise(F.concat(left, F.lit("/"), right))
    )


def csv_object_name(name: Column) -> Column:
    """Name of the CSV object of a granule: every suffix match is replaced."""
    return F.concat(
        F.lit(CSV_FOLDER), F.replace(basename(name), F.lit(GRANULE_SUFFIX), F.lit(CSV_SUFFIX))
    )


def destination_uri(name: Column, bucket: str | None) -> Column:
    """Full URI of the CSV object, or its plain name without a bucket."""
    if bucket is None:
        return csv_object_name(name)
    return F.concat(F.lit(f"gs://{bucket}/"), csv_object_name(name))


def public_url(path: Column, store_prefix: str) -> Column:
    """Store path to public URI: every match of the prefix pattern is replaced."""
    return F.regexp_replace(path, store_prefix, "gs:/")


def object_name(path: Column, root: str) -> Column:
    """The part of a path below a root; null for a path elsewhere."""
    folder = root.rstrip("/") + "/"
    return F.when(path.startswith(folder), F.substring(path, len(folder) + 1, 1 << 30))


def day_folder(name: Column) -> Column:
    """`product/year/day` part of an object name, or `-` for a flat name.

    Used as the partition column of the header store, so a batch of messages
    only opens the days it mentions.
    """
    return F.when(
        F.size(F.split(name, "/", 4)) == 4, F.substring_index(name, "/", 3)
    ).otherwise(F.lit("-"))


def glob_pattern(pattern: str) -> str:
    """Regular expression of a shell glob in which wildcards stop at slashes."""
    out = []
    i = 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append("[^/]*")
        elif char == "?":
            out.append("[^/]")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        elif char.isalnum() or char in "/_":
            out.append(char)
        else:
            out.append("\\" + char)
        i += 1
    return "^" + "".join(out) + "$"


def glob_prefix(pattern: str) -> str:
    """The literal start of a glob, used to skip data before matching."""
    for i, char in enumerate(pattern):
        if char in "*?[":
            return pattern[:i]
    return pattern


def matches_glob(path: Column, pattern: str) -> Column:
    """Whether a path fits a glob; the literal start is tested first because
    a prefix test can be pushed into the scan."""
    return path.startswith(glob_prefix(pattern)) & path.rlike(glob_pattern(pattern))
