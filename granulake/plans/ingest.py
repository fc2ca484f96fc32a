"""Notifications + headers to product rows and rejects."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.functions.paths import day_folder
from granulake.operators.joins import join_unique
from granulake.operators.messages import kept, malformed, parse_messages, product_table
from granulake.operators.products import bad_rows, csv_objects, good_rows, typed_rows
from granulake.schemas import OBJECT_SCHEMA, OBJECT_URL_PREFIX, PRODUCT_SCHEMAS, REJECT_SCHEMA

NO_VERSION = -(1 << 63)
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def latest_named(headers: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key among `wanted`, the latest header in a store, one row per key.

    It is found among the objects that are wanted, so the rest of the store is not shuffled.
    """
    named = headers.join(wanted.select(*keys).distinct(), keys, "left_semi")
    return named.groupBy(*keys).agg(newest_header())


def newest_header() -> Column:
    """Of a group's headers the one of the latest version, of several of it the greatest text."""
    return F.max_by("header", F.struct("version", "header")).alias("header")


def asked_version(headers: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key and `header_version` among `wanted`, that version in a store, or the latest if it is not there."""
    asked = wanted.select(*keys, "header_version").distinct()
    own = (F.col("version") == F.col("header_version")) & F.col("header").isNotNull()
    best = F.max_by("header", F.struct(F.coalesce(own, F.lit(False)), "version", "header")).alias("header")
    return headers.join(asked, keys).groupBy(*keys, "header_version").agg(best)


def attach_headers(messages: DataFrame, headers: DataFrame) -> DataFrame:
    """Routed messages with the header of the object they name; others are dropped.

    Both sides are shuffled by name straight from their scans, where adaptive
    execution can split an object announced over and over. Header texts compress so
    well, or are built by the plan, that their size is estimated far too small: unless
    they come from a header store, a hint keeps them from being collected for a broadcast. The table is part
    of the key: headers of unwanted objects are dropped before the shuffle, and
    so are all but one table's when only that table is asked for.

    Of headers with a `version` only the latest of each name counts. There the names of a
    small set of messages are broadcast and, with a header store laid out by day,
    prune it to the days named. Messages with a `header_version` that is not null get that version
    if it is there.
    """
    keys = ["table_name", "name"]
    routed = headers.withColumn("table_name", product_table(F.col("name")))
    if "day" in headers.columns:
        keys.append("day")
        messages = messages.withColumn("day", day_folder(F.col("name")))
    if "version" not in headers.columns:
        return messages.join(routed.hint("merge"), keys).drop("day", "header_version")
    if "header_version" in messages.columns:
        # a key is never null
        messages = messages.withColumn("header_version", F.coalesce("header_version", F.lit(NO_VERSION)))
        chosen = asked_version(routed, messages, keys)
        return join_unique(messages, chosen, [*keys, "header_version"], "inner").drop("day", "header_version")
    return join_unique(messages, latest_named(routed, messages, keys), keys, "inner").drop("day")


def _written(rows: DataFrame, folder: str, by: str) -> DataFrame:
    """The rows, written and read back, each value of `by` in a folder of its own."""
    spark = rows.sparkSession
    # a file is kept open for each value, so wide rows are not sorted by it first
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, str(len(PRODUCT_SCHEMAS)))
    try:
        rows.write.mode("overwrite").partitionBy(by).parquet(folder)
    finally:
        spark.conf.set(_OPEN_FILES, before)
    return spark.read.schema(rows.schema).parquet(folder).select(*rows.columns)


class Ingest:
    """The stages of one batch of messages as DataFrames.

    `parsed` (message fields and verdict) and `typed` (wanted messages with
    their header in column types) feed several outputs; the streaming job
    keeps both for the length of a micro-batch (`keep_in`), so messages and headers are
    each parsed once and an output reads its own table and columns only.

    Messages are texts, or parsed already; these may carry the `header_version` they
    waited for. Those without one get the latest of the stored headers.
    """

    def __init__(
        self,
        messages: DataFrame,
        headers: DataFrame,
        url_prefix: str = OBJECT_URL_PREFIX,
        bucket: str | None = None,
    ):
        self.url_prefix = url_prefix
        self.bucket = bucket
        self.headers = headers
        parsed = "verdict" in messages.columns
        self._derive(messages if parsed else parse_messages(messages.select("value")))

    def _derive(self, parsed: DataFrame) -> None:
        wanted = kept(parsed)
        self.parsed = parsed
        self.sizeless = wanted.filter(~F.col("size_given"))
        self.fetchable = wanted.filter(F.col("size_given"))
        self.matched = attach_headers(self.fetchable, self.headers)
        self.typed = typed_rows(self.matched)

    def persist(self) -> None:
        self._derive(self.parsed.persist())
        self.typed = self.typed.persist()

    def unpersist(self) -> None:
        self.typed.unpersist()
        self.parsed.unpersist()

    def keep_in(self, folder: str) -> bool:
        """Keep `parsed` on disk and, if there are messages, write `typed` to a folder, until `drop`.

        Neither takes memory, whatever the size of the batch. Returns whether there are messages.
        """
        # a cache tells the size of its rows, files only what is left of it by compression
        self._derive(self.parsed.persist(StorageLevel.DISK_ONLY))
        # counted in whole: a stateful stream must run all its tasks
        if not self.parsed.count():
            return False
        self.typed = _written(self.typed, folder, by="table_name")
        return True

    def drop(self, folder: str) -> None:
        self.parsed.unpersist()
        path = self.parsed.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.parsed.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

    def product(self, table: str) -> DataFrame:
        """Rows for one product table."""
        return good_rows(self.typed, table, self.url_prefix)

    def objects(self) -> DataFrame:
        """The CSV object of every granule whose header has the fields of its table."""
        keep = ("table_name", "name", "id", "updated")
        found = csv_objects(self.typed, self.bucket, self.url_prefix, keep)
        return found.select(*OBJECT_SCHEMA.names)

    def rejects(self) -> DataFrame:
        """Messages that were wanted but gave no product row, and why."""

        def because(rows: DataFrame, reason: str | None = None) -> DataFrame:
            known = {} if reason is None else {"reason": F.lit(reason)}
            return rows.select(
                *[
                    known.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                    for f in REJECT_SCHEMA
                ]
            )

        found = self.typed.select("name").distinct()
        # the names' size is estimated far too small beside the wide rows they are read from
        missing = join_unique(self.fetchable, found.hint("merge"), ["name"], "left_anti")
        return (
            because(malformed(self.parsed), "malformed")
            .unionByName(because(self.sizeless, "missing_size"))
            .unionByName(because(missing, "object_not_found"))
            .unionByName(because(bad_rows(self.typed)))
        )
