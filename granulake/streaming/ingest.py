"""The streaming job: messages to product tables and CSV objects."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granulake.operators.messages import KEPT, parse_messages
from granulake.plans.ingest import Ingest
from granulake.schemas import OBJECT_URL_PREFIX, PRODUCT_SCHEMAS
from granulake.session import prepare
from granulake.sinks.product_tables import OBJECTS, REJECTS, ProductTables

_QUERY_ID = "sql.streaming.queryId"
_WATERMARKS = "spark.sql.streaming.multipleWatermarkPolicy"
_PARTITIONS = "spark.sql.shuffle.partitions"
#: State partitions a core at most. Each keeps five stores, whose files every micro-batch writes anew however few rows they hold.
STATE_PARTITIONS_A_CORE = 2


@dataclass(frozen=True)
class LateHeaders:
    """How long a message waits for a header that is not there yet.

    `headers` is the header store as a stream, with `stored`, the time a header
    became visible. A message takes a header stored at most `keep` seconds before
    it arrived or `wait` seconds after. Both bound the state: headers are
    held for `keep + wait` seconds, messages until they have one or that time is over.
    """

    headers: DataFrame
    wait: int
    keep: int = 3600
    stored: Column | None = None

    @property
    def seconds(self) -> int:
        return self.wait + self.keep


def load_batch(
    messages: DataFrame,
    headers: DataFrame,
    tables: ProductTables,
    run_id: str,
    batch_id: int,
    url_prefix: str = OBJECT_URL_PREFIX,
    bucket: str | None = None,
) -> None:
    """Append one micro-batch to every table and to the CSV objects.

    Messages and headers are parsed and joined once, then filtered per product.
    Running the same batch again replaces its partitions, so a retry adds
    nothing.
    """
    batch = Ingest(messages, headers, url_prefix, bucket)
    folder = tables.batch_folder(run_id, batch_id)
    try:
        # micro-batches that only move a watermark have no messages, and had none in an earlier try
        if not batch.keep_in(folder):
            return
        for table in PRODUCT_SCHEMAS:
            tables.load(batch.product(table), table, run_id, batch_id)
        tables.load(batch.objects(), OBJECTS, run_id, batch_id)
        tables.load(batch.rejects(), REJECTS, run_id, batch_id)
    finally:
        batch.drop(folder)


def first_of_each(parsed: DataFrame) -> DataFrame:
    """Parsed messages, each `id` once within the watermark's delay.

    Messages without an id are known by their text.
    """
    keyed = parsed.withColumn("_key", F.coalesce("id", "value"))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def with_late_headers(parsed: DataFrame, late: LateHeaders) -> DataFrame:
    """Parsed messages with their `header_version` once it is there, or null once the wait is over.

    A stream-stream left outer join of the messages that name an object, on its
    name and a range of time; others pass at once. Of a header
    stored several times the first within the time counts. The state holds names, versions and
    times of headers; their texts are fetched from the store by name and version afterwards.
    """
    stored = F.col("_metadata.file_modification_time") if late.stored is None else late.stored
    headers = late.headers.select(
        F.col("name").alias("_name"), F.col("version").alias("header_version"), stored.alias("_stored")
    )
    headers = headers.withWatermark("_stored", f"{late.seconds} seconds")
    headers = headers.dropDuplicatesWithinWatermark(["_name"])
    fetchable = (F.col("verdict") == KEPT) & F.col("size_given")

    def seconds(count: int) -> Column:
        return F.expr(f"INTERVAL {int(count)} SECONDS")

    in_time = F.col("_stored").between(
        F.col("_arrived") - seconds(late.keep), F.col("_arrived") + seconds(late.wait)
    )
    waiting = parsed.filter(fetchable).join(
        headers, (F.col("name") == F.col("_name")) & in_time, "left_outer"
    )
    others = parsed.filter(~F.coalesce(fetchable, F.lit(False)))
    return waiting.drop("_name", "_stored").unionByName(others.withColumn("header_version", F.lit(None).cast("bigint")))


def start_ingest(
    messages: DataFrame,
    load_headers: Callable[[SparkSession], DataFrame],
    tables: ProductTables,
    checkpoint: str,
    interval: str | None = None,
    url_prefix: str = OBJECT_URL_PREFIX,
    bucket: str | None = None,
    distinct_within: int | None = None,
    late: LateHeaders | None = None,
    arrived: Column | None = None,
) -> StreamingQuery:
    """Start the job: on an interval, or over what is there now when None.

    Headers are loaded anew in each micro-batch, so files that appeared since
    the start are seen. Loads are keyed by the query id kept in the
    checkpoint: a restart goes on with it, a new checkpoint never overwrites
    what an older one loaded.

    With `distinct_within`, a message whose id came within so many seconds is
    dropped. With `late`, messages wait for headers. Both go by the time
    a message `arrived`, an expression over parsed messages that is never null;
    unless given, the time of the micro-batch, so that no message comes too late.
    """
    spark = prepare(messages.sparkSession)
    tables.ensure()
    partitions = spark.conf.get(_PARTITIONS)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Streams switch adaptive execution off; these are ordinary batch jobs.
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set(_PARTITIONS, partitions)
        run_id = spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not run_id:
            raise RuntimeError("no query id: the load could overwrite another run's rows")
        load_batch(batch, load_headers(spark), tables, run_id, batch_id, url_prefix, bucket)

    source = messages
    if distinct_within is not None or late is not None:
        held = max(distinct_within or 0, late.seconds if late else 0)
        source = parse_messages(messages.select("value"))
        # The state keeps columns as nullable as they are in its first batch. This one must not
        # look different in a batch without messages, so it is made nullable (and never null).
        text_there = F.length(F.coalesce("value", F.lit(""))) >= 0
        clock = F.current_timestamp() if arrived is None else arrived
        source = source.withColumn("_arrived", F.when(text_there, clock))
        source = source.withWatermark("_arrived", f"{held} seconds")
        if distinct_within is not None:
            source = first_of_each(source)
        if late is not None:
            source = with_late_headers(source, late)
        source = source.drop("_arrived")
    writer = source.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    before = spark.conf.get(_WATERMARKS)
    # time goes on with messages alone, also while no headers come
    spark.conf.set(_WATERMARKS, "max")
    # a new checkpoint keeps the number of its state partitions
    most = STATE_PARTITIONS_A_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(_PARTITIONS, str(min(int(partitions), most)))
    try:
        return writer.start()
    finally:
        spark.conf.set(_WATERMARKS, before)
        spark.conf.set(_PARTITIONS, partitions)
