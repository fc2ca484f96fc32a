"""Command line for spark-submit: `ingest`, `load`, `headers`, `walk`, `process`, `export`, `compact`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from granulake.operators.catalog import DEFAULT_FILE_TYPES, DEFAULT_LOCATIONS, location_patterns
from granulake.operators.tracking import DEFAULT_BATCH_SIZE, NO_CAP
from granulake.plans.jobs import export, process, walk
from granulake.plans.load import load_files
from granulake.schemas import PRODUCT_SCHEMAS
from granulake.session import prepare
from granulake.sinks.product_tables import ProductTables
from granulake.sinks.tracking_table import TrackingStore
from granulake.sources.granules import (
    granule_files,
    named_headers,
    read_header_store,
    stored_path,
    stream_header_store,
    write_header_store,
)
from granulake.sources.mapping_config import load_mapping
from granulake.sources.notifications import stream_files, stream_kafka
from granulake.streaming.ingest import LateHeaders, start_ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="granulake")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="stream messages into the product tables")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of message files")
    source.add_argument("--topic", help="Kafka topic, with --servers")
    ingest.add_argument("--servers", default="")
    ingest.add_argument("--starting", choices=["earliest", "latest"], default="earliest")
    ingest.add_argument("--one-per-file", action="store_true", help="a message may span lines")
    ingest.add_argument("--files-per-trigger", type=int, default=1000)
    ingest.add_argument("--messages-per-trigger", type=int, default=1_000_000)
    ingest.add_argument("--headers", required=True, help="header store by object name")
    ingest.add_argument("--database", default="staging")
    ingest.add_argument("--tables", required=True, help="root folder of the tables")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--interval", help="e.g. '1 minute'; without it, load what is there")
    ingest.add_argument("--bucket", help="bucket in the URIs of CSV objects")
    ingest.add_argument("--distinct-within", type=int, help="drop a message whose id came within so many seconds")
    ingest.add_argument("--wait", type=int, help="seconds a message waits for a header that is not there yet")
    ingest.add_argument("--keep", type=int, default=3600, help="seconds a header is held for messages to come, with --wait")

    loading = jobs.add_parser("load", help="load product CSV files, each as a whole or not at all")
    loading.add_argument("--input", required=True, help="folder of CSV files")
    loading.add_argument("--table", required=True, choices=list(PRODUCT_SCHEMAS))
    loading.add_argument("--database", default="staging")
    loading.add_argument("--tables", required=True, help="root folder of the tables")
    loading.add_argument("--run", required=True, help="name of this load; the same name replaces what it loaded")

    storing = jobs.add_parser("headers", help="add decoded headers to the header store")
    storing.add_argument("--input", required=True, help="Parquet with path, header")
    storing.add_argument("--location-root", required=True, help="names are paths below it")
    storing.add_argument("--store", required=True, help="header store, read by ingest and process")

    def catalogue_job(name: str, text: str) -> argparse.ArgumentParser:
        job = jobs.add_parser(name, help=text)
        job.add_argument("--tracking", required=True, help="root folder of the tracking table")
        job.add_argument("--project", default="Test")
        return job

    walking = catalogue_job("walk", "queue stored files that are not tracked yet")
    walking.add_argument("--location-root", required=True)
    walking.add_argument("--locations", nargs="+", default=DEFAULT_LOCATIONS)
    walking.add_argument("--file-types", nargs="+", default=DEFAULT_FILE_TYPES)
    walking.add_argument("--listing", help="Parquet with path, mtime instead of listing the store")

    processing = catalogue_job("process", "extract the mapped fields of queued files")
    processing.add_argument("--config", required=True)
    processing.add_argument(
        "--headers", required=True, help="header store, or without --location-root Parquet with path, header"
    )
    processing.add_argument("--location-root", help="names in the header store are paths below it")
    processing.add_argument("--store-prefix", required=True)
    processing.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE)
    processing.add_argument("--max-to-process", type=int, default=NO_CAP)
    processing.add_argument("--rejects", help="folder that collects files that gave no line")

    exporting = catalogue_job("export", "write stored lines as ordered CSV")
    exporting.add_argument("--config", required=True)
    exporting.add_argument("--file-type", default="rad")
    exporting.add_argument("--output", required=True)

    catalogue_job("compact", "put the loads of the tracking table into one")
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    prepare(spark)
    if args.job == "ingest":
        messages = (
            stream_kafka(
                spark, args.servers, args.topic, args.messages_per_trigger, args.starting
            )
            if args.topic
            else stream_files(spark, args.messages, args.files_per_trigger, args.one_per_file)
        )
        start_ingest(
            messages,
            lambda session: read_header_store(session, args.headers),
            ProductTables(spark, args.database, args.tables),
            args.checkpoint,
            args.interval,
            bucket=args.bucket,
            distinct_within=args.distinct_within,
            late=None
            if args.wait is None
            else LateHeaders(stream_header_store(spark, args.headers), args.wait, args.keep),
        ).awaitTermination()
        return
    if args.job == "load":
        tables = ProductTables(spark, args.database, args.tables)
        load_files(spark, args.input, args.table, tables, args.run)
        return
    if args.job == "headers":
        headers = spark.read.parquet(args.input)
        write_header_store(named_headers(headers, args.location_root), args.store)
        return
    store = TrackingStore(spark, args.tracking, args.project)
    if args.job == "compact":
        store.fold()
        return
    if args.job == "walk":
        patterns = location_patterns(args.location_root, args.locations)
        if args.listing:
            listing = spark.read.parquet(args.listing)
        else:
            patterns = [stored_path(spark, pattern) for pattern in patterns]
            listing = granule_files(spark, patterns)
        walk(store, listing, args.location_root, patterns, args.file_types)
        return
    config = load_mapping(spark, args.config)
    if args.job == "process":
        by_path = args.location_root is None
        headers = (spark.read.parquet if by_path else lambda f: read_header_store(spark, f))(args.headers)
        print(
            process(
                store,
                headers,
                config,
                args.store_prefix,
                args.batch_size,
                args.max_to_process,
                args.rejects,
                args.location_root,
            )
        )
    else:
        export(store, config, args.file_type, args.output)


if __name__ == "__main__":
    run(SparkSession.builder.appName("granulake").getOrCreate())
