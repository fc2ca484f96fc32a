"""One query per operator, over inputs derived from the test tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granulake.checks import fixtures as fx
from granulake.functions.paths import (
    basename,
    csv_object_name,
    destination_uri,
    join_path,
    public_url,
)
from granulake.operators import catalog, mapping, products, tracking
from granulake.operators.headers import full_header
from granulake.operators.messages import kept, malformed, parse_messages, product_table, skipped
from granulake.operators.ordering import page
from granulake.plans.ingest import Ingest, attach_headers
from granulake.plans.jobs import process, walk
from granulake.plans.load import load_files
from granulake.schemas import OBJECT_URL_PREFIX, PRODUCT_SCHEMAS
from granulake.session import prepare, working_path
from granulake.sinks.csv_files import read_export, write_export, write_product_csv
from granulake.sinks.product_tables import OBJECTS, REJECTS, ProductTables
from granulake.sinks.tracking_table import TrackingStore
from granulake.sources.granules import (
    named_headers,
    read_header_store,
    stream_header_store,
    write_header_store,
)
from granulake.sources.mapping_config import load_mapping
from granulake.sources.notifications import stream_files
from granulake.sources.product_csv import read_product_csv
from granulake.streaming.ingest import LateHeaders, first_of_each, load_batch, start_ingest

PROJECT = "Test"
STORE_PREFIX = "/store"
LOCATION_ROOT = "/store/pub/"
BUCKET = "products"
WALKED = (["ABI-L2-MCMIPM/*/*/*/*.nc", "ABI-L1b-RadM/*/*/*/*.nc"], ["mcm", "rad"])
OVERLAPPING = (
    ["ABI-L2-MCMIPM/199?/*/*/*.nc", "*/1997/*/*/*.nc", "ABI-L1b-RadM/199[2-5]/*/*/*.nc"],
    ["mcm", "y97", "rad"],
)

Query = Callable[[SparkSession, str], DataFrame]


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_messages(fx.messages(spark, sf))


def _ingest(spark: SparkSession, sf: str) -> Ingest:
    return Ingest(fx.messages(spark, sf), fx.granule_headers(spark, sf))


def _utc(rows: DataFrame) -> DataFrame:
    """Times as UTC wall time, the form the test tables use."""
    times = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stored_files(spark, sf).select("path", "mtime")


# --- messages ---------------------------------------------------------------
def notification_source(spark: SparkSession, sf: str) -> DataFrame:
    folder, out, log = (working_path(spark, part) for part in ("in", "out", "log"))
    fx.messages(spark, sf).select("value").write.text(folder)
    (
        stream_files(spark, folder)
        .writeStream.format("parquet")
        .option("checkpointLocation", log)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return spark.read.parquet(out)


def parse_notifications(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf).filter(F.col("name").isNotNull())
    return parsed.select("msg_seq", "name", "id", "size")


def relevant_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return kept(_parsed(spark, sf)).select("msg_seq", "name", "id", "size")


def malformed_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return malformed(_parsed(spark, sf)).select("msg_seq", "value")


def skipped_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return skipped(_parsed(spark, sf)).select("msg_seq", "name")


def route_products(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf).filter(F.col("name").isNotNull())
    return parsed.select("msg_seq", "name", product_table(F.col("name")).alias("table_name"))


# --- granules ---------------------------------------------------------------
def granule_header(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fx.granule_headers(spark, sf).select("name", full_header(F.col("header")).alias("h"))
    return parsed.select(
        "name",
        F.size("h.attributes").alias("attributes"),
        F.size("h.variables").alias("variables"),
        F.col("h.attributes")["scene_id"].alias("scene_id"),
        F.col("h.variables")["band_id"]["attributes"]["units"].alias("band_units"),
        F.col("h.variables")["valid_pixel_count"]["data"].alias("valid_pixels"),
    )


def message_granule_join(spark: SparkSession, sf: str) -> DataFrame:
    messages = kept(_parsed(spark, sf))
    joined = attach_headers(messages, fx.granule_headers(spark, sf))
    return joined.select(
        "msg_seq",
        "name",
        "id",
        "size",
        "table_name",
        F.get_json_object("header", "$.attributes.dataset_name").alias("dataset_name"),
    )


def _product(table: str) -> Query:
    return lambda spark, sf: _utc(_ingest(spark, sf).product(table))


def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    headers = fx.granule_headers(spark, sf, faulty=True)
    loaded = headers.select(
        "name", F.lit("1").alias("size"), product_table(F.col("name")).alias("table_name"), "header"
    )
    # parsed once, for the rejects and the rows of all tables
    path = working_path(spark, "typed")
    products.typed_rows(loaded).write.parquet(path)
    typed = spark.read.parquet(path)
    found = products.bad_rows(typed).select(
        F.concat(F.lit(OBJECT_URL_PREFIX), "name").alias("base_url"),
        F.lit(None).cast("bigint").alias("value"),
        F.col("reason").alias("verdict"),
    )
    for table, column in fx.FAULTY_COLUMNS.items():
        good = products.good_rows(typed, table)
        found = found.unionByName(
            good.select("base_url", F.col(column).alias("value"), F.lit("loaded").alias("verdict"))
        )
    return found


# --- sinks ------------------------------------------------------------------
def granule_csv(spark: SparkSession, sf: str) -> DataFrame:
    return products.csv_objects(_ingest(spark, sf).matched, BUCKET)


def destination_uris(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("name")
    return kept(_parsed(spark, sf)).select(
        "name",
        destination_uri(name, BUCKET).alias("dest_uri"),
        destination_uri(name, None).alias("local_name"),
    )


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = working_path(spark, "csv")
    write_product_csv(_ingest(spark, sf).product("abi_l2_cmip"), folder)
    good, _ = read_product_csv(spark, folder, "abi_l2_cmip")
    return _utc(good)


def _faulty_lines(rows: DataFrame, table: str) -> DataFrame:
    """Rows as text with some bad values, and `part`: 500 events to a file, bad ones in every third."""
    k = (F.col("total_size") - 1000) / 37
    part = F.floor(k / 500)
    bad = (part % 3 == 1) & (k % 100).between(1, 12)
    column = fx.FAULTY_COLUMNS[table]
    return rows.withColumn("part", part).withColumn(
        column, F.when(bad, "bad").otherwise(F.col(column).cast("string"))
    )


def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """All four tables loaded from CSV files, of which every third holds bad lines."""
    tables = _new_tables(spark)
    batch = _ingest(spark, sf)
    loaded = None
    for table in PRODUCT_SCHEMAS:
        folder = working_path(spark, "csv")
        lines = _faulty_lines(batch.product(table), table)
        # a part is one file: it is loaded, or refused, as a whole
        write_product_csv(lines.repartition("part"), folder, partitions=["part"])
        load_files(spark, folder, table, tables, "first")
        rows = _utc(tables.read(table)).withColumn("table_name", F.lit(table))
        loaded = rows if loaded is None else loaded.unionByName(rows, allowMissingColumns=True)
    refused = tables.read(REJECTS).select(
        "table_name", F.regexp_extract("name", r"part=(\d+)", 1).cast("bigint").alias("refused_part")
    )
    return loaded.unionByName(refused, allowMissingColumns=True)


def _new_tables(spark: SparkSession) -> ProductTables:
    return ProductTables(spark, f"granules_{uuid.uuid4().hex[:12]}", working_path(spark, "tables"))


def ensure_tables(spark: SparkSession, sf: str) -> DataFrame:
    tables = _new_tables(spark)
    created = tables.ensure()
    again = tables.ensure()
    load_batch(fx.messages(spark, sf), fx.granule_headers(spark, sf), tables, "first", 0)
    report = None
    for table, schema in PRODUCT_SCHEMAS.items():
        row = tables.read(table).agg(F.count("*").alias("loaded")).select(
            F.lit(table).alias("table_name"),
            F.lit(len(schema.fields)).cast("bigint").alias("columns"),
            F.lit(table in created and table not in again).alias("created_once"),
            "loaded",
        )
        report = row if report is None else report.unionByName(row)
    return report


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder, store, log = (working_path(spark, part) for part in ("messages", "headers", "log"))
    fx.messages(spark, sf).select("value").write.text(folder)
    write_header_store(fx.granule_headers(spark, sf), store)
    tables = _new_tables(spark)
    start_ingest(
        stream_files(spark, folder), lambda s: read_header_store(s, store), tables, log
    ).awaitTermination()
    return _all_tables(tables)


def _all_tables(tables: ProductTables) -> DataFrame:
    """Rows of all products, in all their columns, and rejects."""
    loaded = tables.read(REJECTS).select(
        F.lit(REJECTS).alias("table_name"), F.concat("reason", F.lit(" "), "value").alias("item")
    )
    for table in PRODUCT_SCHEMAS:
        rows = _utc(tables.read(table)).withColumn("table_name", F.lit(table))
        loaded = loaded.unionByName(rows, allowMissingColumns=True)
    return loaded


def csv_objects(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV objects of a micro-batch that was loaded, and loaded again after a failure."""
    tables = _new_tables(spark)
    tables.ensure()
    for _ in range(2):
        load_batch(
            fx.messages(spark, sf), fx.granule_headers(spark, sf), tables, "run", 0, bucket=BUCKET
        )
    return tables.read(OBJECTS).select("table_name", "name", "dest_uri", "csv_text")


def object_view(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of one base name in several folders, the later half of them loaded first."""
    tables = _new_tables(spark)
    tables.ensure()
    messages = fx.messages(spark, sf, fx.SHARED_NAME_SQL)
    headers = fx.granule_headers(spark, sf, name=fx.SHARED_NAME_SQL)
    for number, half in enumerate((1, 0)):
        own = messages.filter(F.col("msg_seq") % 2 == half)
        load_batch(own, headers, tables, "run", number, bucket=BUCKET)
    rows = None
    for table in PRODUCT_SCHEMAS:
        count = tables.read(table).groupBy("base_url").count()
        rows = count if rows is None else rows.unionByName(count)
    current = tables.current_objects().withColumn("base_url", F.concat(F.lit(OBJECT_URL_PREFIX), "name"))
    shown = current.join(rows, "base_url").select(
        "dest_uri", "name", "table_name", "csv_text", F.col("count").alias("rows_of_name")
    )
    return shown


def late_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Messages whose headers are there, come five minutes later, or never; ten minutes are waited.

    Times are those of messages and headers, so the result does not hang on the clock.
    """
    folder, store, log = (working_path(spark, part) for part in ("messages", "headers", "log"))
    start = F.lit("2024-06-01 00:00:00").cast("timestamp")
    tables = _new_tables(spark)
    number = F.substring("name", -15, 12).cast("bigint")
    headers = fx.granule_headers(spark, sf).withColumn("day", F.substring_index("name", "/", 3))

    def store_headers(kinds: list[int], seconds: int) -> None:
        version = F.unix_micros(start) + seconds * 1_000_000
        own = headers.filter((number % 5).isin(kinds)).withColumn("version", version)
        own.write.mode("append").partitionBy("day").parquet(store)

    def run() -> None:
        start_ingest(
            stream_files(spark, folder),
            lambda session: read_header_store(session, store),
            tables,
            log,
            late=LateHeaders(
                stream_header_store(spark, store), 600, 600, F.timestamp_micros("version")
            ),
            arrived=F.coalesce("updated", start),
        ).awaitTermination()

    texts = fx.messages(spark, sf).select(
        F.regexp_replace("value", '"updated":"[^"]*"', '"updated":"2024-06-01T00:00:00Z"').alias("value")
    )
    texts.write.mode("append").text(folder)
    store_headers([0, 1], 0)
    run()
    store_headers([2, 3], 300)
    run()
    # the day after, any message shows that the wait is over
    later = '{"id": "later", "name": "other/later.nc", "updated": "2024-06-02T00:00:00Z"}'
    spark.range(1).select(F.lit(later).alias("value")).write.mode("append").text(folder)
    run()
    found = tables.read(REJECTS).select(
        F.concat(F.lit(OBJECT_URL_PREFIX), "name").alias("base_url"), F.col("reason").alias("verdict")
    )
    for table in PRODUCT_SCHEMAS:
        found = found.unionByName(tables.read(table).select("base_url", F.lit("loaded").alias("verdict")))
    return found.groupBy("base_url", "verdict").agg(F.count("*").alias("n"))


def distinct_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of which a third are delivered twice, in two micro-batches, with and without dropping repeats."""
    folder = working_path(spark, "messages")
    messages = fx.messages(spark, sf)
    messages.select("value").write.mode("append").text(folder)
    found = None
    for name, option in (("as delivered", lambda parsed: parsed), ("distinct", first_of_each)):
        out, log = working_path(spark, "out"), working_path(spark, "log")

        def run(option=option, out=out, log=log) -> None:
            parsed = parse_messages(stream_files(spark, folder)).withColumn("arrived", F.current_timestamp())
            (
                option(parsed.withWatermark("arrived", "1 day"))
                .select("id", "value")
                .writeStream.format("parquet")
                .option("checkpointLocation", log)
                .trigger(availableNow=True)
                .start(out)
                .awaitTermination()
            )

        if found is None:
            run()
            messages.filter("msg_seq % 3 = 0").select("value").write.mode("append").text(folder)
        run()
        counted = spark.read.parquet(out).groupBy("id", "value").agg(F.count("*").alias("n"))
        counted = counted.withColumn("option", F.lit(name))
        found = counted if found is None else found.unionByName(counted)
    return found


# --- catalogue --------------------------------------------------------------
def catalog_glob(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.match_locations(
        _files(spark, sf), LOCATION_ROOT, ["ABI-L2-MCMIPM/1997/*/*/*.nc"], ["mcm"]
    )
    return found.select("path", "mtime", basename(F.col("path")).alias("filename"))


def catalog_typed(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.match_locations(_files(spark, sf), LOCATION_ROOT, *OVERLAPPING)


def existing_paths(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.existing_paths(fx.tracking(spark, sf), _files(spark, sf), PROJECT)


def _unseen(spark: SparkSession, sf: str) -> DataFrame:
    files = catalog.match_locations(_files(spark, sf), LOCATION_ROOT, *WALKED)
    return catalog.unseen_files(files, fx.tracking(spark, sf), PROJECT)


def enqueue_new_files(spark: SparkSession, sf: str) -> DataFrame:
    store = _seeded_store(spark, sf)
    walk(store, _files(spark, sf), LOCATION_ROOT, *WALKED)
    return store.read()


def path_functions(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("name")
    names = fx.table(spark, sf, "events").select(F.expr(fx.EVENT_NAME_SQL).alias("name"))
    root = F.lit("/store/pub")
    return names.select(
        "name",
        basename(name).alias("base"),
        basename(F.concat(name, F.lit("/"))).alias("base_of_folder"),
        csv_object_name(F.concat(name, F.lit(".nc"))).alias("csv_of_double_suffix"),
        join_path(root, name).alias("joined"),
        join_path(F.lit(LOCATION_ROOT), name).alias("joined_at_slash"),
        join_path(root, F.concat(F.lit("/"), name)).alias("joined_absolute"),
        join_path(F.lit(""), name).alias("joined_to_nothing"),
    )


def base_url_prefix(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    return _files(spark, sf).select(
        "path",
        public_url(path, STORE_PREFIX).alias("base_url"),
        public_url(F.concat(path, path), STORE_PREFIX).alias("all_replaced"),
    )


# --- tracking ---------------------------------------------------------------
def _seeded_store(spark: SparkSession, sf: str) -> TrackingStore:
    store = TrackingStore(spark, working_path(spark, "tracking"), PROJECT)
    store.append(fx.tracking(spark, sf).filter(F.col("project") == PROJECT))
    return store


def _full_store(spark: SparkSession, sf: str) -> TrackingStore:
    """A store that holds the rows of all projects."""
    store = TrackingStore(spark, working_path(spark, "tracking"), PROJECT)
    store.append(fx.tracking(spark, sf))
    return store


def tracking_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _seeded_store(spark, sf).read()


def queue_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.queue_counts(fx.tracking(spark, sf))


def _claim(spark: SparkSession, sf: str, cap: int) -> DataFrame:
    rows = tracking.claim_rows(tracking.DEFAULT_BATCH_SIZE, cap)
    return tracking.claim(fx.tracking(spark, sf), PROJECT, rows)


def claim_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _claim(spark, sf, 50)


def claim_capped(spark: SparkSession, sf: str) -> DataFrame:
    return _claim(spark, sf, 120)


def claim_state(spark: SparkSession, sf: str) -> DataFrame:
    store = _full_store(spark, sf)
    rows = tracking.claim_rows(tracking.DEFAULT_BATCH_SIZE, 50)
    claimed = tracking.claim(store.read(), PROJECT, rows)
    store.update(tracking.changed_rows(store.files(), tracking.claimed_updates(claimed, PROJECT)))
    return store.whole()


def complete_batch(spark: SparkSession, sf: str) -> DataFrame:
    store = _full_store(spark, sf)
    headers = fx.stored_headers(spark, sf)
    process(store, headers, fx.MAPPING_CONFIG, STORE_PREFIX, max_to_process=50)
    return store.whole()


def drain_queue(spark: SparkSession, sf: str) -> DataFrame:
    store = _seeded_store(spark, sf)
    folder = working_path(spark, "headers")
    write_header_store(named_headers(fx.stored_headers(spark, sf), LOCATION_ROOT), folder)
    process(
        store, read_header_store(spark, folder), fx.MAPPING_CONFIG, STORE_PREFIX, location_root=LOCATION_ROOT
    )
    return store.read()


def _typed_headers(spark: SparkSession, sf: str) -> DataFrame:
    files = fx.stored_files(spark, sf).select("path", "file_type")
    # headers built inside the plan are estimated far too small; never build on their texts
    return files.join(fx.stored_headers(spark, sf).hint("merge"), "path")


def config_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.records(_typed_headers(spark, sf), fx.MAPPING_CONFIG, STORE_PREFIX)


def metadata_csv_line(spark: SparkSession, sf: str) -> DataFrame:
    lines = mapping.with_csv_line(_typed_headers(spark, sf), fx.MAPPING_CONFIG, STORE_PREFIX)
    return lines.select("path", "file_type", "csv_line")


def export_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The written export, read back in its order."""
    folder, file = working_path(spark, "export"), working_path(spark, "mapping")
    spark.range(1).select(F.lit(json.dumps(fx.MAPPING_CONFIG)).alias("value")).coalesce(1).write.text(file)
    write_export(fx.tracking(spark, sf), load_mapping(spark, file), PROJECT, "rad", folder)
    return read_export(spark, folder)


def export_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = tracking.exportable(fx.tracking(spark, sf), PROJECT, "rad")
    return page(rows, tracking.QUEUE_ORDER, 200, 100).select(F.col("data").alias("line"))


_QUERIES: dict[str, Query] = {
    "notification_source": notification_source,
    "parse_notifications": parse_notifications,
    "relevant_notifications": relevant_notifications,
    "malformed_notifications": malformed_notifications,
    "skipped_notifications": skipped_notifications,
    "route_products": route_products,
    "granule_header": granule_header,
    "message_granule_join": message_granule_join,
    "product_l1b": _product("abi_l1b_radiance"),
    "product_cmip": _product("abi_l2_cmip"),
    "product_mcmip": _product("abi_l2_mcmip"),
    "product_glm": _product("glm_l2_lcfa"),
    "load_rejects": load_rejects,
    "granule_csv": granule_csv,
    "destination_uri": destination_uris,
    "csv_roundtrip": csv_roundtrip,
    "csv_load": csv_load,
    "csv_objects": csv_objects,
    "object_view": object_view,
    "late_headers": late_headers,
    "distinct_messages": distinct_messages,
    "ensure_tables": ensure_tables,
    "ingest_stream": ingest_stream,
    "catalog_glob": catalog_glob,
    "catalog_typed": catalog_typed,
    "existing_paths": existing_paths,
    "unseen_files": _unseen,
    "enqueue_new_files": enqueue_new_files,
    "path_functions": path_functions,
    "base_url_prefix": base_url_prefix,
    "tracking_scan": tracking_scan,
    "queue_counts": queue_counts,
    "claim_batch": claim_batch,
    "claim_capped": claim_capped,
    "claim_state": claim_state,
    "complete_batch": complete_batch,
    "drain_queue": drain_queue,
    "config_metadata": config_metadata,
    "metadata_csv_line": metadata_csv_line,
    "export_metadata": export_metadata,
    "export_page": export_page,
}


def _prepared(query: Query) -> Query:
    return lambda spark, sf: query(prepare(spark), sf)


def queries() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in _QUERIES.items()}
