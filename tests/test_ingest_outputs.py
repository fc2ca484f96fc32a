"""CSV objects, late headers, repeated messages and file-wise loads."""

import csv
import io
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from granulake.__main__ import run
from granulake.operators.messages import parse_messages
from granulake.plans.ingest import attach_headers
from granulake.schemas import PRODUCT_SCHEMAS
from granulake.sinks.csv_files import read_export, write_export, write_product_csv
from granulake.sinks.product_tables import OBJECTS, REJECTS, ProductTables
from granulake.sources.granules import STORE_SCHEMA, read_header_store, stream_header_store, write_header_store
from granulake.sources.notifications import batch_files, stream_files
from granulake.sources.product_csv import read_product_files
from granulake.streaming.ingest import LateHeaders, load_batch, start_ingest, with_late_headers
from test_products import GLM, header, load
from test_streaming import FOLDERS, message, name_of

SAMPLE = """{
  "kind": "storage#object",
  "id": "bucket/%s/1",
  "name": "%s",
  "updated": "2020-07-06T06:18:45.966Z",
  "size": "20587829"
}
"""


@pytest.fixture
def tables(spark, tmp_path):
    return ProductTables(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "tables"))


def stored(spark, tmp_path, *rows):
    write_header_store(spark.createDataFrame(list(rows), "name string, header string"), f"{tmp_path}/headers")
    return read_header_store(spark, f"{tmp_path}/headers")


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_a_batch_writes_one_csv_object_per_granule_and_a_retry_replaces_it(spark, tmp_path, tables):
    headers = stored(spark, tmp_path, *[(name_of(t, 1), json.dumps(header(t))) for t in FOLDERS])
    batch = texts(spark, *[message(name_of(t, 1), updated="2020-01-01T00:00:00Z") for t in FOLDERS], "broken")
    tables.ensure()
    for _ in range(2):
        load_batch(batch, headers, tables, "run", 0, bucket="b")
    rows = {r.table_name: r for r in tables.read(OBJECTS).collect()}
    assert set(rows) == set(FOLDERS) and tables.read(OBJECTS).count() == 4
    for table, row in rows.items():
        names, values = list(csv.reader(io.StringIO(row.csv_text, newline="")))
        assert names == PRODUCT_SCHEMAS[table].names and len(values) == len(names)
        assert row.dest_uri == "gs://b/goes/g1.csv" and str(row.updated) == "2020-01-01 00:00:00"


def test_bad_values_have_an_object_and_lacking_fields_have_none(spark, tmp_path, tables):
    bad, lacking = header(GLM, event_count="bad"), header(GLM)
    del lacking["attributes"]["dataset_name"]
    headers = stored(spark, tmp_path, (name_of(GLM, 1), json.dumps(bad)), (name_of(GLM, 2), json.dumps(lacking)))
    tables.ensure()
    load_batch(texts(spark, message(name_of(GLM, 1)), message(name_of(GLM, 2))), headers, tables, "run", 0)
    assert [r.name for r in tables.read(OBJECTS).collect()] == [name_of(GLM, 1)]
    assert sorted(r.reason for r in tables.read(REJECTS).collect()) == ["bad_value", "missing_field"]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_of_equal_base_names_the_last_updated_object_counts(spark, tmp_path, tables, order):
    names = [f"GLM-L2-LCFA/2020/{day}/06/same.nc" for day in (188, 189)]
    headers = stored(spark, tmp_path, *[(n, json.dumps(header(GLM, dataset_name=n[17:20]))) for n in names])
    sent = [
        message(names[0], id="0", updated="2020-07-06T10:00:00.5Z"),
        message(names[1], id="1", updated="2020-07-06T09:00:00Z"),
        message(names[1], id="2", updated="no time"),
    ]
    tables.ensure()
    for number in order:
        load_batch(texts(spark, sent[number]), headers, tables, "run", number)
    assert tables.read(GLM).count() == 3 and tables.read(OBJECTS).count() == 3
    (row,) = tables.current_objects().collect()
    assert row.dest_uri == "goes/same.csv" and row.name == names[0] and row.id == "0"


def test_late_header_gives_one_row_and_no_header_one_reject(spark, tmp_path, tables):
    """By the clock of messages and stored headers; a header stored again counts once."""
    folder, store = tmp_path / "messages", str(tmp_path / "headers")
    folder.mkdir()
    start = "2024-06-01T00:00:00Z"

    def send(name, *values):
        (folder / name).write_text("\n".join(values) + "\n")

    def store_header(number, seconds):
        day = F.substring_index("name", "/", 3).alias("day")
        version = F.unix_micros(F.lit(start).cast("timestamp")) + seconds * 1_000_000
        rows = spark.createDataFrame([(name_of(GLM, number), json.dumps(header(GLM)))], "name string, header string")
        rows.select("name", "header", version.alias("version"), day).write.mode("append").partitionBy("day").parquet(store)

    def go():
        late = LateHeaders(stream_header_store(spark, store), 600, 600, F.timestamp_micros("version"))
        arrived = F.coalesce("updated", F.lit(start).cast("timestamp"))
        start_ingest(
            stream_files(spark, str(folder)), lambda s: read_header_store(s, store), tables, str(tmp_path / "log"), late=late, arrived=arrived
        ).awaitTermination()

    def seen():
        rows = sorted(r.base_url.rsplit("/", 1)[1] for r in tables.read(GLM).collect())
        return rows, sorted((r.reason, r.name and r.name.rsplit("/", 1)[1]) for r in tables.read(REJECTS).collect())

    send("a.txt", *[message(name_of(GLM, n), updated=start) for n in (1, 2, 3)], "broken")
    store_header(1, -30)
    go()
    assert seen() == (["g1.nc"], [("malformed", None)])
    store_header(2, 300)
    store_header(2, 310)
    go()
    assert seen() == (["g1.nc", "g2.nc"], [("malformed", None)])
    send("b.txt", message("other/x.nc", updated="2024-06-02T00:00:00Z"))
    go()
    assert seen() == (["g1.nc", "g2.nc"], [("malformed", None), ("object_not_found", "g3.nc")])


def test_waiting_holds_no_header_texts(spark, tmp_path):
    """The state's rows are the two sides of the join."""
    store = str(tmp_path / "headers")
    write_header_store(spark.createDataFrame([("a", "{}")], "name string, header string"), store)
    (tmp_path / "messages").mkdir()
    parsed = parse_messages(stream_files(spark, str(tmp_path / "messages")).select("value"))
    parsed = parsed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "1 hour")
    waiting = with_late_headers(parsed, LateHeaders(stream_header_store(spark, store), 600))
    plan = waiting._jdf.queryExecution().analyzed().toString()
    assert "header" not in waiting.columns and "header_version" in waiting.columns
    assert not [line for line in plan.splitlines() if "Project" in line and re.search(r"\bheader#", line)]


def test_a_message_gets_the_version_it_waited_for(spark):
    name, lost = name_of(GLM, 1), name_of(GLM, 2)
    day = name.rpartition("/06/")[0]
    rows = [(n, f"{n} {v}", v, day) for n in (name, lost) for v in (1, 2, 3)]
    headers = spark.createDataFrame(rows, STORE_SCHEMA)
    sent = [(GLM, name, 2), (GLM, name, 1), (GLM, name, 1), (GLM, lost, 7), (GLM, lost, None)]
    messages = spark.createDataFrame(sent, "table_name string, name string, header_version bigint")
    found = attach_headers(messages.withColumn("own", F.col("header_version")), headers)
    assert found.columns == ["table_name", "name", "own", "header"]
    got = sorted((r.name, r.own or 0, r.header) for r in found.collect())
    assert got == [(name, 1, f"{name} 1"), (name, 1, f"{name} 1"), (name, 2, f"{name} 2"), (lost, 0, f"{lost} 3"), (lost, 7, f"{lost} 3")]


@pytest.mark.parametrize("within, expected", [(3600, ["g1.nc"]), (None, ["g1.nc", "g1.nc"])])
def test_a_message_delivered_again(spark, tmp_path, tables, within, expected):
    headers = stored(spark, tmp_path, (name_of(GLM, 1), json.dumps(header(GLM))))
    folder = tmp_path / "messages"
    folder.mkdir()
    for number in range(2):
        (folder / f"{number}.txt").write_text(message(name_of(GLM, 1)) + "\n")
        start_ingest(
            stream_files(spark, str(folder)), lambda s: headers, tables, str(tmp_path / "log"), distinct_within=within
        ).awaitTermination()
    assert [r.base_url.rsplit("/", 1)[1] for r in tables.read(GLM).collect()] == expected


def test_messages_of_several_lines_go_through_the_command_line(spark, tmp_path):
    """With a wait for headers by the real clock, and a bucket."""
    names = [name_of(t, 1) for t in FOLDERS]
    stored(spark, tmp_path, *[(n, json.dumps(header(t))) for t, n in zip(FOLDERS, names, strict=True)])
    (tmp_path / "messages").mkdir()
    for number, name in enumerate(names):
        (tmp_path / "messages" / f"{number}.json").write_text(SAMPLE % (name, name))
    database = f"cli_{uuid.uuid4().hex[:8]}"
    options = {"messages": "messages", "headers": "headers", "tables": "tables", "checkpoint": "log"}
    places = [part for name, folder in options.items() for part in (f"--{name}", f"{tmp_path}/{folder}")]
    run(spark, ["ingest", *places, "--database", database, "--one-per-file", "--bucket", "b", "--wait", "60", "--distinct-within", "60"])
    for table in FOLDERS:
        assert [r.total_size for r in spark.table(f"`{database}`.{table}").collect()] == [20587829]
    assert spark.table(f"`{database}`.{OBJECTS}").select("dest_uri").distinct().collect() == [("gs://b/goes/g1.csv",)]
    assert batch_files(spark, f"{tmp_path}/messages", one_per_file=True).count() == len(names)


@pytest.mark.parametrize("table", list(FOLDERS))
def test_a_file_loads_as_a_whole_or_not_at_all(spark, tmp_path, table):
    rows, _ = load(spark, header(table), table)
    good = spark.createDataFrame(rows, PRODUCT_SCHEMAS[table])
    folder = f"{tmp_path}/csv"
    write_product_csv(good.coalesce(1), folder)
    lines = (next((tmp_path / "csv").glob("part-*")).read_text()).splitlines()
    (tmp_path / "csv" / "bad.csv").write_text("\n".join([*lines, lines[1].rsplit(",", 2)[0] + ",much,url"]) + "\n")
    kept, refused = read_product_files(spark, folder, table)
    assert kept.collect() == rows and kept.schema == PRODUCT_SCHEMAS[table]
    assert [r.name.rsplit("/", 1)[1] for r in refused.collect()] == ["bad.csv"] and "much" in refused.first().value
    database = f"cli_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        run(spark, ["load", "--input", folder, "--table", table, "--database", database, "--tables", f"{tmp_path}/tables", "--run", "one"])
    tables = ProductTables(spark, database, f"{tmp_path}/tables")
    assert tables.read(table).collect() == rows
    assert [(r.table_name, r.reason) for r in tables.read(REJECTS).collect()] == [(table, "bad_file")]


def test_an_export_is_read_back_in_its_order(spark, tmp_path):
    rows = [("Test", f"f{i}", f"/p{i:03}", f"line {i}", None, "rad", 0) for i in range(500)]
    tracking = spark.createDataFrame(rows, "project string, filename string, path string, data string, mtime timestamp_ntz, file_type string, inqueue int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_export(tracking, {"rad": {"metadata": {"scene_id": "scene"}}}, "Test", "rad", str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    read = {r.position: r.line for r in read_export(spark, str(tmp_path / "out")).collect()}
    assert read == {0: "base_url,scene", **{i + 1: f"line {i}" for i in range(500)}}


def test_refused_files_are_looked_for_once(spark, tmp_path):
    """What follows reads the found files, not all lines again."""
    rows, _ = load(spark, header(GLM), GLM)
    write_product_csv(spark.createDataFrame(rows, PRODUCT_SCHEMAS[GLM]), f"{tmp_path}/csv")
    kept, refused = read_product_files(spark, f"{tmp_path}/csv", GLM)
    plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in (kept, refused)]
    assert [plan.count("FileScan csv") for plan in plans] == [1, 0]
    assert kept.collect() == rows and refused.isEmpty()


def test_a_batch_is_kept_in_files_of_each_table_and_leaves_none(spark, tmp_path, tables, monkeypatch):
    headers = stored(spark, tmp_path, *[(name_of(t, 1), json.dumps(header(t))) for t in FOLDERS])
    plans, load = {}, ProductTables.load

    def noted(self, rows, table, *rest):
        plans[table] = rows._jdf.queryExecution().executedPlan().toString()
        load(self, rows, table, *rest)

    monkeypatch.setattr(ProductTables, "load", noted)
    tables.ensure()
    load_batch(texts(spark, *[message(name_of(t, 1)) for t in FOLDERS], "broken"), headers, tables, "run", 0)
    assert set(plans) == set(tables.schemas)
    assert "BroadcastHashJoin" not in plans[REJECTS]
    for table in FOLDERS:
        # an output reads its own table's rows only, from files
        assert "InMemoryTableScan" not in plans[table]
        assert "(table_name" in plans[table] and "PartitionFilters: [isnotnull" in plans[table]
        assert tables.read(table).count() == 1
    assert tables.read(REJECTS).count() == 1 and tables.read(OBJECTS).count() == 4
    assert not list((tmp_path / "tables").glob("_batches/*"))
