import csv
import io
import json
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granulake.functions.csv_text import joined_line, plain_number
from granulake.operators.products import bad_rows, csv_objects, good_rows, typed_rows
from granulake.schemas import PRODUCT_COLUMNS, PRODUCT_SCHEMAS, column_source
from granulake.sinks.csv_files import write_product_csv
from granulake.sources.product_csv import read_product_csv

GLM = "glm_l2_lcfa"
NAME = "GLM-L2-LCFA/2020/188/06/g.nc"


def header(table=GLM, **changes):
    """A header with a plain value for every column, then `changes` by column."""
    tree = {"attributes": {}, "variables": {}}
    for column, kind in PRODUCT_COLUMNS[table]:
        source = column_source(column)
        value = {"STRING": "s", "TIMESTAMP": "2020-07-06T06:18:45.9Z", "FLOAT": 1.5, "INTEGER": 3}[kind]
        value = changes.get(column, value)
        if source.kind == "attribute":
            tree["attributes"][source.attribute] = value
        elif source.kind == "variable":
            tree["variables"][source.variable] = {"data": value}
        elif source.kind == "variable_attribute":
            own = tree["variables"].setdefault(source.variable, {"attributes": {}})
            own["attributes"][source.attribute] = value
    return tree


def load(spark, tree, table=GLM, size="12"):
    text = json.dumps(tree) if isinstance(tree, dict) else tree
    df = spark.createDataFrame(
        [(NAME, size, text, table)],
        "name string, size string, header string, table_name string",
    )
    typed = typed_rows(df)
    return good_rows(typed, table).collect(), bad_rows(typed).collect()


def test_schema_shapes():
    shapes = {}
    for table, schema in PRODUCT_SCHEMAS.items():
        kinds = [f.dataType.typeName() for f in schema.fields]
        shapes[table] = [len(kinds)] + [kinds.count(k) for k in ("string", "timestamp", "double", "long")]
        assert all(f.nullable for f in schema.fields)
    assert shapes == {
        "abi_l1b_radiance": [25, 7, 3, 10, 5],
        "abi_l2_cmip": [21, 7, 3, 7, 4],
        "abi_l2_mcmip": [97, 6, 3, 71, 17],
        "glm_l2_lcfa": [15, 4, 3, 5, 3],
    }


@pytest.mark.parametrize("table", PRODUCT_SCHEMAS)
def test_every_column_is_filled(spark, table):
    good, bad = load(spark, header(table), table)
    assert not bad and None not in list(good[0]) and good[0].total_size == 12
    assert good[0].base_url.endswith("/" + NAME)


@pytest.mark.parametrize(
    "text", ["2020-07-06T06:18:45.9Z", "2020-07-06T06:18:45.900Z", "2020-07-06T08:18:45.9+02:00"]
)
def test_times(spark, text):
    good, _ = load(spark, header(date_created=text))
    assert good[0].date_created == datetime(2020, 7, 6, 6, 18, 45, 900000)


@pytest.mark.parametrize(
    ("column", "given", "loaded"),
    [
        ("flash_count", "2.5", 2.5),
        ("event_count", "7", 7),
        ("event_count", None, None),
        ("event_count", "", None),
        ("date_created", "", None),
        ("dataset_name", "", None),
        ("flash_count", 1e-5, 1e-5),
        ("flash_count", 3, 3.0),
    ],
)
def test_values_that_load(spark, column, given, loaded):
    good, bad = load(spark, header(**{column: given}))
    assert not bad and good[0][column] == loaded


@pytest.mark.parametrize(
    ("column", "given"),
    [("event_count", "bad"), ("event_count", 1.5), ("flash_count", "x"), ("date_created", "noon")],
)
def test_values_that_do_not_load(spark, column, given):
    good, bad = load(spark, header(**{column: given}))
    assert not good and bad[0].name == NAME and bad[0].reason == "bad_value"


@pytest.mark.parametrize("table", PRODUCT_SCHEMAS)
def test_headers_that_lack_a_field_are_rejected(spark, table):
    trees = [{}, {"attributes": {}, "variables": {}}]
    for section, name in [("attributes", "platform_ID"), ("variables", None)]:
        tree = header(table)
        del tree[section][name or sorted(tree[section])[0]]
        trees.append(tree)
    for variable in header(table)["variables"]:
        tree = header(table)
        if tree["variables"][variable].get("attributes"):
            tree["variables"][variable]["attributes"].popitem()
            trees.append(tree)
    for tree in trees:
        good, bad = load(spark, tree, table)
        assert not good and [r.reason for r in bad] == ["missing_field"]


def test_fields_without_a_value_are_null(spark):
    tree = header(platform_ID=None)
    tree["variables"]["event_count"] = {}
    good, bad = load(spark, tree)
    assert not bad and good[0].event_count is None and good[0].platform_ID is None


def test_unreadable_header_and_sizes(spark):
    assert load(spark, "not json")[0] == []
    assert load(spark, None)[0] == [] and len(load(spark, None)[1]) == 1
    assert load(spark, header(), size="big")[0] == []
    assert load(spark, header(), size=None)[0][0].total_size is None


def test_columns_with_capitals_read_their_own_variable(spark):
    tree = header("abi_l2_mcmip", std_dev_brightness_temperature_c16=9.25)
    assert "std_dev_brightness_temperature_C16" in tree["variables"]
    good, _ = load(spark, tree, "abi_l2_mcmip")
    assert good[0].std_dev_brightness_temperature_c16 == 9.25


@pytest.mark.parametrize("table", PRODUCT_SCHEMAS)
def test_csv_object_reads_back_as_csv(spark, table):
    tree = header(table, dataset_name='a "quoted", name', percent_uncorrectable_l0_errors=2e-5)
    df = spark.createDataFrame(
        [(NAME, "12", json.dumps(tree), table)],
        "name string, size string, header string, table_name string",
    )
    row = csv_objects(df, "b").collect()[0]
    names, values = list(csv.reader(io.StringIO(row.csv_text, newline="")))
    assert row.dest_uri == "gs://b/goes/g.csv"
    assert names == PRODUCT_SCHEMAS[table].names and len(values) == len(names)
    assert values[0] == 'a "quoted", name' and values[-2] == "12"
    if "percent_uncorrectable_l0_errors" in names:
        assert values[names.index("percent_uncorrectable_l0_errors")] == "2e-05"


FIELDS = ["plain", "a,b", 'say "hi"', "two\nlines", "cr\r", " lead", "trail ", "", None, "'", "é", "a;b\t"]


def test_csv_line_like_the_csv_module(spark):
    rows = [FIELDS[i:] + FIELDS[:i] for i in range(len(FIELDS))]
    df = spark.createDataFrame([(r,) for r in rows], "v array<string>")
    mine = [r[0] for r in df.select(joined_line(F.col("v"))).collect()]
    expected = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="\r\n").writerow(row)
        expected.append(out.getvalue()[:-2])
    assert mine == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=200, max_size=200))
def test_number_text_reads_as_the_same_number(spark, numbers):
    df = spark.createDataFrame([(float(n),) for n in numbers], "n double")
    for row in df.select("n", plain_number(F.col("n").cast("string")).alias("t")).collect():
        assert float(row.t) == row.n
        plain = row.n == 0 or 1e-4 <= abs(row.n) < 1e16
        assert ("e" not in row.t) == plain and "E" not in row.t


def test_number_text_like_repr(spark):
    numbers = [1e-3, 5e-4, 1e-4, 1e-5, 1.5e-300, 1e7, 13500000.0, 1e15, 1e16, -2.5e20, 0.0, -0.125]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    rows = df.select("n", plain_number(F.col("n").cast("string")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.n) for r in rows]


def test_csv_dataset_round_trip_and_bad_lines(spark, tmp_path):
    good, _ = load(spark, header(dataset_name=' "x", y'))
    folder = str(tmp_path / "csv")
    write_product_csv(spark.createDataFrame(good, PRODUCT_SCHEMAS[GLM]), folder)
    (tmp_path / "csv" / "more.csv").write_text("any,header\n" + "s," * 3 + "not a time" + "," * 11 + "\n")
    read, bad = read_product_csv(spark, folder, GLM)
    assert read.collect() == good and read.schema == PRODUCT_SCHEMAS[GLM]
    assert bad.count() == len(bad.collect()) == 1
    assert read.select("dataset_name").count() == 1
