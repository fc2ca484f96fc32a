"""Inputs derived from the test tables, in the shape the jobs read.

Everything grows with the tables: one notification and one granule header per
`events` row, one stored file and one header per `orders` row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granulake.schemas import PRODUCT_COLUMNS, column_source

EVENT_NAME_SQL = """
concat(CASE event_id % 6 WHEN 0 THEN 'ABI-L1b-RadF' WHEN 1 THEN 'ABI-L2-CMIPM'
                         WHEN 2 THEN 'ABI-L2-MCMIPM' WHEN 3 THEN 'GLM-L2-LCFA'
                         WHEN 4 THEN 'ABI-L2-DSIM' ELSE 'ABI-L1b-RadC' END,
       '/2020/188/', lpad(CAST(user_id % 24 AS VARCHAR(20)), 2, '0'),
       '/OR_', event_type, '_', lpad(CAST(event_id AS VARCHAR(20)), 12, '0'), '.nc')
"""

# Base names that up to four objects in different folders share.
SHARED_NAME_SQL = EVENT_NAME_SQL.replace("event_type, '_'", "'shared_'").replace(
    "CAST(event_id AS", "CAST(event_id - event_id % 4 AS"
)


def _two_digits(part: str) -> str:
    return f"lpad(CAST({part}(ts) AS VARCHAR(2)), 2, '0')"


STAMP_SQL = (
    f"concat(CAST(year(ts) AS VARCHAR(4)), '-', {_two_digits('month')}, '-', {_two_digits('day')}, 'T', "
    f"{_two_digits('hour')}, ':', {_two_digits('minute')}, ':', {_two_digits('second')}, 'Z')"
)


def messages_sql(name: str = EVENT_NAME_SQL) -> str:
    return f"""
SELECT msg_seq, updated, name, size,
  concat('{{"kind":"storage#object","id":"b/', name, '/', CAST(msg_seq AS VARCHAR(20)),
         '","name":"', name, '","size":"', size, '","updated":"', stamp, '"}}',
         CASE WHEN msg_seq % 50 = 0 THEN '}}' ELSE '' END) AS value
FROM (SELECT event_id AS msg_seq, ts AS updated, {name} AS name,
        CAST(event_id * 37 + 1000 AS VARCHAR(20)) AS size, {STAMP_SQL} AS stamp
      FROM events) e
"""


MESSAGES_SQL = messages_sql()

STORED_FILES_SQL = """
SELECT concat('o', lpad(CAST(o_orderkey AS VARCHAR(20)), 12, '0'), '.nc') AS filename,
  concat('/store/pub/', CASE o_orderkey % 2 WHEN 0 THEN 'ABI-L2-MCMIPM' ELSE 'ABI-L1b-RadM' END,
         '/', CAST(year(o_orderdate) AS VARCHAR(4)), '/001/00/o',
         lpad(CAST(o_orderkey AS VARCHAR(20)), 12, '0'), '.nc') AS path,
  o_orderdate AS mtime, o_orderkey AS k,
  CASE o_orderkey % 2 WHEN 0 THEN 'mcm' ELSE 'rad' END AS file_type
FROM orders
"""

TRACKING_SQL = f"""
SELECT CASE WHEN k % 11 = 0 THEN 'Other' ELSE 'Test' END AS project, filename, path,
  CASE WHEN k % 4 = 1 THEN concat('v', CAST(k AS VARCHAR(20))) ELSE '' END AS data,
  mtime, file_type,
  CASE WHEN k % 4 = 1 THEN 0 WHEN k % 4 = 2 THEN 2 ELSE 1 END AS inqueue
FROM ({STORED_FILES_SQL}) c WHERE k % 3 <> 0
"""

# Table each event's object belongs to, by the same rule as its folder above.
EVENT_TABLES = {
    0: "abi_l1b_radiance",
    1: "abi_l2_cmip",
    2: "abi_l2_mcmip",
    3: "glm_l2_lcfa",
    5: "abi_l1b_radiance",
}

# One count or number per table whose values are made faulty, and in which rows.
FAULTY_COLUMNS = {
    "abi_l1b_radiance": "valid_pixel_count",
    "abi_l2_cmip": "valid_pixel_count",
    "abi_l2_mcmip": "outlier_pixel_count_c02",
    "glm_l2_lcfa": "event_count",
}
FAULTS = {
    "bad": "event_id % 97 = 0",
    "quoted": "event_id % 79 = 0",
    "masked": "event_id % 89 = 0",
    "absent": "event_id % 83 = 0",
}
NO_NAME = {"dataset_name": {"absent": "event_id % 73 = 0"}}

MAPPING_CONFIG = {
    "rad": {
        "metadata": {"scene_id": "scene", "dataset_name": "dataset"},
        "data": {
            "valid_pixel_count": "valid_px",
            "geospatial_lat_lon_extent": {
                "geospatial_westbound_longitude": "west",
                "no_such_attr": "absent_col",
            },
        },
    },
    "mcm": {"metadata": {"dataset_name": "dataset"}},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, spread over the cores when its file is a single split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _sql(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    escaped = text.replace("{", "{{").replace("}", "}}")
    query = escaped.replace(f"FROM {name}", "FROM {source}")
    return spark.sql(query, source=table(spark, sf_dir, name))


def messages(spark: SparkSession, sf_dir: str, name: str = EVENT_NAME_SQL) -> DataFrame:
    """`msg_seq, updated, value`; every 50th message is malformed."""
    return _sql(spark, sf_dir, "events", messages_sql(name)).select("msg_seq", "updated", "value")


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`filename, path, mtime, k, file_type`."""
    return _sql(spark, sf_dir, "orders", STORED_FILES_SQL)


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked files of two projects in all three queue states."""
    return _sql(spark, sf_dir, "orders", TRACKING_SQL)


def header_sql(
    product: str,
    key: str,
    time: str,
    faults: dict[str, dict[str, str]] | None = None,
) -> str:
    """Header text of one product as SQL.

    `faults` names, by column, the rows in which its number is `bad` text, is
    `quoted`, is `masked` (a field without a value) or its field is `absent`.
    """

    def struct(members: dict[str, str]) -> str:
        return f"named_struct({', '.join(f"'{name}', {sql}" for name, sql in members.items())})"

    attributes: dict[str, str] = {}
    variable_attributes: dict[str, dict[str, str]] = {}
    variables: dict[str, str] = {}
    for position, (column, kind) in enumerate(PRODUCT_COLUMNS[product]):
        source = column_source(column)
        value = {
            "INTEGER": f"({key} * 31 + {position * 7}) % 100000",
            "FLOAT": f"(({key} * 17 + {position * 13}) % 10000) / 8.0D",
            "TIMESTAMP": time,
            "STRING": f"concat('{column[:3]}_', {key} % 9)",
        }[kind]
        fault = (faults or {}).get(column, {})
        if "bad" in fault:
            text = f"CAST({value} AS STRING)"
            value = (
                f"parse_json(CASE WHEN {fault['bad']} THEN '\"bad\"' "
                f"WHEN {fault['quoted']} THEN concat('\"', {text}, '\"') ELSE {text} END)"
            )
        if "masked" in fault:
            value = f"CASE WHEN {fault['masked']} THEN NULL ELSE {value} END"
        if source.kind == "attribute":
            absent = fault.get("absent")
            attributes[source.attribute] = f"CASE WHEN {absent} THEN NULL ELSE {value} END" if absent else value
        elif source.kind == "variable_attribute":
            variable_attributes.setdefault(source.variable, {})[source.attribute] = value
        elif source.kind == "variable":
            whole, absent = struct({"data": value}), fault.get("absent")
            variables[source.variable] = f"CASE WHEN {absent} THEN NULL ELSE {whole} END" if absent else whole
    for variable, own in variable_attributes.items():
        variables[variable] = struct({"attributes": struct(own)})
    return f"to_json({struct({'attributes': struct(attributes), 'variables': struct(variables)})})"


def header_time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def granule_headers(
    spark: SparkSession, sf_dir: str, faulty: bool = False, name: str = EVENT_NAME_SQL
) -> DataFrame:
    """`name, header`: the header text of every wanted event's object."""

    def faults(product: str) -> dict[str, dict[str, str]] | None:
        return {FAULTY_COLUMNS[product]: FAULTS, **NO_NAME} if faulty else None

    events = table(spark, sf_dir, "events").filter("event_id % 6 <> 4")
    cases = " ".join(
        f"WHEN {value} THEN {header_sql(t, 'event_id', 'at', faults(t))}" for value, t in EVENT_TABLES.items()
    )
    return events.withColumn("at", header_time("ts")).select(
        F.expr(name).alias("name"), F.expr(f"CASE event_id % 6 {cases} END").alias("header")
    )


def stored_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`path, header`: the header text of every stored file."""
    header = (
        f"CASE file_type WHEN 'rad' THEN {header_sql('abi_l1b_radiance', 'k', 'at')} "
        f"ELSE {header_sql('abi_l2_mcmip', 'k', 'at')} END"
    )
    files = stored_files(spark, sf_dir).withColumn("at", header_time("mtime"))
    return files.select("path", F.expr(header).alias("header"))
