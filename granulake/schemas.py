"""Table schemas and, for every product column, where its value comes from."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Text looked for in an object name, in matching order, and the table it feeds.
PRODUCT_ROUTES = [
    ("ABI-L1b", "abi_l1b_radiance"),
    ("ABI-L2-CMIP", "abi_l2_cmip"),
    ("ABI-L2-MCMIP", "abi_l2_mcmip"),
    ("GLM-L2-LCFA", "glm_l2_lcfa"),
]

# Where the described objects live.
OBJECT_URL_PREFIX = "gs://gcp-public-data-goes-16/"

# Column names and types of the product tables, in table order.
_ABI_L1B_RADIANCE = """
    dataset_name STRING
    platform_ID STRING
    orbital_slot STRING
    timeline_id STRING
    scene_id STRING
    band_id STRING
    time_coverage_start TIMESTAMP
    time_coverage_end TIMESTAMP
    date_created TIMESTAMP
    geospatial_westbound_longitude FLOAT
    geospatial_northbound_latitude FLOAT
    geospatial_eastbound_longitude FLOAT
    geospatial_southbound_latitude FLOAT
    nominal_satellite_subpoint_lon FLOAT
    valid_pixel_count INTEGER
    missing_pixel_count INTEGER
    saturated_pixel_count INTEGER
    undersaturated_pixel_count INTEGER
    min_radiance_value_of_valid_pixels FLOAT
    max_radiance_value_of_valid_pixels FLOAT
    mean_radiance_value_of_valid_pixels FLOAT
    std_dev_radiance_value_of_valid_pixels FLOAT
    percent_uncorrectable_l0_errors FLOAT
    total_size INTEGER
    base_url STRING
"""
_ABI_L2_CMIP = """
    dataset_name STRING
    platform_ID STRING
    orbital_slot STRING
    timeline_id STRING
    scene_id STRING
    band_id STRING
    time_coverage_start TIMESTAMP
    time_coverage_end TIMESTAMP
    date_created TIMESTAMP
    geospatial_westbound_longitude FLOAT
    geospatial_northbound_latitude FLOAT
    geospatial_eastbound_longitude FLOAT
    geospatial_southbound_latitude FLOAT
    nominal_satellite_subpoint_lon FLOAT
    total_number_of_points INTEGER
    valid_pixel_count INTEGER
    outlier_pixel_count INTEGER
    percent_uncorrectable_grb_errors FLOAT
    percent_uncorrectable_l0_errors FLOAT
    total_size INTEGER
    base_url STRING
"""
# The multiband table repeats its per-channel columns over 16 channels: 1-6 are
# reflective, 7-16 are emissive.
_ABI_L2_MCMIP_HEAD = """
    dataset_name STRING
    platform_ID STRING
    orbital_slot STRING
    timeline_id STRING
    scene_id STRING
    time_coverage_start TIMESTAMP
    time_coverage_end TIMESTAMP
    date_created TIMESTAMP
    geospatial_westbound_longitude FLOAT
    geospatial_northbound_latitude FLOAT
    geospatial_eastbound_longitude FLOAT
    geospatial_southbound_latitude FLOAT
    nominal_satellite_subpoint_lon FLOAT
"""
_ABI_L2_MCMIP_TAIL = """
    percent_uncorrectable_grb_errors FLOAT
    percent_uncorrectable_l0_errors FLOAT
    total_size INTEGER
    base_url STRING
"""
_GLM_L2_LCFA = """
    dataset_name STRING
    platform_ID STRING
    orbital_slot STRING
    time_coverage_start TIMESTAMP
    time_coverage_end TIMESTAMP
    date_created TIMESTAMP
    group_time_threshold FLOAT
    flash_time_threshold FLOAT
    event_count INTEGER
    group_count INTEGER
    flash_count FLOAT
    percent_navigated_L1b_events FLOAT
    percent_uncorrectable_L0_errors FLOAT
    total_size INTEGER
    base_url STRING
"""
_STATISTICS = ["min", "max", "mean", "std_dev"]
_REFLECTIVE_CHANNELS = range(1, 7)
_EMISSIVE_CHANNELS = range(7, 17)

# Header attributes that are read from the file itself rather than a variable.
GLOBAL_ATTRIBUTES = [
    "dataset_name",
    "platform_ID",
    "orbital_slot",
    "timeline_id",
    "scene_id",
    "time_coverage_start",
    "time_coverage_end",
    "date_created",
]

# Queue states of a tracked file.
QUEUED = 1
CLAIMED = 2
DONE = 0
# --- end of fixed values ----------------------------------------------------

_SPARK_TYPES = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "FLOAT": T.DoubleType(),
    "INTEGER": T.LongType(),
}


@dataclass(frozen=True)
class Source:
    """Place of one value: a header path, or a field of the message."""

    kind: str  # "attribute" | "variable" | "variable_attribute" | "size" | "url"
    variable: str | None = None
    attribute: str | None = None


def _multiband_columns() -> list[tuple[str, str]]:
    columns = [(f"outlier_pixel_count_c{c:02d}", "INTEGER") for c in range(1, 17)]
    for quantity, channels in (
        ("reflectance_factor", _REFLECTIVE_CHANNELS),
        ("brightness_temperature", _EMISSIVE_CHANNELS),
    ):
        columns += [
            (f"{stat}_{quantity}_c{c:02d}", "FLOAT") for c in channels for stat in _STATISTICS
        ]
    return columns


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(line.split()) for line in text.split("\n") if line.strip()]


# table -> [(column, declared type)]
PRODUCT_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "abi_l1b_radiance": _pairs(_ABI_L1B_RADIANCE),
    "abi_l2_cmip": _pairs(_ABI_L2_CMIP),
    "abi_l2_mcmip": _pairs(_ABI_L2_MCMIP_HEAD) + _multiband_columns() + _pairs(_ABI_L2_MCMIP_TAIL),
    "glm_l2_lcfa": _pairs(_GLM_L2_LCFA),
}

PRODUCT_SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(name, _SPARK_TYPES[kind], True) for name, kind in columns])
    for table, columns in PRODUCT_COLUMNS.items()
}

# A header of any shape: everything a granule declares about itself.
HEADER_SCHEMA = T.StructType(
    [
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "variables",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("data", T.StringType()),
                    ]
                ),
            ),
        ),
    ]
)

TRACKING_SCHEMA = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("mtime", T.TimestampNTZType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("inqueue", T.IntegerType()),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# CSV text of a granule, as written for one message.
OBJECT_SCHEMA = T.StructType(
    [
        T.StructField("dest_uri", T.StringType()),
        T.StructField("csv_text", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("updated", T.TimestampType()),
    ]
)


def column_source(column: str) -> Source:
    """Where a product column's value is found. One rule set fits all products."""
    if column == "total_size":
        return Source("size")
    if column == "base_url":
        return Source("url")
    if column in GLOBAL_ATTRIBUTES:
        return Source("attribute", attribute=column)
    if column == "band_id":
        return Source("variable_attribute", variable="band_id", attribute="units")
    if column.startswith("geospatial_"):
        return Source(
            "variable_attribute", variable="geospatial_lat_lon_extent", attribute=column
        )
    variable = re.sub(r"_c(\d\d)$", r"_C\1", column)
    variable = variable.replace("_grb_errors", "_GRB_errors").replace("_l0_errors", "_L0_errors")
    return Source("variable", variable=variable)


def pruned_header_schema(fields: list[tuple[Source, T.DataType]]) -> T.StructType:
    """The smallest header shape that still holds every listed value.

    Parsing into fixed structs reads only these fields and makes each lookup a
    position instead of a search through a map. Raises `ValueError` for names
    that differ only in case, which cannot live in one struct.
    """
    attributes: dict[str, T.DataType] = {}
    variables: dict[str, tuple[dict[str, T.DataType], list[T.DataType]]] = {}
    for source, kind in fields:
        if source.kind == "attribute":
            attributes[source.attribute] = kind
        elif source.kind == "variable_attribute":
            variables.setdefault(source.variable, ({}, []))[0][source.attribute] = kind
        elif source.kind == "variable":
            variables.setdefault(source.variable, ({}, []))[1].append(kind)

    def struct(types: dict[str, T.DataType]) -> T.StructType:
        if len({name.lower() for name in types}) < len(types):
            raise ValueError(f"names differ only in case: {sorted(types)}")
        return T.StructType([T.StructField(name, types[name]) for name in sorted(types)])

    def variable(own_attributes: dict[str, T.DataType], data: list[T.DataType]) -> T.StructType:
        parts: dict[str, T.DataType] = {}
        if own_attributes:
            parts["attributes"] = struct(own_attributes)
        if data:
            parts["data"] = data[0]
        return struct(parts)

    parts: dict[str, T.DataType] = {}
    if attributes:
        parts["attributes"] = struct(attributes)
    if variables:
        parts["variables"] = struct({name: variable(*v) for name, v in variables.items()})
    return struct(parts)
