"""Reading values out of granule header text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.operators.once import with_computed
from granulake.schemas import HEADER_SCHEMA, Source, pruned_header_schema

_CORRUPT = "_corrupt_record"

# Values that may be quoted although their column is a number: variable data
# and the bounding box.
_NUMERIC_KEY = r'"(data|geospatial_\w+)"\s*:\s*'
_QUOTED_NUMBER = _NUMERIC_KEY + r'"(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?)"'
_EMPTY_VALUE = r':\s*""'

# The names a header gives, whatever their values.
_NAMES = (
    "struct<attributes:map<string,string>,"
    "variables:map<string,struct<attributes:map<string,string>>>>"
)


def full_header(header: Column) -> Column:
    """The whole header as maps, for any attribute or variable name."""
    return F.from_json(header, HEADER_SCHEMA)


def _parse(text: Column, shape: T.StructType) -> Column:
    schema = T.StructType([*shape.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": _CORRUPT, "timeZone": "UTC"}
    return F.from_json(text, schema, options)


def with_text_header(df: DataFrame, sources: list[Source], header: str = "header") -> DataFrame:
    """Parse header text once per row into `_header`, every value as text."""
    try:
        shape = pruned_header_schema([(source, T.StringType()) for source in sources])
    except ValueError:
        shape = HEADER_SCHEMA
    return with_computed(df, "_header", _parse(F.col(header), shape))


def with_typed_headers(
    df: DataFrame,
    kind: str,
    fields: dict[str, list[tuple[Source, T.DataType]]],
    header: str = "header",
) -> DataFrame:
    """Parse header text once per row, values in column types.

    Adds `_headers`, a struct with one header per kind of which only that of
    the row's own kind is filled. The reader types the values itself, so no
    cast per column follows. It only takes bare numbers; rows it refuses are
    read again with quoted numbers bared and empty text as null, and what is
    still refused is not `readable`.
    """
    shapes = {name: pruned_header_schema(own) for name, own in fields.items()}
    text = F.col(header)
    bared = F.regexp_replace(
        F.regexp_replace(text, _EMPTY_VALUE, ":null"), _QUOTED_NUMBER, '"$1":$2'
    )
    first = F.struct(
        *[
            F.when(F.col(kind) == name, _parse(text, shape)).alias(name)
            for name, shape in shapes.items()
        ]
    )
    best = F.struct(
        *[
            F.when(F.col("_first")[name][_CORRUPT].isNull(), F.col("_first")[name])
            .otherwise(_parse(bared, shape))
            .alias(name)
            for name, shape in shapes.items()
        ]
    )
    return with_computed(with_computed(df, "_first", first), "_headers", best).drop("_first")


def header_path(source: Source, header: str = "_header") -> str:
    """One value of a parsed header as SQL text; null where the header lacks it."""

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    if source.kind == "attribute":
        return f"{header}.attributes.{quoted(source.attribute)}"
    variable = f"{header}.variables.{quoted(source.variable)}"
    if source.kind == "variable":
        return f"{variable}.data"
    return f"{variable}.attributes.{quoted(source.attribute)}"


def lacks_any(sources: list[Source], header: str = "header") -> Column:
    """Whether header text lacks one of these fields; null if it cannot be read.

    A field that is there without a value, or with null, is masked and not lacking.
    """
    attributes: dict[str, list[str]] = {}
    variables: set[str] = set()
    for source in sources:
        if source.kind == "attribute":
            attributes.setdefault("", []).append(source.attribute)
        elif source.kind in ("variable", "variable_attribute"):
            variables.add(source.variable)
            if source.attribute is not None:
                attributes.setdefault(source.variable, []).append(source.attribute)

    def lacks(names: set[str] | list[str], held: Column) -> Column:
        given = F.coalesce(F.map_keys(held), F.array().cast("array<string>"))
        return F.size(F.array_except(F.array(*map(F.lit, sorted(names))), given)) > 0

    def any_of(parsed: Column) -> Column:
        tests = [lacks(variables, parsed["variables"])] if variables else []
        for variable, names in attributes.items():
            own = parsed["variables"][variable]["attributes"] if variable else parsed["attributes"]
            tests.append(lacks(names, own))
        return F.when(parsed.isNotNull(), reduce(or_, tests))

    return F.transform(F.array(F.from_json(F.col(header), _NAMES)), any_of)[0]


def readable(header: str = "_header") -> Column:
    """Whether there was a JSON header with values of the right types."""
    return F.col(header).isNotNull() & F.col(f"{header}.{_CORRUPT}").isNull()
