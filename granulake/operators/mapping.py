"""Header fields chosen by a mapping config.

A config names, per file type, `metadata` (global attribute -> column) and
`data` (variable -> column, or variable -> {attribute -> column}). It is read
on the driver and becomes part of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.functions.csv_text import has_exponent, header_line, joined_line, plain_number
from granulake.functions.paths import public_url
from granulake.operators.headers import header_path, readable, with_text_header
from granulake.operators.once import with_computed
from granulake.schemas import Source

URL_COLUMN = "base_url"

# Any header with the kind of each value kept.
_VALUES = (
    "struct<attributes:map<string,variant>,"
    "variables:map<string,struct<attributes:map<string,variant>,data:variant>>>"
)


def mapped_columns(type_config: dict) -> list[tuple[str, Source]]:
    """Output columns of one file type in header order, with their sources."""
    columns: list[tuple[str, Source]] = [(URL_COLUMN, Source("url"))]
    for attribute, column in (type_config.get("metadata") or {}).items():
        if not isinstance(column, str):
            raise ValueError(f"attribute {attribute!r} must map to a column name")
        columns.append((column, Source("attribute", attribute=attribute)))
    for variable, target in (type_config.get("data") or {}).items():
        if isinstance(target, str):
            columns.append((target, Source("variable", variable=variable)))
            continue
        for attribute, column in target.items():
            columns.append((column, Source("variable_attribute", variable, attribute)))
    names = [name for name, _ in columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns mapped more than once: {repeated}")
    return sorted(columns, key=lambda pair: pair[0])


def mapped_header_line(config: dict, file_type: str) -> str:
    return header_line([name for name, _ in mapped_columns(config[file_type])])


def with_mapped_header(files: DataFrame, config: dict) -> DataFrame:
    """Parse each header once, reading what any file type of the config needs."""
    sources = [s for t in config.values() for _, s in mapped_columns(t) if s.kind != "url"]
    return with_text_header(files, list(dict.fromkeys(sources)))


def _value(source: Source, store_prefix: str) -> Column:
    if source.kind == "url":
        return public_url(F.col("path"), store_prefix)
    return F.expr(header_path(source))


def _is_text(source: Source, header: Column) -> Column:
    """Whether a header gives this value as text, not as a bare number."""
    if source.kind == "url":
        return F.lit(True)
    if source.kind == "attribute":
        value = header["attributes"][source.attribute]
    elif source.kind == "variable":
        value = header["variables"][source.variable]["data"]
    else:
        value = header["variables"][source.variable]["attributes"][source.attribute]
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _are_texts(sources: list[Source], header: Column) -> Column:
    """`_is_text` of each source, of a header parsed once."""
    return F.transform(
        F.array(header), lambda parsed: F.array(*[_is_text(s, parsed) for s in sources])
    )[0]


def records(files: DataFrame, config: dict, store_prefix: str) -> DataFrame:
    """`path, file_type` and the mapped columns of all file types in one pass.

    A field is null where the header lacks it, or where the row's file type
    does not map it.
    """
    values: dict[str, list[Column]] = {}
    for file_type, type_config in config.items():
        for column, source in mapped_columns(type_config):
            own = F.when(F.col("file_type") == file_type, _value(source, store_prefix))
            values.setdefault(column, []).append(own)
    parsed = with_mapped_header(files.filter(F.col("file_type").isin(*config)), config)
    return parsed.filter(readable()).select(
        "path", "file_type", *[F.coalesce(*values[c]).alias(c) for c in sorted(values)]
    )


def _texts(config: dict, store_prefix: str) -> dict[str, Column]:
    """The line of a mapped header by file type."""
    as_variants = F.from_json("header", _VALUES)
    texts = {}
    for file_type in config:
        sources = [s for _, s in mapped_columns(config[file_type])]
        values = F.array(*[_value(s, store_prefix) for s in sources])
        spelled = F.zip_with(
            values, _are_texts(sources, as_variants), lambda v, text: F.when(text, v).otherwise(plain_number(v))
        )
        texts[file_type] = joined_line(F.when(has_exponent(values), spelled).otherwise(values))
    return texts


def with_csv_lines(files: DataFrame, config: dict, store_prefix: str) -> DataFrame:
    """Replace `header` by `csv_lines`, the `csv_line` each file type of the config would give, in its order."""
    texts = F.array(F.lit(None).cast("string"), *_texts(config, store_prefix).values())
    parsed = with_mapped_header(files, config)
    lined = with_computed(parsed, "_line", F.struct(F.when(readable(), texts).alias("csv_lines")))
    return lined.select(
        *[c for c in files.columns if c != "header"], F.col("_line.csv_lines").alias("csv_lines")
    )


def own_line(file_type: Column, lines: Column, config: dict) -> Column:
    """The line of a file type among `csv_lines`; null for a type the config lacks."""
    line = F.lit(None).cast("string")
    for position, known in enumerate(config, start=1):
        line = F.when(file_type == known, F.get(lines, F.lit(position))).otherwise(line)
    return line


def with_csv_line(files: DataFrame, config: dict, store_prefix: str) -> DataFrame:
    """Add `csv_line` by each row's file type.

    It is null for a type the config lacks and for an unreadable header.
    Numbers are spelled in plain digits and text stays as it is. Which is which
    takes a second look at the header, only for rows with a value like `1.0E7`.
    """
    line = F.lit(None).cast("string")
    for file_type, text in _texts(config, store_prefix).items():
        line = F.when(F.col("file_type") == file_type, text).otherwise(line)
    parsed = with_mapped_header(files, config)
    lined = with_computed(parsed, "_line", F.struct(F.when(readable(), line).alias("csv_line")))
    return lined.select(
        *[c for c in files.columns if c != "header"], F.col("_line.csv_line").alias("csv_line")
    )
