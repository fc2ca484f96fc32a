"""Notification messages: strict parsing, relevance, routing."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.functions.json_text import (
    closes_once,
    is_json_string,
    strict_object,
    variant_text,
)
from granulake.operators.once import with_computed
from granulake.schemas import PRODUCT_ROUTES

KEPT = "kept"
SKIPPED = "skipped"
MALFORMED = "malformed"


def product_table(name: Column) -> Column:
    """Table an object name belongs to: first route whose text it contains."""
    first, *rest = PRODUCT_ROUTES
    table = F.when(F.contains(name, F.lit(first[0])), first[1])
    for text, target in rest:
        table = table.when(F.contains(name, F.lit(text)), target)
    return table


def parse_messages(messages: DataFrame, text: str = "value") -> DataFrame:
    """Read message text into `name, id, size, updated` and give each row a verdict.

    * `malformed`: not one JSON object, no text `name`, or a wanted object
      without an `id`
    * `skipped`: a name no product table wants
    * `kept`: everything else, with its `table_name`

    `size_given` tells an absent size from a null one. `updated` is null where it
    is absent or no time.
    """
    value = F.col(text)
    parsed = with_computed(
        messages,
        "_parsed",
        F.struct(strict_object(value).alias("objects"), closes_once(value).alias("closed")),
    )
    one = F.get(F.col("_parsed.objects"), F.lit(0))
    well_formed = (
        (F.size("_parsed.objects") == 1) & F.col("_parsed.closed") & is_json_string(one["name"])
    )
    fields = with_computed(
        parsed,
        "_fields",
        F.struct(
            F.when(well_formed, variant_text(one["name"])).alias("name"),
            one["id"].isNotNull().alias("id_given"),
            variant_text(one["id"]).alias("id"),
            one["size"].isNotNull().alias("size_given"),
            variant_text(one["size"]).alias("size"),
            variant_text(one["updated"]).try_cast("timestamp").alias("updated"),
        ),
    )
    name = F.col("_fields.name")
    verdict = (
        F.when(name.isNull(), MALFORMED)
        .when(product_table(name).isNull(), SKIPPED)
        .when(~F.col("_fields.id_given"), MALFORMED)
        .otherwise(KEPT)
    )
    added = {
        "name": name,
        "id": F.when(name.isNotNull(), F.col("_fields.id")),
        "size": F.when(name.isNotNull(), F.col("_fields.size")),
        "updated": F.when(name.isNotNull(), F.col("_fields.updated")),
        "size_given": F.when(name.isNotNull(), F.col("_fields.size_given")),
        "table_name": product_table(name),
        "verdict": verdict,
    }
    return fields.select(
        *[c for c in messages.columns if c not in added],
        *[column.alias(c) for c, column in added.items()],
    )


def kept(parsed: DataFrame) -> DataFrame:
    # The verdict implies the name test. Stated as such, it also tells the
    # optimizer that few messages remain, so their days can prune a join.
    wanted = reduce(or_, [F.contains("name", F.lit(text)) for text, _ in PRODUCT_ROUTES])
    return parsed.filter((F.col("verdict") == KEPT) & wanted).drop("verdict")


def skipped(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("verdict") == SKIPPED).drop("verdict")


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("verdict") == MALFORMED).drop("verdict")
