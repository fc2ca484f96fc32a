"""Strict reading of JSON message text with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false"}
_FIELDS = "struct<name:variant,id:variant,size:variant,updated:variant>"


def strict_object(text: Column) -> Column:
    """Array with the one object the text holds; null or another size otherwise.

    Spark's reader stops after the first complete value, so trailing text goes
    unnoticed. Wrapped in brackets, a second value makes the array longer and
    stray text breaks it.
    """
    return F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), f"array<{_FIELDS}>", _STRICT
    )


def closes_once(text: Column) -> Column:
    """Second guard: the text does not close the bracket itself.

    Without a closing bracket it cannot. With one, it must also be readable as
    the value of a field, which text that leaves the bracket is not. Most
    messages hold no bracket, so the second parse rarely runs.
    """
    wrapped = F.from_json(
        F.concat(F.lit('{"w":'), text, F.lit("}")), "struct<w:struct<name:variant>>", _STRICT
    )
    return ~F.contains(text, F.lit("]")) | wrapped["w"].isNotNull()


def is_json_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def variant_text(value: Column) -> Column:
    """Text of a variant scalar; null for JSON null and for absent fields."""
    return F.try_variant_get(value, "$", "string")
