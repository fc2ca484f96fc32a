"""CSV text in the quote-only-when-needed dialect."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column
from pyspark.sql import functions as F

# Same dialect for reading, writing and text columns: doubled quotes, empty
# text for null, blanks kept.
CSV_OPTIONS = {
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
ROW_END = "\r\n"

_SPECIAL = "[\",\\r\\n]"

_SPARK_EXPONENT = r"^(-?\d\.\d+)E(-?\d+)$"


def header_line(names: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(names)
    return out.getvalue()


def joined_line(values: Column) -> Column:
    """One CSV line, without a row end, of an array of texts.

    An array keeps the expression the same size for any number of fields. One
    test per row finds out whether any field needs quotes; few rows do.
    """

    def field(value: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(value.rlike(_SPECIAL), quoted).otherwise(value)

    careful = F.array_join(F.transform(values, field), ",", "")
    return F.when(F.array_join(values, "").rlike(_SPECIAL), careful).otherwise(
        F.array_join(values, ",", "")
    )


def plain_numbers(values: Column) -> Column:
    """`plain_number` of every text in an array, skipped when none needs it."""
    return F.when(
        F.contains(F.array_join(values, " "), F.lit("E")), F.transform(values, plain_number)
    ).otherwise(values)


def has_exponent(values: Column) -> Column:
    """Whether any text in an array is, or holds, a number with an exponent."""
    return F.array_join(values, " ").rlike(r"\dE-?\d")


def plain_number(text: Column) -> Column:
    """Number text in the form most CSV writers use.

    Spark spells doubles below 1e-3 and from 1e7 with an exponent. Here plain
    digits are used from 1e-4 up to 1e16, and beyond that a lower-case, signed,
    two-digit exponent. Other text passes through.
    """
    exponent = F.regexp_extract(text, _SPARK_EXPONENT, 2).try_cast("int")
    digits = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    size = F.abs(exponent).cast("string")
    short = F.concat(
        F.regexp_replace(F.regexp_extract(text, _SPARK_EXPONENT, 1), r"\.0$", ""),
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size),
    )
    return F.when(
        text.contains("E") & text.rlike(_SPARK_EXPONENT),
        F.when(exponent.between(-4, 15), plain).otherwise(short),
    ).otherwise(text)
