"""Words, written intermediate tables and Arrow batches shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.operators.ordering import with_position
from granulake.session import working_path

#: The six ASCII characters that separate words.
GAPS = " \t\n\x0b\f\r"
GAP_RUN = "[ \t\n\x0b\f\r]+"


def words(text: Column) -> Column:
    """Words of a text, in order; none for a null or empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def gram_hash(parts: Column, at: Column, size: int) -> Column:
    """64-bit hash of `size` consecutive elements from position `at`."""
    return F.xxhash64(*[F.get(parts, at + i) for i in range(size)])


def gram_text(parts: Column, at: Column, size: int) -> Column:
    """`size` consecutive elements from position `at`, joined by one space."""
    return F.concat_ws(" ", *[F.get(parts, at + i) for i in range(size)])


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    A lost executor costs a re-read, not a recomputation, and the reader knows
    the true size of the table.
    """
    spark = df.sparkSession
    path = working_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of about `size` for what is planned inside.

    Else a batch holds up to 64 MB, in the executor and again in its Python worker, for every task.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bits of the map of wanted ids: its size, 8 MB, is the same for any number of ids.
MAP_BITS = 1 << 26


def with_mark(docs: DataFrame, wanted: DataFrame, mark: str) -> DataFrame:
    """The rows with `mark`: true for wanted ids, and for the few others that a bit map of hashed ids cannot tell from them.

    The map is at most `MAP_BITS` bits, so it is broadcast whatever the number of ids; no row is moved.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(MAP_BITS)) + 1
    bucket, position = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = wanted.select(bucket.alias("bucket"), position.alias("position"))
    bits = saved(bits.groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")), "wanted-bits")
    held = docs.select("*", bucket.alias("bucket"), position.alias("position")).join(F.broadcast(bits), "bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(bits, CAST(position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    given = byte.bitwiseAND(F.expr("shiftleft(1, CAST(position % 8 AS INT))")) != 0
    return held.select(*docs.columns, F.coalesce(given, F.lit(False)).alias(mark))


def likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted ids, and the few others that the bit map cannot tell from them."""
    return with_mark(docs, wanted, "__wanted").where("__wanted").drop("__wanted")


def keyed_rows(docs: DataFrame, id: str, text: str, key: str) -> DataFrame:
    """The rows with `key`, a whole number of each row's own, in the order of ids.

    Whole-number ids that no two rows share, and that no row lacks, are the keys themselves.
    Otherwise rows are numbered by id, rows of one id by their text, and rows without id last.
    """
    whole = isinstance(docs.schema[id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    own = F.col(f"`{id}`")
    if whole and docs.groupBy(own.alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty():
        return docs.withColumn(key, own.cast("long"))
    return with_position(docs, [own.asc_nulls_last(), F.col(f"`{text}`").asc_nulls_first()], key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about `limit` bytes of `column` each.

    A single longer row makes a slice of its own.
    """
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)
