"""Join shapes shared by the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join to an aggregated side with one row per key, safe for hot left keys.

    An aggregate keeps its partitioning, so a join on the same columns would
    read it without a new exchange, and adaptive execution only splits a hot
    partition when both inputs come straight from one. Joining on the keys as
    one struct forces that exchange on the small side. A small side is
    broadcast by its measured size either way.
    """
    known = right
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    known = known.select(
        F.struct(*keys).alias("_key"), *[c for c in right.columns if c not in keys]
    )
    return left.withColumn("_key", F.struct(*keys)).join(known, "_key", how).drop("_key")


#: Bits of the map of wanted values: its size, 16 MB, is the same for any number of them.
MAP_BITS = 1 << 27


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows with a wanted `key`, and the few others that a bit map of hashed keys cannot tell from them.

    The map is broadcast, and no row is moved. Null keys are dropped.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MAP_BITS)) + 1
    bucket = F.bitmap_bucket_number(place).alias("_bucket")
    places = wanted.filter(F.col(key).isNotNull()).select(bucket, F.bitmap_bit_position(place).alias("_position"))
    bits = places.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))
    held = rows.filter(F.col(key).isNotNull()).select("*", bucket, F.bitmap_bit_position(place).alias("_position"))
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(_position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    given = byte.bitwiseAND(F.expr("shiftleft(1, CAST(_position % 8 AS INT))")) != 0
    return held.join(F.broadcast(bits), "_bucket").filter(given).select(*rows.columns)
