"""Operator 2: benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by an item if it holds at least `share` of the item's
distinct word shingles, anywhere. Words are runs of letters and digits, in lower
case.

Search. Shingles are ordered by a 64-bit hash, and an item's signature is its
lowest hashes. Items are partitioned by size (powers of two); all of a partition
keep floor((1 - share) * largest) + 1 hashes. A document that holds `share` of an
item misses at most (1 - share) * size of its shingles, so it holds at least one
of the signature: no contaminated document is missed, however long it is. A
document too short for an item is skipped by size.

Check. For each pair found, all shingles of the item are counted in the document
by their text.

Both steps look up a document's shingles, made inside the row, in a small table of
item shingles. That table is broadcast while it has at most `BROADCAST_SHINGLES`
rows; a larger benchmark is joined by hash. Only hits are shuffled.

Null and empty texts, and items of fewer than five words: no shingles, no rows.
Repeated rows: an item id with several rows is one item with all their shingles,
and so is a document id. Rows without id are each known by their text. Empty tables: no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import gram_hash, gram_text, saved

SHINGLE = 5
SHARE = 0.8
BROADCAST_SHINGLES = 200_000


def plain_words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def alone(id: Column, text: Column) -> Column:
    """What tells rows without id apart: a hash of the text, 0 for rows with one."""
    return F.when(id.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def same(left: str, right: str, names: list[str]) -> Column:
    """Whether keys are equal; a missing id is equal to a missing id."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


DOC, ITEM = ["doc_id", "doc_alone"], ["item_id", "item_alone"]


def shingles(rows: DataFrame, ids: list[str], text: str, size: int = SHINGLE) -> DataFrame:
    """Ids, hash, text and the row's number of shingles, one row per place."""
    split = rows.select(*ids, plain_words(F.col(text)).alias("words")).where(F.size("words") >= size)
    places = split.select(*ids, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at"))
    return places.select(
        *ids,
        gram_hash(F.col("words"), F.col("at"), size).alias("hash"),
        gram_text(F.col("words"), F.col("at"), size).alias("shingle"),
        (F.size("words") - size + 1).alias("places"),
    )


def signatures(items: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of `items` (item_id, item_alone, hash, shingle) whose hash is in the item's signature, with its size."""
    sizes = items.groupBy(*ITEM).agg(F.sort_array(F.collect_set("hash")).alias("hashes"))
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("hashes"))) + 1) - 1
    taken = (F.floor(F.lit(1 - share) * largest + 1e-9) + 1).cast("int")
    kept = sizes.select(*ITEM, F.size("hashes").alias("size"), F.explode(F.slice("hashes", F.lit(1), taken)).alias("hash"))
    met = kept.alias("kept").join(items.alias("items"), same("kept", "items", [*ITEM, "hash"]))
    return met.select("kept.*", "items.shingle")


def contaminated_by(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", id: str = "doc_id", item_id: str = "item_id", share: float = SHARE
) -> DataFrame:
    """doc_id, doc_alone, item_id, item_alone, size of the item, shingles in common."""
    named = docs.select(F.col(id).alias("doc_id"), alone(F.col(id), F.col(text)).alias("doc_alone"), F.col(text).alias("text"))
    places = shingles(named, DOC, "text")
    source = benchmark.select(F.col(item_id).alias("item_id"), alone(F.col(item_id), F.col(item_text)).alias("item_alone"), F.col(item_text).alias("text"))
    items = saved(shingles(source, ITEM, "text").select(*ITEM, "hash", "shingle").distinct(), "benchmark-shingles")
    sought = saved(signatures(items, share).select(*ITEM, "size", "hash", "shingle"), "benchmark-signatures")
    small = items.count() <= BROADCAST_SHINGLES
    near = F.broadcast if small else lambda table: table

    def hits(table: DataFrame) -> DataFrame:
        mine, theirs = places.alias("mine"), near(table.alias("theirs"))
        return mine.join(theirs, (F.col("mine.hash") == F.col("theirs.hash")) & (F.col("mine.shingle") == F.col("theirs.shingle")))

    pairs = (
        hits(sought)
        .where(F.col("places") >= F.lit(share) * F.col("size") - 1e-9)
        .select(*DOC, *ITEM, "size")
        .distinct()
    )
    pairs = saved(pairs, "benchmark-candidates")
    common = hits(items).select(*DOC, *ITEM, "mine.shingle").distinct().groupBy(*DOC, *ITEM).agg(F.count("*").alias("n_common"))
    need = F.ceil(F.lit(share) * F.col("n_item") - 1e-9)
    return (
        common.alias("common").join(pairs.alias("pairs"), same("common", "pairs", [*DOC, *ITEM]))
        .select("common.*", F.col("size").cast("long").alias("n_item"))
        .where(F.col("n_common") >= need)
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", id: str = "doc_id", item_id: str = "item_id", share: float = SHARE
) -> DataFrame:
    """doc_id, item_id, size of the item, shingles in common, containment."""
    found = contaminated_by(docs, benchmark, text, item_text, id, item_id, share)
    return found.select("doc_id", "item_id", "n_item", "n_common", (F.col("n_common") / F.col("n_item")).alias("containment"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = contaminated_by(docs, benchmark, text=text, id=id).select(F.col("doc_id").alias("__found_id"), F.col("doc_alone").alias("__found_alone"))
    found = saved(found.distinct(), "contaminated")
    own = F.col(id).eqNullSafe(F.col("__found_id")) & (alone(F.col(id), F.col(text)) == F.col("__found_alone"))
    return docs.join(found, own, "left_anti")
