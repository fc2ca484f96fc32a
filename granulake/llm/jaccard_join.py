"""Operator 10: exact Jaccard join of word n-gram sets, by set-relation skipping.

Two sets link when |A & B| * 100 >= percent * |A | B|; percent is 90 and n is 3 unless given.

Index lists skipped by blocks of positions. The order of all n-grams (by hash) is
cut into m blocks. Linked sets of up to a given size differ in at most h n-grams,
and m is h + 1 and some spare, so some of their blocks are equal as a whole: an
index list is kept per block content, and all lists of blocks that differ are
never opened. Sizes are partitioned, each part with its own m; a set also enters
the part below if a smaller partner may be there. Blocks without n-grams are
listed only for sets that have so many of them that all equal blocks could be such.

Answers from similar sets. Equal sets are one class. Of each list's sets, the one
whose lists are longest is the pivot, and only the others' distances to it are
computed. A set linked to the pivot is in its component, so the list's linked sets
need no more comparisons among them. A set that is not linked to a list's pivot is
held against the other sets listed with that pivot, once for all lists of the pivot, but
only those outside its component so far, and
bounds decide first: the difference of the two distances to the pivot and the
number of bits in which the sets' bit maps differ are lower bounds of the distance,
the sum of the two distances an upper one. Only pairs in between are computed.

Most lists hold one set only. They are left out before anything is moved entry by
entry: texts are read in chunks, each chunk sends the lists it opens as short codes to
the buckets of all lists, once each, and gets back one bit per code, whether
another chunk sent it too. What stays is exact again: only lists of two or more sets.

Lists meet by equi-joins and grouped minima, maxima and counts; no list is
gathered anywhere and no partner is dropped. N-grams and sets are compared by
64-bit hash.

Null texts and texts without words: no n-grams, linked with nothing. Fewer words
than n: the whole sequence is the one n-gram. Repeated rows: linked with each
other, whatever their ids; the first of them, by id and text, stays. Ids of any type that has an order; rows
without id come last. Other columns are not read. Empty table: no rows.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import arrow_batches, keyed_rows, likely, saved, words
from granulake.llm.components import components
from granulake.llm.repeats import BASE, MIX, mixed
from granulake.llm.substring_dedup import word_tokens

NGRAM, PERCENT = 3, 90
#: 64-bit words of a set's bit map.
WORDS = 16
#: Of the sets listed with a pivot: those in a slot, rows in a bin of cells, and pairs compared at once.
CELL_ROWS, BIN_ROWS, MEET_AT_ONCE = 1_000, 40_000, 100_000
LISTED = ["key", "n", "apart", "linked", "group"]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def smallest(percent: int) -> int:
    """Least size that can link with a set of another size or content."""
    return -(-percent // (100 - percent))


@lru_cache(maxsize=4096)
def size_part(size: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Least and largest size of the part a size belongs to, and how many n-grams linked sets can differ in."""
    low = smallest(percent)
    high = low + low // 4
    while size > high:
        low, high = high + 1, high + 1 + (high + 1) // 4
    # sizes a + b = s, at least percent * s / (100 + percent) in common
    return low, high, (high + high * 100 // percent) * (100 - percent) // (100 + percent)


def blocks(differ: int) -> int:
    return differ + 1 + max(1, differ // 8)


def ngrams(hashes: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """The sorted set of n-grams of a text's word hashes."""
    if len(hashes) < n:
        if not len(hashes):
            return hashes
        code = np.uint64(len(hashes))
        for h in hashes:
            code = mixed(np.array([code ^ h]))[0]
        return np.array([code], dtype=np.uint64)
    code = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        code = mixed(code + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(code)


def set_key(grams: np.ndarray) -> int:
    """Hash of a set, from two sums over its n-grams."""
    sums = np.array([grams.sum(dtype=np.uint64), (grams ^ (grams >> np.uint64(7))).sum(dtype=np.uint64)])
    sums *= np.array([MIX, BASE], dtype=np.uint64)
    return int(mixed(sums).sum(dtype=np.uint64).view(np.int64))


def bit_map(grams: np.ndarray) -> list[int]:
    """For each of `64 * WORDS` hash classes, whether a set's n-grams in it are odd in number.

    Two sets' maps differ in no more bits than the sets differ in n-grams.
    """
    odd = np.bincount((grams >> np.uint64(17)).astype(np.int64) % (64 * WORDS), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def signatures(grams: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, list[int], list[int]]:
    """Hashes of the blocks under which a set is listed; of each size part, how many there are and how many a linked set shares at least."""
    size = len(grams)
    if size < smallest(percent):
        return np.empty(0, dtype=np.int64), [], []
    listed = [size_part(size, percent)]
    while max(smallest(percent), -(-size * percent // 100)) < listed[-1][0]:
        listed.append(size_part(listed[-1][0] - 1, percent))
    out, counts, needs = [], [], []
    for low, _, differ in listed:
        m = blocks(differ)
        # hash ranges: the n-grams are sorted, so each block is a stretch of them
        edges = np.searchsorted(grams, np.arange(1, m, dtype=np.uint64) * np.uint64((1 << 64) // m))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(grams, dtype=np.uint64)])
        cuts = np.concatenate([[0], edges, [size]])
        content = np.diff(sums[cuts])
        used = np.diff(cuts) > 0
        # of the blocks that are equal in linked sets, some may be without n-grams
        need = m - differ - int((~used).sum())
        if need <= 0:
            used[:], need = True, m - differ
        counts.append(int(used.sum()))
        needs.append(need)
        number = np.arange(m, dtype=np.uint64) + np.uint64(low << 32)
        out.append(mixed(content + mixed(number * np.uint64(MIX)))[used])
    return np.concatenate(out).view(np.int64), counts, needs


def over_sets(docs: DataFrame, rows: Callable[[int, np.ndarray], tuple], schema: str, text: str = "text", n: int = NGRAM) -> DataFrame:
    """`rows(id, n-grams)` of each text of (id, text)."""
    hashes = F.transform(words(lower_ascii(F.col(text))), lambda w: F.xxhash64(w))
    types = [f for f in schema.split(", ")]
    names = [t.split(" ")[0] for t in types]
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    arrow = [kinds[t.split(" ")[1]] for t in types]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, flat, ends in word_tokens(batch):
                starts = np.concatenate([[0], ends[:-1]])
                made = [rows(i, ngrams(flat[a:b], n)) for i, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True)]
                columns = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, arrow, strict=True)], names)

    return docs.select("id", hashes.alias("tokens")).mapInArrow(work, schema)


#: Of rows given to Python at once. A chunk's row, of up to a few MB, is never cut.
BATCH_BYTES = "4m"
#: Codes that meet in one bucket, on average.
BUCKET_CODES = 2_000_000


def set_chunks(docs: DataFrame, n: int, percent: int, text: str = "text") -> DataFrame:
    """One row per chunk of texts of (id, text): ids, sizes and keys of their sets, and the lists that each set is in.

    `parts` is the number of size parts of each set; for each of these `counts` has the number of lists and `needs` how many
    of them a linked set shares.
    """
    longs = ["ids", "sizes", "keys", "parts", "counts", "needs", "lists"]
    schema = ", ".join(["chunk long, n_lists long", *[f"{name} array<long>" for name in longs]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, flat, ends in word_tokens(batch):
                sets = [ngrams(part, n) for part in np.split(flat, ends[:-1])]
                lists, counts, needs = zip(*[signatures(grams, percent) for grams in sets], strict=True)
                columns = [
                    ids,
                    [len(grams) for grams in sets],
                    [set_key(grams) if len(grams) else 0 for grams in sets],
                    [len(own) for own in counts],
                    list(chain.from_iterable(counts)),
                    list(chain.from_iterable(needs)),
                    np.concatenate(lists),
                ]
                arrays = [pa.ListArray.from_arrays([0, len(c)], pa.array(c, pa.int64())) for c in columns]
                row = [pa.array([chunk]), pa.array([len(columns[-1])]), *arrays]
                yield pa.RecordBatch.from_arrays(row, ["chunk", "n_lists", *longs])
                chunk += 1

    hashes = F.transform(words(lower_ascii(F.col(text))), lambda w: F.xxhash64(w))
    return docs.select("id", hashes.alias("tokens")).mapInArrow(work, schema)


def bucket_codes(lists: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and code of each list; equal lists have equal ones."""
    plain = mixed(lists.view(np.uint64))
    return ((plain >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64), plain.astype(np.uint32)


def sent_codes(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """Per chunk and bucket the codes of its lists, each once, in rising order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lists in zip(batch.column("chunk"), batch.column("lists"), strict=True):
                bucket, code = bucket_codes(lists.values.to_numpy(), n_buckets)
                both = np.unique(bucket << 32 | code)
                used, starts = np.unique(both >> 32, return_index=True)
                packed = [part.astype(np.uint32).tobytes() for part in np.split(both, starts[1:])]
                columns = [pa.array(np.full(len(used), chunk.as_py())), pa.array(used), pa.array(packed[: len(used)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "codes"])

    return chunks.select("chunk", "lists").mapInArrow(work, "chunk long, bucket long, codes binary")


def met_elsewhere(bucket: pa.Table) -> pa.Table:
    """Per chunk of a bucket, a bit for each of its codes: whether another chunk sent it."""
    sent = [np.frombuffer(codes.as_buffer(), dtype=np.uint32) for codes in bucket.column("codes")]
    # all chunks at once, so that work grows with the codes and not with chunks times codes
    _, at, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    shared = np.split((counts > 1)[at], np.cumsum([len(own) for own in sent[:-1]]))
    bits = [np.packbits(own).tobytes() for own in shared]
    return pa.table({"chunk": bucket.column("chunk"), "bucket": bucket.column("bucket"), "bits": pa.array(bits, pa.binary())})


def shared_lists(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """(key, n, id, signatures) of the sets that may have a link; lists that hold no other set are left out.

    Linked sets share a number of lists of a size part, so one that shares fewer lists of it with any others has no link there.
    """
    replies = sent_codes(chunks, n_buckets).groupBy("bucket").applyInArrow(met_elsewhere, "chunk long, bucket long, bits binary")
    replies = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("replies"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, sizes, keys, parts, counts, needs, lists = (
                    batch.column(c)[row].values.to_numpy() for c in ("ids", "sizes", "keys", "parts", "counts", "needs", "lists")
                )
                bucket, code = bucket_codes(lists, n_buckets)
                both, at, times = np.unique(bucket << 32 | code, return_inverse=True, return_counts=True)
                met = times > 1
                given = batch.column("replies")[row].values
                number = given.field("bucket").to_numpy()
                low, high = np.searchsorted(both, number << 32), np.searchsorted(both, (number + 1) << 32)
                for lo, hi, bits in zip(low.tolist(), high.tolist(), given.field("bits"), strict=True):
                    met[lo:hi] |= np.unpackbits(np.frombuffer(bits.as_buffer(), dtype=np.uint8), count=hi - lo).astype(bool)
                stays = met[at]
                part = np.repeat(np.arange(len(counts)), counts)
                stays &= (np.bincount(part, weights=stays, minlength=len(counts)) >= needs)[part]
                listed = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(parts)])]
                ends = np.concatenate([[0], np.cumsum(stays)])[listed]
                some = np.flatnonzero(np.diff(ends))
                offsets = np.concatenate([[0], ends[some + 1]])
                columns = [pa.array(c[some], pa.int64()) for c in (keys, sizes, ids)]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(lists[stays])))
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "id", "signatures"])

    return chunks.join(replies, "chunk").mapInArrow(work, "key long, n long, id long, signatures array<long>")


def most_apart(total: np.ndarray, percent: int) -> np.ndarray:
    """The largest number of n-grams in which linked sets of `total` n-grams together differ."""
    return total - 2 * np.ceil(total * percent / (100 + percent) - 1e-9).astype(np.int64)


def distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, apart, linked) of pairs (a, b) of set keys."""
    mine = sets.select(F.col("key").alias("a"), F.col("grams").alias("mine"), F.col("n").alias("n_a"))
    theirs = sets.select(F.col("key").alias("b"), F.col("grams").alias("theirs"), F.col("n").alias("n_b"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for x, y in zip(batch.column("mine"), batch.column("theirs"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common.append(len(np.intersect1d(x, y, assume_unique=True)))
            columns = [batch.column(n) for n in ("a", "b", "n_a", "n_b")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(common, pa.int64())], ["a", "b", "n_a", "n_b", "common"])

    met = pairs.join(mine, "a").join(theirs, "b").select("a", "b", "n_a", "n_b", "mine", "theirs")
    counted = met.mapInArrow(work, "a long, b long, n_a long, n_b long, common long")
    apart = F.col("n_a") + F.col("n_b") - 2 * F.col("common")
    linked = 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))
    return counted.select("a", "b", "n_a", "n_b", apart.alias("apart"), linked.alias("linked"))


def in_size_reach(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def undecided(rows: pa.Table, percent: int) -> pa.Table:
    """(a, b, sure) of the sets that meet in the cells of a bin and that no bound holds apart; `sure` ones are linked.

    Those linked to the cell's pivot are not held against each other.
    """
    pivot, slot, other, key, n, group = (rows.column(c).to_numpy() for c in ("pivot", "slot", "other", "key", "n", "group"))
    apart = pc.fill_null(rows.column("apart"), -1).to_numpy()
    linked = rows.column("linked").to_numpy()
    # signed words would be counted by their absolute value
    bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)
    low, high = np.minimum(slot, other), np.maximum(slot, other)
    order = np.lexsort((high, low, pivot))
    ends = np.flatnonzero(np.diff(pivot[order]) | np.diff(low[order]) | np.diff(high[order])) + 1
    found = []

    def meet(xs: np.ndarray, ys: np.ndarray, within: bool) -> None:
        if not len(ys):
            return
        step = max(1, MEET_AT_ONCE // len(ys))
        for start in range(0, len(xs), step):
            x = xs[start : start + step, None]
            stays = group[x] != group[ys]
            if within:
                stays &= linked[ys] | (key[x] < key[ys])
            i, j = np.nonzero(stays)
            i, j = xs[start + i], ys[j]
            limit = most_apart(n[i] + n[j], percent)
            stays = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            stays &= (np.abs(apart[i] - apart[j]) <= limit) | (apart[i] < 0) | (apart[j] < 0)
            i, j, limit = i[stays], j[stays], limit[stays]
            stays = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64) <= limit
            i, j, limit = i[stays], j[stays], limit[stays]
            sure = (apart[i] + apart[j] <= limit) & (apart[i] >= 0) & (apart[j] >= 0)
            found.append((np.minimum(key[i], key[j]), np.maximum(key[i], key[j]), sure))

    for cell in np.split(order, ends):
        if low[cell[0]] == high[cell[0]]:
            meet(cell[~linked[cell]], cell, within=True)
        else:
            left, right = cell[slot[cell] == low[cell]], cell[slot[cell] == high[cell]]
            meet(left[~linked[left]], right, within=False)
            meet(right[~linked[right]], left[linked[left]], within=False)
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.empty(0, t) for t in (np.int64, np.int64, bool)]
    return pa.table(dict(zip(("a", "b", "sure"), columns, strict=True)))


def linked_classes(listed: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of set keys that connect every two linked sets.

    `listed` has (key, n, signatures), `classes` (key, id of one member).
    """
    entries = listed.select(F.explode("signatures").alias("list"), "key", "n")
    shared = entries.groupBy("list").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("list")
    entries = saved(entries.join(shared, "list", "left_semi").dropDuplicates(["list", "key"]), "lists")
    lengths = entries.groupBy("list").agg(F.count("*").alias("length"))
    weights = entries.join(lengths, "list").groupBy("key").agg(F.sum("length").alias("weight"))
    pivots = entries.join(weights, "key").groupBy("list").agg(F.max(F.struct("weight", "key", "n")).alias("top"))
    entries = saved(entries.join(pivots.select("list", F.col("top.key").alias("pivot"), F.col("top.n").alias("n_pivot")), "list"), "pivoted-lists")

    wanted = entries.select("key").distinct().join(classes, "key").select("id")
    sets = over_sets(likely(docs, wanted), lambda i, g: (set_key(g), i, len(g), g.tobytes(), bit_map(g)), "key long, id long, n long, grams binary, bits array<long>", n=n)
    sets = saved(sets, "sets")
    # copies that the bit map let through would multiply the pairs of their set
    copied = sets.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    sets = sets.join(saved(copied, "copied-sets"), "key", "left").where(F.coalesce(F.col("id") == F.col("first"), F.lit(True)))

    # distances to the pivots
    reach = entries.where("key <> pivot").where(in_size_reach("n", "n_pivot", percent))
    to_pivot = saved(distances(reach.select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct(), sets, percent), "pivot-distances")
    links = to_pivot.where("linked").select("a", "b")

    # sets not linked to a list's pivot, against the others listed with that pivot that no links reach yet; sets
    # meet once under a pivot, however many lists they share there
    reached = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "key")
    known = to_pivot.select(F.col("a").alias("key"), F.col("b").alias("pivot"), "apart", "linked")
    placed = entries.where("key <> pivot").select("pivot", "key", "n").distinct().join(known, ["key", "pivot"], "left").join(reached, "key", "left")
    group = F.coalesce("component", "key").alias("group")
    placed = saved(placed.select("pivot", "key", "n", "apart", F.coalesce("linked", F.lit(False)).alias("linked"), group), "placed")
    open_pivots = placed.groupBy("pivot").agg(F.count("*").alias("others"), F.bool_and("linked").alias("all_linked"))
    open_pivots = saved(open_pivots.where("others > 1 and not all_linked").select("pivot", "others"), "open-pivots")
    # a pivot's sets are dealt over slots, and each two slots meet in a cell, so that none of them is held in one task as a whole
    slots = F.ceil(F.col("others") / CELL_ROWS).cast("int")
    n_bins = 1 + (open_pivots.agg(F.sum(F.col("others") * slots)).first()[0] or 0) // BIN_ROWS
    placed = placed.join(open_pivots.select("pivot", slots.alias("slots")), "pivot").join(sets.select("key", "bits"), "key")
    placed = placed.withColumn("slot", F.pmod(F.hash("key"), "slots")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    cell = F.xxhash64("pivot", F.least("slot", "other"), F.greatest("slot", "other"))
    placed = placed.select("pivot", "slot", "other", *LISTED, "bits", F.pmod(cell, F.lit(n_bins)).alias("bin"))
    near = placed.groupBy("bin").applyInArrow(lambda rows: undecided(rows, percent), "a long, b long, sure boolean")
    near = near.groupBy("a", "b").agg(F.max("sure").alias("sure"))
    near = saved(near, "pairs-left")
    rest = distances(near.where("not sure").select("a", "b"), sets, percent).where("linked")
    return links.unionByName(near.where("sure").select("a", "b")).unionByName(rest.select("a", "b"))


def joined(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Each row's id, set size, and the smallest id reachable by links between sets of n-grams."""
    keyed = keyed_rows(docs, id, text, "__key")
    own = keyed.select(F.col("__key").alias("row_key"), F.col(f"`{id}`").alias("own_id"))
    first = own.select(F.col("row_key").alias("component"), F.col("own_id").alias("component_id"))
    found = joined_rows(keyed, text, n, percent).join(own, "row_key").join(first, "component")
    return found.select(F.col("own_id").alias(id), "n_shingles", "component_id")


def joined_rows(keyed: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    """`row_key`, `n_shingles` and `component`, the smallest key reachable, of rows with a `__key`."""
    if n < 1 or not 1 <= percent <= 99:
        raise ValueError(f"{n}-grams, {percent} percent")
    # chunks and sets are wide rows; all that reads them in Python is written in here
    with arrow_batches(keyed.sparkSession, BATCH_BYTES):
        return _joined_rows(keyed, text, n, percent)


def _joined_rows(keyed: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    keyed = keyed.select(F.col("__key").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    chunks = saved(set_chunks(keyed.select("id", "text"), n, percent), "set-chunks")
    sets = chunks.select(F.explode(F.arrays_zip("ids", "sizes", "keys")).alias("s"))
    rows = saved(sets.select(F.col("s.ids").alias("id"), F.col("s.sizes").alias("n"), F.when(F.col("s.sizes") > 0, F.col("s.keys")).alias("key")), "set-rows")
    classes = saved(rows.where("key is not null").groupBy("key").agg(F.min("id").alias("id")), "set-classes")
    n_buckets = 64 + (chunks.agg(F.sum("n_lists")).first()[0] or 0) // BUCKET_CODES
    # of equal sets one speaks
    listed = saved(shared_lists(chunks, n_buckets).join(classes, ["key", "id"], "left_semi").drop("id"), "shared-lists")
    links = linked_classes(listed, classes, keyed.select("id", "text"), n, percent)
    ends = links.join(classes.select(F.col("key").alias("a"), F.col("id").alias("u")), "a").join(classes.select(F.col("key").alias("b"), F.col("id").alias("v")), "b")
    groups = components(ends.select("u", "v"))
    named = classes.join(groups, F.col("id") == F.col("node"), "left").select("key", F.coalesce("component", "id").alias("component_id"))
    own = rows.select("id", "n", "key").join(named, "key", "left")
    return own.select(F.col("id").alias("row_key"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, that are the first of their component."""
    keyed = keyed_rows(docs, id, text, "__key")
    first = joined_rows(keyed, text, n, percent).where("row_key = component").select(F.col("row_key").alias("__key"))
    return keyed.join(saved(first, "first-of-group"), "__key", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
