"""Operator 11: ranked lexical search by a document FP-tree.

Only terms of the items matter, so each document becomes a vector of those terms with
their counts, most frequent term first. Vectors in that order share the paths of a
trie. Each node knows, of the documents below it, the highest count of every term, the
least m and the least id; as a score rises with counts and falls with m, these bound
the score of any document below for every item. The trie is walked depth first, node
after node with the items whose bound still reaches the 20th best score found so
far; the other items are done with all that lies below. Every bound is exact integer
arithmetic, so nothing that belongs to a result is cut off.

The documents are read once per block of items (`BLOCK_BYTES` of item text: the one
thing the driver and tasks hold of the items) and their vectors are written; counts
of documents, terms and of documents per term are sums over them. Each task builds
tries of at most `TREE_ENTRIES` vector entries one after the other, and gives
its best 20 per item at its end; the best of all tasks are found in two steps, by item
and a share of the tasks, then by item.

Null or empty text: no terms; it neither counts nor is found. A null id ranks behind
all others of the same score. Repeated documents: each is ranked. Items without
terms, or whose terms no document holds, have no rows; equal item rows count
once, and rows with one id and several texts are ranked each on its own. Further
columns of either table do no harm.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.llm.common import pieces, saved

#: Bytes of item text whose terms are looked for in one reading of the documents.
BLOCK_BYTES = 1_000_000
#: Cells of the table of weights by term and item that a walk uses at a time.
CELLS = 4_000_000
#: Entries (terms of documents) of one trie.
TREE_ENTRIES = 3_000_000
#: Bytes of document text handled at a time.
PIECE_BYTES = 4_000_000
#: Shares of the tasks in the first step of gathering.
SHARES = 256

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | bytes) -> list[bytes]:
    """Terms of a text in order; only A-Z are lower-cased."""
    return TERM.findall((text.encode() if isinstance(text, str) else text).lower())


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def gain(counts: np.ndarray, m: int) -> np.ndarray:
    """What one occurrence of a term in an item adds, by unit of weight."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class Items:
    """A block of items: their terms, and once document counts are known, weights and groups for a walk."""

    def __init__(self, texts: list[str | None]) -> None:
        self.terms = [terms(t or "") for t in texts]
        self.number = {t: i for i, t in enumerate(dict.fromkeys(t for row in self.terms for t in row))}

    def ordered(self, holding: dict[int, int], documents: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Rank of each term by falling frequency, and groups of items: which, and weights by rank and item."""
        count = len(self.number)
        df = np.array([holding.get(i, 0) for i in range(count)], dtype=np.int64)
        rank = np.empty(count, dtype=np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(count)
        weights = [weight(documents, int(n)) for n in df]
        groups = []
        size = max(1, CELLS // max(count, 1))
        for start in range(0, len(self.terms), size):
            table = np.zeros((count, min(size, len(self.terms) - start)), dtype=np.int64)
            for column, row in enumerate(self.terms[start : start + size]):
                for term in row:
                    table[rank[self.number[term]], column] += weights[self.number[term]]
            groups.append((np.arange(start, start + table.shape[1]), table))
        return rank, groups


class Best:
    """The best documents of each item so far, as sorted (-score, id is null, id)."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        #: Score that a document must reach.
        self.bar = np.ones(items, dtype=np.int64)

    def offer(self, item: int, score: int, id: object) -> None:
        rows = self.rows[item]
        entry = (-score, id is None, 0 if id is None else id)
        if len(rows) == self.k:
            if entry >= rows[-1]:
                return
            rows.pop()
        bisect.insort(rows, entry)
        if len(rows) == self.k:
            self.bar[item] = -rows[-1][0]

    def open(self, items: np.ndarray, bounds: np.ndarray, least: object) -> np.ndarray:
        """Positions of items that a document of this bound and no smaller id could enter."""
        hit = np.flatnonzero(bounds >= self.bar[items])
        if least is None or not len(hit):
            return hit
        return np.array(
            [
                at
                for at in hit.tolist()
                if bounds[at] > self.bar[items[at]]
                or len(self.rows[items[at]]) < self.k
                or (-int(bounds[at]), False, least) < self.rows[items[at]][-1]
            ],
            dtype=np.int64,
        )


class Node:
    """Documents that share the path down to here: maxima of counts below, least m, least id, children, own documents."""

    __slots__ = ("children", "counts", "least", "m", "own", "ranks")

    def __init__(self, ranks: np.ndarray, counts: np.ndarray, m: int, least: object) -> None:
        self.ranks, self.counts, self.m, self.least = ranks, counts, m, least
        self.children: list[Node] = []
        self.own: list[tuple[int, object]] = []


def leaf(ranks: np.ndarray, counts: np.ndarray, m: int, id: object) -> Node:
    node = Node(ranks, counts, m, id)
    node.own.append((m, id))
    return node


def joined(children: list[Node]) -> Node:
    """The node above several nodes."""
    if len(children) == 1:
        return children[0]
    ranks = np.concatenate([c.ranks for c in children])
    counts = np.concatenate([c.counts for c in children])
    order = np.argsort(ranks, kind="stable")
    ranks = ranks[order]
    first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])) if len(ranks) else order
    given = [c.least for c in children if c.least is not None]
    most = np.maximum.reduceat(counts[order], first) if len(first) else counts
    node = Node(ranks[first], most, min(c.m for c in children), min(given) if given else None)
    node.children = children
    return node


def tree(vectors: list[tuple[np.ndarray, np.ndarray, int, object]]) -> Node:
    """The trie of some documents: (ranks rising, counts, m, id) each. A path without forks is one node.

    Sorted vectors meet their neighbours on the path they share; open paths are kept on a stack.
    """
    keys = [v[0].astype(">i4").tobytes() for v in vectors]
    order = sorted(range(len(vectors)), key=keys.__getitem__)
    stack: list[tuple[int, list[Node]]] = [(0, [])]

    def shared(a: bytes, b: bytes) -> int:
        x, y = vectors[a][0], vectors[b][0]
        size = min(len(x), len(y))
        differ = np.flatnonzero(x[:size] != y[:size])
        return int(differ[0]) if len(differ) else size

    for place, at in enumerate(order):
        depth = shared(order[place - 1], at) if place else 0
        node = leaf(*vectors[at])
        # close the forks below the path shared with the document before
        while stack[-1][0] > depth:
            _, children = stack.pop()
            closed = joined(children)
            if stack[-1][0] < depth:
                stack.append((depth, [closed]))
                break
            stack[-1][1].append(closed)
        if stack[-1][0] < depth:
            before = stack[-1][1].pop()
            stack.append((depth, [before]))
        stack[-1][1].append(node)
    while len(stack) > 1:
        _, children = stack.pop()
        stack[-1][1].append(joined(children))
    return joined(stack[0][1])


def walk(root: Node, items: np.ndarray, table: np.ndarray, best: Best) -> None:
    """Depth first from the root; each node with the items it can still matter to, best bound first."""

    def bounds(node: Node, columns: np.ndarray) -> np.ndarray:
        return (gain(node.counts, node.m)[:, None] * table[node.ranks[:, None], columns]).sum(axis=0)

    every = np.arange(len(items))
    waiting = [(root, every, bounds(root, every))]
    while waiting:
        node, columns, limit = waiting.pop()
        still = best.open(items[columns], limit, node.least)
        columns, limit = columns[still], limit[still]
        if not len(columns):
            continue
        for _, id in node.own:
            for item, score in zip(items[columns].tolist(), limit.tolist(), strict=True):
                best.offer(item, score, id)
        below = [(child, columns, bounds(child, columns)) for child in node.children]
        waiting.extend(sorted(below, key=lambda entry: int(entry[2].max())))


def _vectors(docs: DataFrame, items: Items, id: str, text: str) -> DataFrame:
    """`id`, `n` and, of the terms of the items, their numbers and counts."""
    ints = T.ArrayType(T.IntegerType())
    out = T.StructType(
        [T.StructField("id", docs.schema[id].dataType), T.StructField("n", T.LongType())]
        + [T.StructField("terms", ints), T.StructField("counts", ints)]
    )
    number = items.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, PIECE_BYTES):
                sizes, lists = [], []
                for whole in piece.column(text).cast(pa.binary()).to_pylist():
                    found = terms(whole or b"")
                    held = np.fromiter(map(number.get, found, repeat(-1)), dtype=np.int64, count=len(found))
                    sizes.append(len(found))
                    lists.append(np.unique(held[held >= 0], return_counts=True))
                ends = pa.array(np.cumsum([0, *[len(t) for t, _ in lists]]), pa.int32())
                flat = [np.concatenate([row[side] for row in lists]) for side in (0, 1)]
                arrays = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in flat]
                yield pa.RecordBatch.from_arrays([piece.column(id), pa.array(sizes, pa.int64()), *arrays], out.names)

    return docs.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias(text)).mapInArrow(run, out)


def _best_of_tasks(vectors: DataFrame, items: Items, totals: tuple[int, int], holding: dict[int, int], k: int) -> DataFrame:
    """`item`, `id`, `score`: the best of each task."""
    documents, length = totals
    rank, groups = items.ordered(holding, documents)
    out = T.StructType(
        [T.StructField("item", T.IntegerType()), vectors.schema["id"], T.StructField("score", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.terms), k)
        held: list[tuple] = []
        entries, kind = 0, None

        def close() -> None:
            root = tree(held)
            for own, table in groups:
                walk(root, own, table, best)
            held.clear()

        for batch in batches:
            kind = batch.schema.field("id").type
            ids, sizes = batch.column("id").to_pylist(), batch.column("n").to_pylist()
            ends = batch.column("terms").offsets.to_numpy()
            ranks = rank[batch.column("terms").values.to_numpy()]
            counts = batch.column("counts").values.to_numpy().astype(np.int64)
            for row, id in enumerate(ids):
                start, stop = ends[row], ends[row + 1]
                if start == stop:
                    continue
                order = np.argsort(ranks[start:stop])
                m = 100 - 25 + (25 * sizes[row] * documents) // length
                held.append((ranks[start:stop][order], counts[start:stop][order], m, id))
                entries += int(stop - start)
                if entries >= TREE_ENTRIES:
                    close()
                    entries = 0
        if held:
            close()
        rows = [(item, None if missing else id, -score) for item, own in enumerate(best.rows) for score, missing, id in own]
        if rows:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return vectors.select("id", "n", "terms", "counts").where(F.size("terms") > 0).mapInArrow(run, out)


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("id").asc_nulls_last()]


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """`item_id, rank, doc_id, score` of each item's `k` best documents with a score above 0."""
    asked = items.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{text}`").alias("item_text")).distinct()
    asked = saved(asked, "search-items")
    size = asked.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n_blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(n_blocks))
    found = None
    for number in range(n_blocks):
        rows = asked.where(block == number).collect()
        own = Items([r.item_text for r in rows])
        vectors = saved(_vectors(docs, own, id, text), "search-vectors")
        totals = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not rows or not totals[0]:
            continue
        counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        per_task = saved(_best_of_tasks(vectors, own, tuple(totals), dict(map(tuple, counted)), k), "search-best")
        share = F.pmod(F.xxhash64("id"), F.lit(SHARES))
        step = Window.partitionBy("item", "share").orderBy(*_order())
        best = per_task.withColumn("share", share).withColumn("at", F.row_number().over(step)).where(F.col("at") <= k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*_order()))
        best = best.withColumn("rank", rank).where(F.col("rank") <= k)
        ids = asked.sparkSession.createDataFrame(
            [(n, r.item_id) for n, r in enumerate(rows)],
            T.StructType([T.StructField("item", T.IntegerType()), asked.schema["item_id"]]),
        )
        best = best.join(ids, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        found = best if found is None else found.unionByName(best)
    if found is not None:
        return found
    empty = T.StructType(
        [asked.schema["item_id"], T.StructField("rank", T.IntegerType())]
        + [T.StructField("doc_id", docs.schema[id].dataType), T.StructField("score", T.LongType())]
    )
    return asked.sparkSession.createDataFrame([], empty)
