"""Repeated token windows, found by Spark without moving every window.

A window is `length` consecutive tokens of one text. Windows are grouped digit by
digit, as a most-significant-digit radix sort does, and whatever stays alone in its
group is dropped:

1. The first digit is the window's anchor, the first of the lowest hashes among its
   grams of `gram` tokens. Consecutive windows with one anchor travel as one row, a run.
2. Runs found under an anchor that others share are grouped by the hash of the whole
   run. Equal runs have equal windows, one by one; one of them, the lead, speaks
   for all in what follows.
3. Where different runs meet under one anchor, the leads are cut into blocks, by the
   distance to the anchor. The next digit is a block's core, the tokens all its
   windows hold; then, again, the hash of the whole block.
4. What is still undecided is looked at window by window.

How texts are cut decides only how much is left for the later steps, never the
result. Groups are counted by grouped sums, so a run or window that fills a third of
the rows is added up before it is shuffled; joins are plain equi-joins that
adaptive execution splits. Every comparison is by at least two 64-bit hashes
together, the anchor's and the run's, block's or window's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import arrow_batches, likely, saved

#: Fixed odd multipliers of the polynomial hash and of the mixing step.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
#: Tokens hashed at a time; longer texts are taken in parts that overlap by a window.
PART = 1_000_000
#: Of rows given to Python at once. A row is never cut.
BATCH_BYTES = "4m"

_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** i modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, PART + 4096), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(MIX)
    x ^= x >> np.uint64(32)
    return x


class Hashes:
    """Rolling polynomial hash (Rabin-Karp, modulo 2 ** 64) of any window of a token array."""

    def __init__(self, tokens: np.ndarray) -> None:
        self.back = powers(INVERSE, len(tokens) + 1)
        self.sums = np.empty(len(tokens) + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(tokens * powers(BASE, len(tokens)), dtype=np.uint64, out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        """Hash of the window of `size` tokens at every place."""
        return mixed((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])

    def some(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def parts(count: int, length: int) -> Iterator[tuple[int, int]]:
    """Token ranges that together hold every window of a text once."""
    windows = count - length + 1
    for start in range(0, max(0, windows), PART):
        yield start, min(count, start + PART + length - 1)


def runs_of(tokens: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor and run hash of each run.

    `tokens` are the rows' tokens in a row, `ends` where each row ends.
    """
    none = np.empty(0, dtype=np.int64)
    if len(tokens) < length or not len(ends):
        return none, none, none, none, none
    hashes = Hashes(tokens)
    grams = hashes.all(gram)
    anchors = lowest(grams, length - gram + 1)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(anchors)]
    inside = np.arange(length, length + len(anchors)) <= ends[row]
    first = np.ones(len(anchors), dtype=bool)
    # a run also ends where its anchor gram is left behind, so no two of its windows are equal
    left = grams[: len(anchors) - 1] == anchors[:-1]
    first[1:] = (anchors[1:] != anchors[:-1]) | left | (row[1:] != row[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(first & inside)
    # a run lasts to the next change, or to the last window inside its row
    change = np.flatnonzero(first | ~inside)
    after = np.append(change, len(anchors))[np.searchsorted(change, starts, side="right")]
    counts = after - starts
    begin = np.concatenate([[0], ends[:-1]])
    whole = hashes.some(starts, starts + counts + length - 1)
    return row[starts], starts - begin[row[starts]], counts, anchors[starts].view(np.int64), whole.view(np.int64)


#: From a batch of rows to groups of them: ids, tokens in a row, and where each row ends.
Tokens = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def stretches(flat: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, its first token, tokens, and row ends of what is hashed at a time.

    A row of several parts is taken part by part, whatever rows it comes with; `block_table`
    cuts at the same places, so every run lies inside one part.
    """
    begin = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - begin - length + 1 > PART).tolist()
    done = 0
    for row in [*long, len(ends)]:
        if row > done:
            yield done, 0, flat[begin[done] : ends[row - 1]], ends[done:row] - begin[done]
        if row < len(ends):
            own = flat[begin[row] : ends[row]]
            for lo, hi in parts(len(own), length):
                yield row, lo, own[lo:hi], np.array([hi - lo])
        done = row + 1


def run_table(docs: DataFrame, tokens: Tokens, length: int, gram: int) -> DataFrame:
    """One row per run: id, first window, number of windows, anchor, hash of the run."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, flat, ends in tokens(batch):
                for first, shift, some, its_ends in stretches(flat, ends, length):
                    row, start, count, anchor, whole = runs_of(some, its_ends, length, gram)
                    columns = [ids[row + first], start + shift, count, anchor, whole]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "start", "count", "anchor", "run"])

    return docs.mapInArrow(work, "id long, start long, count long, anchor long, run long")


def first_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first minimum of every `width` consecutive values, by doubling."""

    def meet(low_a: np.ndarray, at_a: np.ndarray, low_b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        later = low_b < low_a
        return np.where(later, low_b, low_a), np.where(later, at_b, at_a)

    span, low, at = 1, values, np.arange(len(values))
    while span * 2 <= width:
        low, at = meet(low[:-span], at[:-span], low[span:], at[span:])
        span *= 2
    rest = width - span
    return meet(low[:-rest], at[:-rest], low[rest:], at[rest:])[1] if rest else at


#: What a text is asked about: first window, number of windows, group so far, and whether the row speaks for itself only.
ASKED = ["start", "count", "key", "sole"]


def each_asked(batch: pa.RecordBatch, tokens: Tokens) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, ...]]]:
    """Id, tokens and what is asked of each text."""
    asked = dict(zip(batch.column("id").to_pylist(), batch.column("asked"), strict=True))
    for ids, flat, ends in tokens(batch):
        for i, id in enumerate(ids.tolist()):
            begin = int(ends[i - 1]) if i else 0
            spans = asked[id].values
            yield id, flat[begin : int(ends[i])], tuple(spans.field(n).to_numpy(zero_copy_only=False) for n in ASKED)


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows repeated `counts` times: the row, and the number of the repetition."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def block_table(asked: DataFrame, tokens: Tokens, length: int, gram: int, block: int) -> DataFrame:
    """The runs asked about, cut into blocks: id, start, count, key (of anchor, distance and core), whole, sole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id, own, (start, count, key, sole) in each_asked(batch, tokens):
                for lo, hi in parts(len(own), length):
                    mine = (start >= lo) & (start + count - 1 <= hi - length)
                    if not mine.any():
                        continue
                    hashes = Hashes(own[lo:hi])
                    first, many = start[mine] - lo, count[mine]
                    anchor = first_lowest(hashes.all(gram), length - gram + 1)[first]
                    # windows by distance to the anchor: the farthest starts first
                    far, near = anchor - first, anchor - first - many + 1
                    row, step = spread(far // block - near // block + 1)
                    number = near[row] // block + step
                    begin = np.maximum(first[row], anchor[row] - number * block - block + 1)
                    end = np.minimum(first[row] + many[row], anchor[row] - number * block + 1)
                    core = hashes.some(anchor[row] - number * block, anchor[row] - number * block - block + 1 + length)
                    code = mixed(mixed(core + number.astype(np.uint64)) ^ key[mine][row].view(np.uint64))
                    whole = hashes.some(begin, end + length - 1)
                    columns = [np.full(len(row), id), begin + lo, end - begin, code.view(np.int64), whole.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(sole[mine][row])], ["id", "start", "count", "key", "whole", "sole"])

    return asked.mapInArrow(work, "id long, start long, count long, key long, whole long, sole boolean")


def window_table(asked: DataFrame, tokens: Tokens, length: int) -> DataFrame:
    """One row per window asked about: id, start, key, sole, hash of the window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id, own, (start, count, key, sole) in each_asked(batch, tokens):
                row, step = spread(count)
                place = start[row] + step
                for lo, hi in parts(len(own), length):
                    here = (place >= lo) & (place <= hi - length)
                    if here.any():
                        at = place[here] - lo
                        window = Hashes(own[lo:hi]).some(at, at + length).view(np.int64)
                        columns = [pa.array(np.full(len(at), id), pa.int64()), pa.array(place[here]), pa.array(key[row][here]), pa.array(sole[row][here]), pa.array(window)]
                        yield pa.RecordBatch.from_arrays(columns, ["id", "start", "key", "sole", "window"])

    return asked.mapInArrow(work, "id long, start long, key long, sole boolean, window long")


def settled(rows: DataFrame, earlier: bool, label: str) -> tuple[DataFrame, DataFrame]:
    """What equal rows under one key settle, and what is left to ask.

    `rows`: id, start, count, key, whole, sole. Settled spans are id, start, count;
    those to ask are id and an array `asked`.
    """
    # counts are written before they are joined: a side read from a table is dealt out by the
    # join itself, and adaptive execution can then split a hot key
    shared = saved(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), f"{label}-keys")
    rows = saved(rows.join(shared, "key", "left_semi"), f"{label}-shared")
    groups = rows.groupBy("key", "whole").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.min(F.struct("id", "start")).alias("lead"))
    groups = saved(groups, f"{label}-groups")
    varied = saved(groups.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1").select("key", F.lit(True).alias("varied")), f"{label}-varied")
    groups = saved(groups.join(varied, "key", "left"), f"{label}-known")
    known = rows.join(groups, ["key", "whole"])
    if earlier:
        done, leads = F.col("id") > F.col("least"), F.col("id") == F.col("least")
    else:
        done, leads = F.col("n") > 1, F.struct("id", "start") == F.col("lead")
    asks = leads & F.coalesce("varied", F.lit(False))
    known = known.select("id", "start", "count", "key", "sole", done.alias("done"), asks.alias("asks")).where("asks or (done and sole)")
    known = saved(known, f"{label}-judged")
    more = F.struct("start", "count", "key", (F.col("sole") & ~F.col("done")).alias("sole"))
    return known.where("done and sole").select("id", "start", "count"), known.where("asks").groupBy("id").agg(F.collect_list(more).alias("asked"))


def repeated_spans(
    docs: DataFrame, prepare: Callable[[DataFrame], DataFrame], tokens: Tokens, length: int, gram: int, block: int, earlier: bool
) -> DataFrame:
    """Id and spans (start, count) of the windows that are repeated.

    `earlier`: a window counts only if it also starts in a row of smaller id;
    otherwise if it starts anywhere else, in the same row too. `docs` has id and
    text; `prepare` makes what `tokens` reads of it, and keeps other columns.
    """
    # all that Python makes of the texts is written in here
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        runs = run_table(prepare(docs), tokens, length, gram).select("id", "start", "count", F.col("anchor").alias("key"), F.col("run").alias("whole"), F.lit(True).alias("sole"))
        spans, asked = settled(saved(runs, "runs"), earlier, "runs")
        asked = saved(asked, "asked")
        # only texts that are asked about are moved
        texts = saved(likely(docs, asked).join(asked, "id"), "texts-asked")
        more, asked = settled(saved(block_table(prepare(texts), tokens, length, gram, block), "blocks"), earlier, "blocks")
        windows = saved(window_table(prepare(texts.drop("asked").join(asked, "id")), tokens, length), "windows")
        alike = windows.groupBy("key", "window").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
        single = windows.where("sole").join(saved(alike, "windows-alike"), ["key", "window"])
        single = single.where("id > least") if earlier else single
        spans = spans.unionByName(more).unionByName(single.select("id", "start", F.lit(1).cast("long").alias("count")))
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "count")).alias("spans"))


def covered(spans: pa.StructArray, length: int, tokens: int) -> np.ndarray:
    """Which tokens of a row lie in the windows of its spans."""
    steps = np.zeros(tokens + 1, dtype=np.int64)
    start = spans.field("start").to_numpy()
    np.add.at(steps, start, 1)
    np.add.at(steps, start + spans.field("count").to_numpy() + length - 1, -1)
    return np.cumsum(steps[:-1]) > 0


def row_key(id: str, text: str) -> Column:
    """The id, or for a row without one a negative number made of its text."""
    return F.coalesce(F.col(id).cast("long"), F.xxhash64(text).bitwiseOR(F.lit(-(2**63))))


def maximal(mask: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of covered tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
