"""Operator 13: alignment of two tokenizers over the same bytes.

A text is coded by a byte-level tokenizer (A, after one added blank) and by a
SentencePiece model (B, which adds the blank itself). Tokens are laid out by the
bytes they stand for. `merge_asof`, keyed by document, finds for the start of each
token the other side's token that covers it, once in either direction; the union of
both is exactly the pairs of tokens that overlap, since of two overlapping tokens
the later one starts inside the other. Where a token of either side ends, a group ends.

How often two ids go together is counted over the corpus in documents. Counts
are not moved document by document: a task cuts its texts into blocks of about
`BLOCK_BYTES` and gives one row per block, with the block's distinct id pairs, each
counted once per document that holds it, and its documents as positions in that
list. Only the lists are grouped by pair; each block gets the counts of its own
pairs back and sums them for its documents. A pair found everywhere has one row per
block, summed before it is moved, and the join back is one that adaptive execution
can split. Blocks are written before they are counted, so a lost executor changes none.

Null or empty text, and text whose tokens do not stand for exactly its bytes (a
literal blank mark, for one): zeros, no groups. Repeated rows: each gives its own row
and counts as a document. Only the id column is kept, of any type, null included;
further columns do no harm.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granulake.llm.bpe import byte_letters
from granulake.llm.chunk_codes import ChunkCodes, ranges
from granulake.llm.common import pieces, saved
from granulake.llm.sentence_pieces import BLANK, PieceModel

#: Bytes of text in a block (a longer text is a block of its own), and bytes aligned at a time.
BLOCK_BYTES, PIECE_BYTES = 2_000_000, 300_000


class ByteTokens:
    """A byte-level tokenizer without special tokens, read from a tokenizer file's bytes."""

    #: White space, and the chunks no cut of the tokenizer looks beyond: white space with what follows it.
    SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")

    #: How byte-level tokenizers of this kind cut a text before they merge; a fixed pattern.
    CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, file: bytes) -> None:
        import tiktoken

        spec = json.loads(file)
        vocabulary = spec["model"]["vocab"]
        added = {token["content"] for token in spec["added_tokens"]}
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.bytes = [b""] * (1 + max(vocabulary.values()))
        for token, number in vocabulary.items():
            if token not in added:
                self.bytes[number] = bytes(map(byte_of.__getitem__, token))
        merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"])
        if any(vocabulary[token] != 256 + i for i, token in enumerate(merged)):
            raise ValueError("the ids of a byte-level vocabulary must be in the order of its merges")
        ranks = {said: number for number, said in enumerate(self.bytes) if said}
        merger = tiktoken.Encoding("byte-level", pat_str=self.CUTS, mergeable_ranks=ranks, special_tokens={})
        self.codes = ChunkCodes(lambda chunks: list(map(merger.encode_ordinary, chunks)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.codes.tokens([self.CHUNK.findall(" " + t) for t in texts])


class PieceTokens:
    """A SentencePiece model whose pieces stand for bytes."""

    def __init__(self, model: bytes) -> None:
        self.model = PieceModel(model)
        self.bytes = [said.replace(BLANK.encode(), b" ") for said in self.model.said]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        forms = [self.model.normal(t)[0] for t in texts]
        return self.model.codes.tokens([self.model.chunk.findall(form) for form in forms])


class Vocabulary:
    """What each token of a tokenizer stands for, one after the other."""

    def __init__(self, coder: ByteTokens | PieceTokens) -> None:
        self.coder, self.said = coder, coder.bytes
        self.sizes = np.array([len(b) for b in self.said], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.said), dtype=np.uint8)


class Side:
    """One tokenizer's tokens of a batch: ids, where they start and end among the bytes of all texts, and their document."""

    def __init__(self, words: Vocabulary, texts: list[str]) -> None:
        self.ids, self.ends = words.coder.encode(texts)
        self.words, self.sizes = words, words.sizes

    def holds(self, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text stand for exactly these bytes."""
        said = self.words.flat[ranges(self.words.starts[self.ids], self.sizes[self.ids])]
        if np.array_equal(said, np.frombuffer(b"".join(texts), dtype=np.uint8)):
            lengths = np.concatenate([[0], np.cumsum(self.sizes[self.ids])])[self.ends]
            if np.array_equal(np.diff(lengths), [len(t) for t in texts]):
                return np.ones(len(texts), dtype=bool)
        flat, ends = self.ids.tolist(), self.ends.tolist()
        parts = zip(ends, ends[1:], texts, strict=False)
        return np.array([b"".join(map(self.words.said.__getitem__, flat[a:b])) == t for a, b, t in parts], dtype=bool)

    def keep(self, wanted: np.ndarray) -> None:
        """Lay out the tokens of the wanted documents; the others have none."""
        counts = np.where(wanted, np.diff(self.ends), 0)
        self.ids = self.ids[ranges(self.ends[:-1], counts)]
        self.ends = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.stop = np.cumsum(self.sizes[self.ids])
        self.start = self.stop - self.sizes[self.ids]
        self.frame = pd.DataFrame({"doc": self.doc, "start": self.start, "own": np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all overlapping tokens of two sides, each pair once."""
    if not len(a.ids):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cover = {"on": "start", "by": "doc", "suffixes": ("", "_other")}
    there = pd.merge_asof(a.frame, b.frame, **cover)
    back = pd.merge_asof(b.frame, a.frame, **cover)
    # tokens that start together have been found already
    back = back[a.start[back["own_other"].to_numpy()] < back["start"].to_numpy()]
    left = np.concatenate([there["own"].to_numpy(), back["own_other"].to_numpy()])
    right = np.concatenate([there["own_other"].to_numpy(), back["own"].to_numpy()])
    return left.astype(np.int64), right.astype(np.int64)


class Aligner:
    """Both tokenizers of a task, and how their ids are written."""

    def __init__(self, file: bytes, model: bytes) -> None:
        self.words = (Vocabulary(ByteTokens(file)), Vocabulary(PieceTokens(model)))
        marks = ((",", "|"), (",", ";"))
        self.texts = [
            np.array([f"{i}{mark}" for mark in own for i in range(len(words.said))], dtype=object)
            for words, own in zip(self.words, marks, strict=True)
        ]

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Of a batch of texts: numbers per document, groups as text, and all overlapping id pairs."""
        sides = [Side(words, texts) for words in self.words]
        wanted = [(" " + t).encode() if t else None for t in texts]
        whole = np.array([t is not None for t in wanted], dtype=bool)
        for side in sides:
            whole &= side.holds([t or b"" for t in wanted])
        for side in sides:
            side.keep(whole)
        a, b = sides
        left, right = overlaps(a, b)
        return {
            "n_a": np.diff(a.ends),
            "n_b": np.diff(b.ends),
            **self.groups(a, b),
            "link_doc": a.doc[left],
            "link": a.ids[left].astype(np.int64) << 32 | b.ids[right],
        }

    def groups(self, a: Side, b: Side) -> dict[str, np.ndarray | list]:
        """Number of groups per document and their text: ids of A, a bar, ids of B, and a semicolon between groups."""
        # how many sides end at each byte; where both do, a group ends, so a token's group is the number of ends before it
        ending = np.zeros(1 + (int(a.stop[-1]) if len(a.stop) else 0), dtype=np.int8)
        ending[a.stop] += 1
        ending[b.stop] += 1
        common = ending == 2
        before = np.cumsum(common) - common
        codes, orders = [], []
        for part, side in enumerate((a, b)):
            codes.append(self.texts[part][side.ids + common[side.stop] * len(side.words.said)])
            orders.append(2 * before[side.stop] + part)
        order = np.argsort(np.concatenate(orders), kind="stable")
        written = np.concatenate(codes)[order].tolist()
        ends = (a.ends + b.ends).tolist()
        return {
            "n_groups": np.bincount(a.doc[common[a.stop]], minlength=len(a.ends) - 1),
            "groups": ["".join(written[i:j])[:-1] for i, j in zip(ends, ends[1:], strict=False)],
        }


@lru_cache(maxsize=1)
def aligner(file: bytes, model: bytes) -> Aligner:
    """One per Python worker."""
    return Aligner(file, model)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _pairs_of_docs(found: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and number of links of each id pair of a document, by document."""
    pairs, at = np.unique(found["link"], return_inverse=True)
    held, times = np.unique(found["link_doc"] * max(len(pairs), 1) + at, return_counts=True)
    doc, at = np.divmod(held, max(len(pairs), 1))
    return doc, pairs[at], times


def _block(pieces: list[tuple[dict, tuple, pa.Array]]) -> list[pa.Array]:
    """One block of aligned pieces: its documents, and distinct pairs with the number of documents that hold them."""
    counts = [len(found["n_a"]) for found, _, _ in pieces]
    n = sum(counts)
    doc = np.concatenate([own[0] + before for (_, own, _), before in zip(pieces, np.cumsum([0, *counts]).tolist(), strict=False)])
    times = np.concatenate([own[2] for _, own, _ in pieces])
    pairs, at = np.unique(np.concatenate([own[1] for _, own, _ in pieces]), return_inverse=True)
    n_docs = np.bincount(at, minlength=len(pairs))
    ends = np.searchsorted(doc, np.arange(n + 1))
    columns = {
        "id": pa.concat_arrays([ids for *_, ids in pieces]),
        **{name: pa.array(np.concatenate([found[name] for found, *_ in pieces]), pa.int64()) for name in ("n_a", "n_b", "n_groups")},
        "groups": pa.array([text for found, *_ in pieces for text in found["groups"]], pa.string()),
        "at": _lists(ends, pa.array(at, pa.int32())),
        "times": _lists(ends, pa.array(times, pa.int32())),
    }
    docs = pa.StructArray.from_arrays([*columns.values()], names=[*columns])
    pair = {"a": pa.array(pairs >> 32, pa.int32()), "b": pa.array(pairs & 0xFFFFFFFF, pa.int32()), "docs": pa.array(n_docs, pa.int64())}
    held = pa.StructArray.from_arrays([*pair.values()], names=[*pair])
    return [_lists(np.array([0, n]), docs), _lists(np.array([0, len(pairs)]), held)]


def blocks(docs: DataFrame, byte_file: str, piece_file: str, id: str, text: str) -> DataFrame:
    """One row per block of documents: `block`, `docs`, `pairs` (a, b, docs that hold them)."""
    whole = T.LongType()
    ints = T.ArrayType(T.IntegerType())
    doc = T.StructType(
        [T.StructField("id", docs.schema[id].dataType)]
        + [T.StructField(n, whole) for n in ("n_a", "n_b", "n_groups")]
        + [T.StructField("groups", T.StringType()), T.StructField("at", ints), T.StructField("times", ints)]
    )
    pair = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("docs", whole)])
    out = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(doc)), T.StructField("pairs", T.ArrayType(pair))]
    )
    file, model = Path(byte_file).read_bytes(), Path(piece_file).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(file, model)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch, text, BLOCK_BYTES):
                done = []
                for piece in pieces(part, text, min(PIECE_BYTES, BLOCK_BYTES)):
                    found = both.align([t or "" for t in piece.column(text).to_pylist()])
                    done.append((found, _pairs_of_docs(found), piece.column(id)))
                    del found["link"], found["link_doc"]
                yield pa.RecordBatch.from_arrays([pa.array([block]), *_block(done)], out.names)
                block += 1

    return docs.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias(text)).mapInArrow(run, out)


def pair_counts(written: DataFrame) -> DataFrame:
    """`a, b, n` and whether no pair of `a` has a higher `n` (`best`)."""
    pair = F.explode("pairs").alias("pair")
    counts = saved(written.select(pair).groupBy("pair.a", "pair.b").agg(F.sum("pair.docs").alias("n")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks whose pairs have their counts: sums over the links of each."""
    for batch in batches:
        for row in range(batch.num_rows):
            docs = batch.column("docs")[row].values
            counts = batch.column("counts")[row].values
            n, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            if counts is not None and len(counts):
                order = np.argsort(counts.field("at").to_numpy())
                n = counts.field("n").to_numpy()[order]
                best = counts.field("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
            at, times = docs.field("at"), docs.field("times")
            sizes = np.diff(at.offsets.to_numpy())
            pair, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sums = [
                np.diff(np.concatenate([[0], np.cumsum(values)])[ends]) for values in (times, times * best[pair], times * n[pair])
            ]
            given = [docs.field(name) for name in ("id", "n_a", "n_b", "n_groups")]
            columns = [*given, *[pa.array(x, pa.int64()) for x in sums], docs.field("groups")]
            yield pa.RecordBatch.from_arrays(columns, NUMBERS)


NUMBERS = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def aligned(
    docs: DataFrame,
    byte_file: str,
    piece_file: str,
    id: str = "doc_id",
    text: str = "text",
    groups: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """Per document: the id, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and `groups`.

    `n_best` counts links whose pair is, by corpus-wide document counts, among the
    most frequent of its A id; `count_sum` adds up these counts over links. `groups`
    holds what the function of that name makes of the text `a1,a2|b1;a3|b2,b3`, which
    is applied before anything is written.
    """
    found = blocks(docs, byte_file, piece_file, id, text)
    kept = F.transform("docs", lambda d: d.withField("groups", groups(d["groups"])))
    written = saved(found.withColumn("docs", kept), "aligned-blocks")
    listed = written.select("block", F.posexplode("pairs").alias("at", "pair"))
    back = listed.select("block", "at", "pair.a", "pair.b").join(pair_counts(written), ["a", "b"])
    per_block = back.groupBy("block").agg(F.collect_list(F.struct("at", "n", "best")).alias("counts"))
    whole = written.select("block", "docs").join(per_block, "block", "left").select("docs", "counts")
    out = T.StructType(
        [T.StructField(NUMBERS[0], docs.schema[id].dataType)]
        + [T.StructField(name, T.LongType()) for name in NUMBERS[1:-1]]
        + [T.StructField(NUMBERS[-1], T.StringType())]
    )
    return whole.mapInArrow(_with_counts, out).withColumnRenamed("id", id)
