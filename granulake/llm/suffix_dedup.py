"""Operator 6: suffix-array dedup over bytes.

Suffixes are ordered only through `length` bytes, by most-significant-digit radix
passes that split groups and drop those with one member: what is left at full
depth are exactly the repeated strings of `length` bytes. A byte is removed if
such a string covers it, wherever else it starts, in the same text too; strings are
judged on the input and never cross texts.

The passes are grouped counts in Spark (`repeats`): the first digit is a gram of
the window, the next a stretch around it, the last the window itself, taken only
for groups still undecided. Suffixes with consecutive starts travel as one row, so
the table is about a hundredth of the number of suffixes, and no group is gathered
in one task.

Null text: empty. Texts shorter than a window lose nothing. Rows may have any id, or
none, or share one: each row is a text of its own, so repeated rows are copies of
each other and both lose what they share. Removed runs may cut a character;
the kept text as bytes is `kept`. Other columns pass through `without_repeats`.
Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import keyed_rows, pieces, saved, with_mark
from granulake.llm.repeats import MIX, covered, maximal, mixed, repeated_spans

LENGTH = 200
#: Bytes of an anchor gram.
GRAM = 60
#: Windows decided together.
BLOCK = 16
#: Bytes handled at a time; hashes take about eighty times as much memory.
PIECE_BYTES = 250_000

BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MIX))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values in a row, and where each value ends."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, dtype=np.uint8), at[1:] - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at[1:] - at[0]


def byte_tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, byte values in a row and row ends, for groups of rows."""
    for piece in pieces(batch, "text", PIECE_BYTES):
        data, ends = raw(piece.column("text"))
        yield piece.column("id").to_numpy(), BYTE_VALUES[data], ends


def cut_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, as_text: bool = False
) -> DataFrame:
    """Each row with its number of bytes, what is kept, and the removed spans (first byte, byte after the last).

    What is kept is bytes, or with `as_text` a text without the characters that were cut.
    """
    numbered = keyed_rows(docs, id, text, "__key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = numbered.select(F.col("__key").alias("id"), row.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(keyed.select("id", "text"), lambda rows: rows, byte_tokens, length, gram, BLOCK, earlier=False)

    # the text is handed over once, within its row
    place = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            batch = batch.append_column("text", batch.column("row").field(place).fill_null(""))
            for piece in pieces(batch, "text", 2 * PIECE_BYTES):
                data, ends = raw(piece.column("text"))
                begin, kept, removed, counts = 0, [], [], []
                for end, span in zip(ends.tolist(), piece.column("spans"), strict=True):
                    own, gone = data[begin:end], []
                    if span.is_valid:
                        mask = covered(span.values, length, len(own))
                        gone, own = maximal(mask), own[~mask]
                    counts.append(end - begin)
                    kept.append(own.tobytes().decode("utf-8", "ignore") if as_text else own.tobytes())
                    removed.append([{"start": a, "stop": b} for a, b in gone])
                    begin = end
                columns = [piece.column("row"), pa.array(counts, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, spans_type)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_bytes", "kept", "removed"])

    schema = f"row {keyed.schema['row'].dataType.simpleString()}, n_bytes long, kept {'string' if as_text else 'binary'}, removed array<struct<start:long,stop:long>>"
    # rows without spans stay where they are
    spans = saved(spans, "spans")
    marked = with_mark(keyed.select("id", "row"), spans, "__cut")
    met = marked.where("__cut").join(spans, "id", "left").select("row", "spans")
    rest = marked.where("not __cut").select("row", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return met.unionByName(rest).mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their columns, each text without its repeated strings; cut characters are left out."""
    done = cut_repeats(docs, id, text, as_text=True)
    left = F.when(F.size("removed") == 0, F.col(f"row.`{text}`")).otherwise(F.col("kept"))
    return done.select(*[left.alias(text) if n == text else F.col(f"row.`{n}`") for n in docs.columns])
