"""Operator 5: substring dedup over windows of words.

Rabin-Karp hashes of every window of `length` consecutive words; a word goes if a
window that covers it also starts in a row of smaller id. Windows are judged on
the input. How windows are counted is told in `repeats`; what is removed is given
as maximal intervals.

Words are separated by ASCII white space and otherwise taken as they are. Null and
empty texts, and texts shorter than a window, lose nothing. Ids may be of any type
that has an order. Rows of one id follow each other by text (the first of repeated
rows keeps its words), rows without id come after all others. Other columns are
not read, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import keyed_rows, words
from granulake.llm.repeats import covered, maximal, repeated_spans

LENGTH = 50
#: Words of an anchor gram.
GRAM = 12
#: Windows decided together.
BLOCK = 6
#: Words handled at a time.
PIECE_WORDS = 500_000


def word_tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, word hashes in a row and row ends, for groups of rows."""
    column = batch.column("tokens")
    ids = batch.column("id").to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ids):
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + PIECE_WORDS, side="right")))
        yield ids[start:stop], flat[base : int(ends[stop - 1])], ends[start:stop] - base
        start = stop


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Each row's key and words, kept text, and removed intervals (first word, word after the last)."""
    numbered = keyed_rows(docs, id, text, "__key")
    keyed = numbered.select(F.col("__key").alias("id"), F.col(f"`{id}`").alias("own_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("tokens")
    prepare = lambda rows: rows.select(hashes, *[n for n in rows.columns if n != "text"])
    spans = repeated_spans(keyed.select("id", "text"), prepare, word_tokens, length, gram, BLOCK, earlier=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, counts = [], [], []
            for body, span in zip(batch.column("text"), batch.column("spans"), strict=True):
                all_words = body.as_py().encode().split()
                gone = []
                if span.is_valid:
                    mask = covered(span.values, length, len(all_words))
                    gone = maximal(mask)
                    all_kept = [w for w, m in zip(all_words, mask.tolist(), strict=True) if not m]
                else:
                    all_kept = all_words
                counts.append(len(all_words))
                kept.append(b" ".join(all_kept).decode())
                removed.append([{"start": a, "stop": b} for a, b in gone])
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [batch.column("own_id"), pa.array(counts, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, spans_type)]
            yield pa.RecordBatch.from_arrays(columns, ["own_id", "n_words", "kept", "removed"])

    schema = f"own_id {docs.schema[id].dataType.simpleString()}, n_words long, kept string, removed array<struct<start:long,stop:long>>"
    done = keyed.join(spans, "id", "left").select("own_id", "text", "spans").mapInArrow(cut, schema)
    return done.withColumnRenamed("own_id", id)
