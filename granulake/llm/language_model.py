"""Operator 7: language-model scores by a log-bilinear model.

Tokens are the lower-cased words of a text and one end. The `TOP` most frequent words
and the end are classes of their own; all other words share `TAILS` classes by
their last two characters. The model gives the class by the class before it:
log P(c | b) = r_b . q_c + bias_c - log Z(b), with Z summed over all classes in one
matrix product, so probabilities are normalised. Within a shared class a word has
(c + 1) / (N + V + 1) of the class's own counts.

* Counts of all training words are a grouped sum over the whole corpus. The
  words above the least count that at most `KNOWN` words reach are sent to the tasks (a fixed
  bound); the counts of all rarer words stay in Spark and meet the rarer tokens by a join.
* Class pairs are counted over all training texts into at most classes ** 2 sums,
  and the embeddings are trained on them in numpy by noise-contrastive
  estimation, starting from the unigram model.

Null and empty texts: one token, the end. Null id: counted as training, scored like
any other. Repeated rows count and are scored each. Empty table: no rows. Without
training texts every word is unknown and class probabilities are even. Other
columns are not read.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import pieces, saved, words

KNOWN = 200_000
TOP, TAILS = 512, 512
DIM = 32
#: Stochastic gradient steps, pairs and noise classes of each.
STEPS, BATCH, NOISE, RATE = 400, 4096, 256, 0.1
FOLDS, HELD_OUT = 7, 2
PIECE_BYTES = 2_000_000


def tail_class(word: bytes) -> int:
    return TOP + zlib.crc32(word.decode()[-2:].encode()) % TAILS


def tail_class_column(word: Column) -> Column:
    return F.lit(TOP) + F.crc32(F.right(word, F.lit(2)).cast("binary")) % TAILS


@dataclass
class Lexicon:
    """What tasks know of words; classes: top words, shared ones, and the end last."""

    place: dict[bytes, int]
    classes: np.ndarray
    base: np.ndarray
    within: np.ndarray
    class_floor: np.ndarray
    base_floor: float
    end_base: float
    end_known: bool
    tokens: int


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def lower_words(text: Column) -> Column:
    return words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n, class) of all training texts, written once."""
    found = training.select(F.explode(lower_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return saved(found.withColumn("class", tail_class_column(F.col("word")).cast("int")), "word-counts")


def least_count(counts: DataFrame) -> int:
    """The least count that no more than `KNOWN` words reach, from how many words have each count."""
    many = 1 << 20  # counts from here on are one, so the driver gets no more numbers than that
    found = counts.groupBy(F.least("n", F.lit(many)).alias("n")).agg(F.count("*").alias("words")).toPandas()
    found = found.sort_values("n", ascending=False)
    fits = found["n"][found["words"].cumsum() <= KNOWN]
    return int(fits.min()) if len(fits) else many * many


def lexicon(counts: DataFrame, texts: int) -> tuple[Lexicon, DataFrame]:
    """The tasks' lexicon, and the counts of the words that are not in it."""
    least = least_count(counts)
    top = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    sums = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    tokens = int(sums["n"].sum()) + texts
    base_log = np.log10(tokens + int(sums["v"].sum()) + (texts > 0) + 1)
    n = top["n"].to_numpy(dtype=np.float64)
    classes = top["class"].to_numpy(dtype=np.int32, copy=True) if len(top) else np.empty(0, np.int32)
    share = np.zeros(TOP + TAILS + 1)
    kinds = np.zeros(TOP + TAILS + 1)
    share[sums["class"].astype(int)], kinds[sums["class"].astype(int)] = sums["n"], sums["v"]
    own = min(TOP, len(top))
    np.subtract.at(share, classes[:own], n[:own])
    np.subtract.at(kinds, classes[:own], 1)
    classes[:own] = np.arange(own)
    floor = -np.log10(share + kinds + 1)
    within = np.log10(n + 1) + floor[classes]
    within[:own] = 0
    place = {w.encode(): i for i, w in enumerate(top["word"])}
    known = Lexicon(place, classes, np.log10(n + 1) - base_log, within, floor, -base_log, np.log10(texts + 1) - base_log, texts > 0, tokens)
    return known, counts.where(F.col("n") < least)


def coded(batch: pa.RecordBatch, known: Lexicon) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Slices of a batch with each token's place in the lexicon (-1: not in it, -2: end), its class, row ends and all words."""
    of = known.place
    for piece in pieces(batch, "text", PIECE_BYTES):
        rows = [t.encode().lower().split() for t in piece.column("text").to_pylist()]
        ends = np.cumsum([len(r) + 1 for r in rows])
        all_words = list(chain.from_iterable((*r, b"\n") for r in rows))
        place = np.fromiter((of.get(w, -1) for w in all_words), dtype=np.int64, count=len(all_words))
        place[ends - 1] = -2
        kinds = np.full(len(place), TOP + TAILS, dtype=np.int64)
        kinds[place >= 0] = known.classes[place[place >= 0]]
        for i in np.flatnonzero(place == -1).tolist():
            kinds[i] = tail_class(all_words[i])
        yield piece, place, kinds, ends, all_words


def before(kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class before each token; the end stands before a text's first."""
    out = np.concatenate([[TOP + TAILS], kinds[:-1]])
    out[ends[:-1]] = TOP + TAILS
    return out


def pair_counts(training: DataFrame, known) -> np.ndarray:
    """How often each class follows each, over all training texts; at most classes ** 2 sums reach the driver."""
    size = TOP + TAILS + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for _, _, kinds, ends, _ in coded(batch, known.value):
                total += np.bincount(before(kinds, ends) * size + kinds, minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])

    sums = training.select("text").mapInArrow(work, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size)
    out[sums["cell"].to_numpy(dtype=np.int64)] = sums["n"]
    return out.reshape(size, size)


def train(pairs: np.ndarray, seed: int = 7) -> np.ndarray:
    """Log10 P(class | class before), trained by noise-contrastive estimation on the pair counts."""
    size = len(pairs)
    draw = np.random.default_rng(seed)
    unigram = pairs.sum(axis=0) + 0.5
    unigram /= unigram.sum()
    context = draw.normal(0, 0.1, (size, DIM))
    target = draw.normal(0, 0.1, (size, DIM))
    bias = np.log(unigram)
    if pairs.sum() == 0:
        return np.tile(np.log10(unigram), (size, 1))
    grown = [np.full_like(x, 1e-3) for x in (context, target, bias)]
    cells, noise_steps = np.cumsum(pairs.ravel()), np.cumsum(unigram)
    noise_log = np.log(NOISE * unigram)

    def step(values: np.ndarray, past: np.ndarray, at: np.ndarray, gradient: np.ndarray) -> None:
        full = np.zeros_like(values)
        np.add.at(full, at, gradient)
        past += full * full
        values += RATE * full / np.sqrt(past)

    for _ in range(STEPS):
        drawn = np.searchsorted(cells, draw.random(BATCH) * cells[-1], side="right")
        b, c = drawn // size, drawn % size
        noise = np.minimum(np.searchsorted(noise_steps, draw.random(NOISE)), size - 1)
        r = context[b]
        true = 1 - 1 / (1 + np.exp(-((r * target[c]).sum(axis=1) + bias[c] - noise_log[c])))
        false = -1 / (1 + np.exp(-(r @ target[noise].T + bias[noise] - noise_log[noise])))
        of_context = true[:, None] * target[c] + false @ target[noise]
        of_target = np.concatenate([true[:, None] * r, false.T @ r])
        at = np.concatenate([c, noise])
        step(context, grown[0], b, of_context)
        step(target, grown[1], at, of_target)
        step(bias, grown[2], at, np.concatenate([true, false.sum(axis=0)]))
    logits = context @ target.T + bias
    logits -= logits.max(axis=1, keepdims=True)
    return (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))) / np.log(10)


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id, fold, token counts, unigram score and model score (log10)."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out(F.col(id)).alias("held_out"))
    training = rows.where("not held_out").select("text")
    counts = word_counts(training)
    known, rare = lexicon(counts, training.count())
    shared = context.broadcast(known)
    logs = context.broadcast(train(pair_counts(training, shared)).astype(np.float32))
    tokens = known.tokens

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, table = shared.value, logs.value
        for batch in batches:
            for piece, place, kinds, ends, all_words in coded(batch, lex):
                begin = np.concatenate([[0], ends[:-1]])
                at = np.maximum(place, 0)
                listed, missing = place >= 0, place == -1
                base = np.full(len(place), lex.base_floor)
                model = table[before(kinds, ends), kinds].astype(np.float64)
                if len(lex.base):
                    base[listed] = lex.base[at[listed]]
                    model[listed] += lex.within[at[listed]]
                model[missing] += lex.class_floor[kinds[missing]]
                base[place == -2] = lex.end_base
                of_known = listed | ((place == -2) & lex.end_known)
                rest = [[all_words[i].decode() for i in (np.flatnonzero(missing[a:b]) + a).tolist()] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
                columns = [
                    piece.column("id"), piece.column("held_out"), pa.array(ends - begin, pa.int64()), pa.array(np.add.reduceat(of_known.astype(np.int64), begin)),
                    pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(model, begin)), pa.array(rest, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "base", "model", "rest"])

    kind = rows.schema["id"].dataType.simpleString()
    parts = rows.mapInArrow(work, f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rest array<string>")
    # the number is written with the row, so it stays the same however often it is read
    parts = saved(parts.withColumn("row", F.monotonically_increasing_id()), "score-parts")
    found = parts.select("row", F.explode("rest").alias("word")).join(rare.select("word", "n"), "word", "left")
    more = found.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more"), F.count("n").alias("met"))
    done = parts.drop("rest").join(more, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return done.select(
        F.col("id").alias(id), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + extra).alias("base_score"), (F.col("model") + extra).alias("score"),
    )
