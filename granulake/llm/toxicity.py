"""Operator 9: toxicity by a subsequence string-kernel SVM with Nyström landmarks, over sentences.

The kernel of a stretch of text and a landmark sums, over common subsequences of
`ORDER` letters that lie within `SPAN` places, a decay per place spanned. A gap, an
inserted character or a blank inside an insult costs places and lowers a match
instead of losing it. A sentence is compared through its stretches, letter by letter
across blanks: of all stretches of `WINDOW` starting places the worst one speaks for it.
The SVM is linear in the whitened kernels with the landmarks (Nyström), so its decision
is one table of weights by subsequence, and all stretches of a text are decided
in one pass over its letters.

Training. Sentences take the label of their text. Of the labelled rows that are not held
out about `TOXIC_ROWS` and `OTHER_ROWS` are drawn by hash of their id (a documented bound:
their ids alone are broadcast, their texts are not shuffled), and of their distinct
sentences about `SENTENCES` of either label, long ones in overlapping parts. Landmarks are the
words surely likelier in sentences labelled toxic. The SVM is fitted in rounds: each
sentence is shown by its worst stretch so far, and from the second round on each
toxic text by its worst sentence, since most sentences of a toxic text are
harmless. A logistic curve over the two worst sentences of a text, the number of bad
ones and of all, fitted on the drawn rows, makes the score a probability.

Before letters are compared, marks are dropped, spelled-out words (`i d i o t`) are
joined and digits that stand for letters are read as these. The blank counts as a
letter, so the start and end of a word count. Only the text is read by
the score.

Null and empty texts: no sentences, scored by the curve like a text without any bad
one. Null labels: not used; an id labelled twice takes the higher label. Without
toxic or other sentences every score is the share of toxic labels. Repeated
rows: each its own result. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import pieces, saved

ORDER, SPAN, DECAY, WINDOW = 3, 6, 0.5, 8
TOXIC_ROWS, OTHER_ROWS, SENTENCES = 4_000, 12_000, 30_000
LANDMARKS, ROUNDS = 128, 4
#: A telling word: so many times likelier in toxic sentences, or in most of its own; and evidence
#: for that beyond the log of the number of words (all are tested) by so much.
TELLING, SURER = 4.0, 1.0
#: Characters of a training example; longer sentences are shown in parts that overlap by half.
EXAMPLE = 400
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PIECE_BYTES = 500_000
SUBSEQUENCES = 1 << 18

#: A sentence ends at marks before a blank, or at a line end.
END = re.compile(r"[.!?]+(?=\s|$)|\n")
MARK = re.compile(r"[^\w\s]+")
MARK_INSIDE = re.compile(r"(?<=\w)[^\w\s]+(?=\w)")
SPELLED = re.compile(r"(?<!\w)\w(?:\s\w){2,}(?!\w)")
DIGITS = str.maketrans("013457@$", "oieastas")
#: Places between two sentences, so that no subsequence reaches over.
APART = "\0" * (SPAN + WINDOW)
BLANK = 63


def plain(text: str) -> str:
    """Lower case, without marks inside words, spelled-out words joined, digits as letters."""
    low = MARK_INSIDE.sub("", text.lower().translate(DIGITS))
    return SPELLED.sub(lambda found: re.sub(r"\s", "", found.group()), low)


def sentences(text: str) -> list[str]:
    """Sentences as words between single blanks, one before the first and one after the last."""
    words = [MARK.sub("", s).split() for s in END.split(plain(text))]
    return [f" {' '.join(own)} " for own in words if own]


def letter_codes(text: str) -> np.ndarray:
    """Letters as numbers below 64: a to z and the blank on their own, others share what is left; 0 is no letter."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    latin = (points >= 97) & (points <= 122)
    other = np.where(points == 32, BLANK, 27 + points % 36)
    return np.where(latin, points - 96, np.where(points > 0, other, 0)).astype(np.int32)


def subsequences(codes: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """For each way to leave places out: its decay, and the subsequence from every place on; 0 is none."""
    n = len(codes) - SPAN
    for one in range(1, SPAN - 1):
        pair = np.where((codes[:n] > 0) & (codes[one : one + n] > 0), (codes[:n] << 12) | (codes[one : one + n] << 6), 0)
        for two in range(1, SPAN - one):
            third = codes[one + two : one + two + n]
            yield DECAY ** (one + two + 1), np.where((pair > 0) & (third > 0), pair | third, 0)


class Landmarks:
    """Decays of the landmarks' subsequences, scaled so that each one's kernel with itself is 1.

    `at` gives each subsequence its row in `decays` (subsequence, landmark); row 0 is for all others.
    """

    def __init__(self, words: list[str]) -> None:
        held = [[(decay, found) for decay, found in subsequences(letter_codes(f" {word} {APART}"))] for word in words]
        self.codes = np.unique(np.concatenate([[0], *[found for own in held for _, found in own]]))
        self.at = np.zeros(SUBSEQUENCES, dtype=np.int32)
        self.at[self.codes] = np.arange(len(self.codes))
        self.decays = np.zeros((len(self.codes), len(words)), dtype=np.float32)
        for column, own in enumerate(held):
            for decay, found in own:
                np.add.at(self.decays[:, column], self.at[found], decay)
        self.decays[0] = 0
        self.decays /= np.maximum((self.decays**2).sum(axis=0), 1e-12)

    def table(self, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of the landmarks, by subsequence."""
        out = np.zeros(SUBSEQUENCES, dtype=np.float32)
        out[self.codes] = self.decays @ weights
        return out


class Stretches:
    """Sentences one after the other, and the stretches of `WINDOW` places in them."""

    def __init__(self, items: list[str]) -> None:
        self.codes = letter_codes("".join(s + APART for s in items))
        self.ends = np.cumsum(np.fromiter((len(s) + len(APART) for s in items), dtype=np.int64, count=len(items)))
        self.starts = np.concatenate([[0], self.ends[:-1]])

    def worst(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest sum of weights of a stretch of each sentence, and where that stretch starts."""
        density = np.zeros(len(self.codes), dtype=np.float64)
        for decay, found in subsequences(self.codes):
            density[: len(found)] += decay * table[found]
        sums = np.concatenate([[0.0], np.cumsum(density)])
        stretch = sums[np.minimum(np.arange(len(density)) + WINDOW, len(density))] - sums[:-1]
        if not len(self.starts):
            return np.zeros(0), np.zeros(0, dtype=np.int64)
        highest = np.maximum.reduceat(stretch, self.starts)
        hits = np.flatnonzero(stretch == np.repeat(highest, self.ends - self.starts))
        return highest, hits[np.searchsorted(hits, self.starts)]

    def kernels(self, at: np.ndarray, landmarks: Landmarks) -> np.ndarray:
        """Kernels of the stretches that start at `at` with each landmark."""
        out = np.zeros((len(at), landmarks.decays.shape[1]), dtype=np.float32)
        for decay, found in subsequences(self.codes):
            for place in range(WINDOW):
                here = np.minimum(at + place, len(found) - 1)
                out += np.float32(decay) * landmarks.decays[landmarks.at[found[here]]]
        return out


def fit_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared hinge loss with a light ridge, by Newton steps on the rows inside the margin; the bias is last."""
    w, ridge = np.zeros(z.shape[1]), 1e-4 * np.eye(z.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(30):
        inside = y * (z @ w) < 1
        zi, wi = z[inside], weight[inside]
        new = np.linalg.solve(zi.T @ (wi[:, None] * zi) + ridge, zi.T @ (wi * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


@dataclass
class SentenceModel:
    """The decision of a sentence: the weights of its worst stretch's subsequences, plus a bias."""

    table: np.ndarray
    bias: float

    def decide(self, items: list[str]) -> np.ndarray:
        return Stretches(items).worst(self.table)[0] + self.bias


def train(words: list[str], toxic: list[tuple[str, int]], other: list[str]) -> SentenceModel | None:
    """The SVM from landmarks, toxic sentences with the number of their text, and other sentences."""
    if not words or not toxic or not other:
        return None
    landmarks = Landmarks(words)
    unit = landmarks.decays / np.linalg.norm(landmarks.decays, axis=0)
    values, vectors = np.linalg.eigh((unit.T @ unit).astype(np.float64))
    whiten = vectors[:, values > 1e-3] / np.sqrt(values[values > 1e-3])
    text = np.unique([t for _, t in toxic], return_inverse=True)[1]
    bad, good = Stretches([s for s, _ in toxic]), Stretches(other)
    table, bias = landmarks.table(np.ones(len(words))), 0.0
    for round in range(ROUNDS):
        highest, at_bad = bad.worst(table)
        _, at_good = good.worst(table)
        if round:
            most = np.full(text.max() + 1, -np.inf)
            np.maximum.at(most, text, highest)
            at_bad = at_bad[highest >= most[text]]
        z = np.vstack([bad.kernels(at_bad, landmarks), good.kernels(at_good, landmarks)]) @ whiten
        z = np.hstack([z, np.ones((len(z), 1))])
        y = np.concatenate([np.ones(len(at_bad)), -np.ones(len(at_good))])
        w = fit_svm(z, y, np.where(y > 0, 0.5 / len(at_bad), 0.5 / len(at_good)))
        table, bias = landmarks.table(whiten @ w[:-1]), float(w[-1])
    return SentenceModel(table, bias)


def text_features(rows: DataFrame, model: SentenceModel) -> DataFrame:
    """id, held_out and, of the decisions of each text's sentences, their number, the highest, the second and how many are positive."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                found = [sentences(t) for t in piece.column("text").to_pylist()]
                decided = shared.value.decide([s for own in found for s in own])
                # two places more per text, so that each has a worst and a second worst sentence
                counts = np.array([len(own) for own in found], dtype=np.int64)
                text = np.repeat(np.arange(len(found)), counts)
                order = np.lexsort((-decided, text))
                ends = np.cumsum(counts)
                ranked = np.append(decided[order], [-2.0, -2.0])
                first = np.where(counts > 0, ranked[np.minimum(ends - counts, len(decided))], -2.0)
                second = np.where(counts > 1, ranked[np.minimum(ends - counts + 1, len(decided))], -2.0)
                n_bad = np.bincount(text, weights=decided > 0, minlength=len(found)).astype(np.int64)
                columns = [piece.column("id"), piece.column("held_out"), *map(pa.array, (first, second, n_bad, counts))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "first", "second", "n_bad", "n_sentences"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "held_out", "text").mapInArrow(work, f"id {kind}, held_out boolean, first double, second double, n_bad long, n_sentences long")


def examples(rows: DataFrame) -> DataFrame:
    """Text number, label and sentence of labelled texts (id, text, toxic); long sentences in parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                out = []
                for text, toxic, number in zip(*(piece.column(c).to_pylist() for c in ("text", "toxic", "number")), strict=True):
                    for s in dict.fromkeys(sentences(text)):
                        step = EXAMPLE // 2
                        parts = [s] if len(s) <= EXAMPLE else [s[k : k + EXAMPLE] for k in range(0, len(s) - step, step)]
                        out += [(number, toxic, part) for part in parts]
                if out:
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.string()), strict=True)], ["number", "toxic", "sentence"])

    return rows.select(F.xxhash64("id").alias("number"), "toxic", "text").mapInArrow(work, "number long, toxic int, sentence string")


def drawn(df: DataFrame, key: Column, count: int) -> DataFrame:
    """About `count` rows, drawn by hash of their key; all, if there are no more."""
    total = df.count()
    if total <= count:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("drawn")), F.lit(1_000_000)) < int(1_000_000 * count / total))


def telling_words(found: DataFrame) -> list[str]:
    """The words surely likelier in toxic sentences, by evidence."""
    is_bad = F.col("toxic").cast("long")
    words = F.array_distinct(F.regexp_extract_all("sentence", F.lit(r"([\p{L}\p{N}]{3,24})"), 1))
    stats = found.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.sum(is_bad).alias("bad"), F.sum(1 - is_bad).alias("good"))
    stats = saved(stats, "toxic-words")
    shares = found.agg(F.sum(is_bad).alias("bad"), F.count("*").alias("all")).first()
    count = stats.count()
    share = (shares["bad"] + 1) / (shares["all"] + 2)
    n, rate = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    # log likelihood of a word's own share of toxic sentences over the overall one
    evidence = n * (rate * F.log(rate / share) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0))
    known_bad = (rate > TELLING * share) | (rate > (1 + share) / 2)
    sure = stats.where("bad > 0").where(known_bad & (evidence > float(np.log(count + 1)) + SURER))
    return [r.word for r in sure.orderBy(F.desc(evidence), "word").limit(LANDMARKS).collect()]


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def curve_inputs() -> list[Column]:
    clip = lambda c: F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col(c)))
    return [clip("first"), clip("second"), *[F.log1p(F.col(n).cast("double")) for n in ("n_bad", "n_sentences")]]


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a light ridge; the constant is the last weight."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Each row's id, fold, probability and prediction."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out(F.col(id)).alias("held_out"))
    known = labels.select(F.col(label_id).alias("id"), F.col(label).alias("toxic")).where("id is not null and toxic is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = saved(known, "toxic-labels")
    totals = known.groupBy().agg(F.sum("toxic").alias("bad"), F.count("*").alias("all")).first()
    bad, total = int(totals["bad"] or 0), int(totals["all"])

    # a bounded number of ids, whatever the number of labels
    bound = [drawn(known.where(F.col("toxic") == toxic), F.col("id"), count) for toxic, count in ((1, TOXIC_ROWS), (0, OTHER_ROWS))]
    sample = saved(bound[0].unionByName(bound[1]), "toxic-sample")
    # a sentence copied a thousand times says nothing new
    found = examples(rows.where("not held_out").join(F.broadcast(sample), "id"))
    found = found.groupBy("sentence").agg(F.max(F.struct("toxic", "number")).alias("own")).select("sentence", "own.toxic", "own.number")
    found = saved(found, "toxic-sentences")
    shown = [drawn(found.where(F.col("toxic") == toxic), F.col("sentence"), SENTENCES).select("sentence", "number").collect() for toxic in (1, 0)]
    words = telling_words(found) if all(shown) else []
    model = train(words, [(r.sentence, r.number) for r in shown[0]], [r.sentence for r in shown[1]])
    if model is None:
        flat = F.lit(bad / total if total else 0.0)
        return rows.select(F.col("id").alias(id), "held_out", flat.alias("score"), (flat >= THRESHOLD).cast("int").alias("predicted"))

    seen = saved(text_features(rows, model), "toxic-features")
    curve = seen.where("not held_out").join(F.broadcast(sample), "id")
    fitted = curve.select(*[c.alias(f"x{i}") for i, c in enumerate(curve_inputs())], "toxic").collect()
    x, y = (np.array(c, dtype=float) for c in ([r[:-1] for r in fitted], [r[-1] for r in fitted]))
    w = fit_curve(x, y)
    # toxic rows were drawn more often than others: back to their share among the labels
    drawn_bad = max(float(y.sum()), 1.0)
    drawn_good = max(len(y) - float(y.sum()), 1.0)
    w[-1] += np.log(max(bad, 1) / max(total - bad, 1)) - np.log(drawn_bad / drawn_good)
    logit = sum((c * float(v) for c, v in zip(curve_inputs(), w, strict=False)), F.lit(float(w[-1])))
    probability = 1 / (1 + F.exp(-logit))
    return seen.select(
        F.col("id").alias(id), "held_out", probability.alias("score"), (probability >= THRESHOLD).cast("int").alias("predicted"), "n_bad", F.col("first").alias("worst")
    )
