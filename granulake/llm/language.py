"""Operator 3: language identification by Bayesian evidence fusion.

For each text and language, the log likelihood of the text is added to that of a
declared markup language and of an address suffix, and to the log prior of the
host; the posterior over all languages and "unknown" decides.

* Text: byte trigrams in `BUCKETS` hash buckets, counted per declared language over
  all rows (a sum of fixed-size tables) and smoothed; "unknown" spreads evenly over
  the buckets. Neighbouring trigrams are not independent, so evidence counts `TEMPER`.
* Declaration and suffix: right with a given probability, else any other language.
* Host: counts of the text's own best language by host, smoothed towards the
  host's domain, and that towards all rows. Grouped sums; a host that holds a third of
  the rows is added up before it is shuffled, and the join back can be split.

A row is kept if its best language is known and has at least `SURE`.

Null and empty texts, and texts without letters: unknown, not kept. Null declaration
or suffix: no evidence. Null host: a host of its own. Rows without id are
judged as others are. Repeated rows: each its own result. Empty tables: no rows. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import arrow_batches, pieces, saved
from granulake.llm.suffix_dedup import raw

BUCKETS = 8192
TEMPER = 0.25
DECLARED_RIGHT = 0.9
SUFFIX_RIGHT = 0.7
#: Weight, in rows, of a domain's prior for its hosts, and of the overall one for domains.
HOST_WEIGHT = 20.0
UNKNOWN, UNKNOWN_PRIOR = "und", 0.01
SURE = 0.5
PIECE_BYTES = 1_000_000
#: Of rows given to Python at once. A row is never cut.
BATCH_BYTES = "4m"


def _letters() -> np.ndarray:
    """Each byte as it counts: ASCII letters in lower case, bytes of other letters as they are, the rest a gap."""
    out = np.zeros(256, dtype=np.uint32)
    out[128:] = np.arange(128, 256)
    for letter in range(ord("a"), ord("z") + 1):
        out[letter] = out[letter - 32] = letter
    return out


LETTERS = _letters()


def trigrams(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bucket of each trigram (BUCKETS: no letter in it) and where each row ends.

    A row is followed by two gaps, so every byte of it starts a trigram.
    """
    for piece in pieces(batch, "text", PIECE_BYTES):
        data, ends = raw(piece.column("text"))
        row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        spaced = np.zeros(len(data) + 2 * len(ends) + 2, dtype=np.uint32)
        spaced[np.arange(len(data)) + 2 * row] = LETTERS[data]
        code = (spaced[:-2] << np.uint32(16)) | (spaced[1:-1] << np.uint32(8)) | spaced[2:]
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int32)
        bucket[code == 0] = BUCKETS
        ends = ends + 2 * np.arange(1, len(ends) + 1)
        bucket[ends - 1] = bucket[ends - 2] = BUCKETS  # the gaps themselves
        yield piece, bucket, ends


def counted(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of (lang, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece, bucket, ends in trigrams(batch):
                langs = piece.column("lang").dictionary_encode()
                which = np.repeat(langs.indices.to_numpy(), np.diff(ends, prepend=0)).astype(np.int64)
                names = langs.dictionary.to_pylist()
                sums = np.bincount(which * (BUCKETS + 1) + bucket, minlength=len(names) * (BUCKETS + 1)).reshape(len(names), -1)
                for name, n in zip(names, sums, strict=True):
                    totals[name] = totals.get(name, 0) + n[:BUCKETS]
        for name, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])

    parts = docs.where("lang is not null").mapInArrow(work, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log probabilities (language, bucket); the last row is "unknown", the last column no letter.

    What comes to the driver is at most `BUCKETS` counts per declared language.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        table = counted(docs).toPandas()
    langs = sorted(set(table["lang"]) - {UNKNOWN})
    logs = np.zeros((len(langs) + 1, BUCKETS + 1), dtype=np.float32)
    for i, lang in enumerate(langs):
        counts = np.zeros(BUCKETS)
        own = table[table["lang"] == lang]
        counts[own["bucket"].to_numpy()] = own["n"].to_numpy()
        logs[i, :BUCKETS] = np.log((counts + 0.5) / (counts.sum() + 0.5 * BUCKETS))
    logs[-1, :BUCKETS] = -np.log(BUCKETS)
    return langs, logs


def text_evidence(rows: DataFrame, logs: np.ndarray) -> DataFrame:
    """The rows of (id, host, domain, declared, suffix, text) with the log likelihood of each language instead of the text."""
    names = ["id", "host", "domain", "declared", "suffix"]
    shared = rows.sparkSession.sparkContext.broadcast(logs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for piece, bucket, ends in trigrams(batch):
                begin = np.concatenate([[0], ends[:-1]])
                sums = np.zeros((len(ends), len(table)))
                for i, row in enumerate(table):
                    sums[:, i] = np.add.reduceat(row[bucket].astype(np.float64), begin)
                letters = np.add.reduceat((bucket < BUCKETS).astype(np.int64), begin)
                offsets = pa.array(np.arange(len(ends) + 1) * len(table), pa.int32())
                columns = [*[piece.column(n) for n in names], pa.ListArray.from_arrays(offsets, pa.array(sums.ravel())), pa.array(letters)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "evidence", "n_trigrams"])

    fields = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.select(*names, "text").mapInArrow(work, f"{fields}, evidence array<double>, n_trigrams long")


def best_of(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)).cast("int")


def host_priors(rows: DataFrame, size: int) -> DataFrame:
    """(host, prior): log prior of each language for each host, from (host, domain, best)."""
    number = [F.sum((F.col("best") == i + 1).cast("double")).alias(f"n{i}") for i in range(size)]
    hosts = saved(rows.groupBy("host", "domain").agg(*number), "host-counts")
    names = [f"n{i}" for i in range(size)]
    overall = hosts.agg(*[F.coalesce(F.sum(n), F.lit(0.0)) for n in names]).first()
    whole = [(n + 1.0) / (sum(overall) + size) for n in overall]
    domains = hosts.groupBy("domain").agg(*[F.sum(n).alias(f"d{i}") for i, n in enumerate(names)])
    total_d = sum((F.col(f"d{i}") for i in range(size)), F.lit(0.0))
    domains = domains.select("domain", *[((F.col(f"d{i}") + HOST_WEIGHT * whole[i]) / (total_d + HOST_WEIGHT)).alias(f"p{i}") for i in range(size)])
    total_h = sum((F.col(n) for n in names), F.lit(0.0))
    prior = [F.log((F.col(n) + HOST_WEIGHT * F.col(f"p{i}")) / (total_h + HOST_WEIGHT)) for i, n in enumerate(names)]
    return hosts.join(domains, "domain").select("host", "domain", F.array(*prior).alias("prior"))


def told(value: Column, langs: list[str], right: float) -> Column:
    """Log likelihood of a declared value under each language; nothing if it names none of them."""
    wrong = (1 - right) / max(1, len(langs) - 1)
    each = [F.when(value == lang, F.log(F.lit(right))).otherwise(F.log(F.lit(wrong))) for lang in langs]
    even = [F.lit(0.0)] * (len(langs) + 1)
    unknown = F.log(F.lit(1.0 / max(1, len(langs))))
    return F.when(value.isin(langs), F.array(*each, unknown)).otherwise(F.array(*even))


def identify(rows: DataFrame, trained: tuple[list[str], np.ndarray]) -> DataFrame:
    """id, lang, posterior, text_lang, kept for rows of (id, text, declared, suffix, host, domain)."""
    langs, logs = trained
    names = F.array(*[F.lit(x) for x in [*langs, UNKNOWN]])
    size = len(langs) + 1
    hosted = rows.withColumns({n: F.coalesce(n, F.lit("")) for n in ("host", "domain", "text")})
    with arrow_batches(rows.sparkSession, BATCH_BYTES):
        seen = saved(text_evidence(hosted, logs), "text-evidence")
    start = F.array(*[F.lit(float(np.log((1 - UNKNOWN_PRIOR) / max(1, len(langs)))))] * len(langs), F.lit(float(np.log(UNKNOWN_PRIOR))))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    text = plus(F.transform("evidence", lambda x: x * TEMPER), start)
    seen = seen.withColumn("text_score", text).withColumn("best", best_of(F.col("text_score")))
    priors = host_priors(seen.where("n_trigrams > 0"), size)
    met = seen.join(priors, ["host", "domain"], "left")
    prior = F.coalesce("prior", F.array(*[F.lit(0.0)] * size))
    score = plus(plus(F.col("text_score"), prior), plus(told(F.col("declared"), langs, DECLARED_RIGHT), told(F.col("suffix"), langs, SUFFIX_RIGHT)))
    met = met.withColumn("score", score).withColumn("at", best_of(F.col("score")))
    total = F.aggregate("score", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("score")))
    none = F.col("n_trigrams") == 0
    lang = F.when(none, UNKNOWN).otherwise(F.element_at(names, F.col("at")))
    sure = F.when(none, 0.0).otherwise(1 / total)
    return met.select(
        "id", lang.alias("lang"), sure.alias("posterior"), F.when(none, UNKNOWN).otherwise(F.element_at(names, F.col("best"))).alias("text_lang"),
        ((lang != UNKNOWN) & (sure >= SURE)).alias("kept"),
    )


def of_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """Documents: declared language and source are at hand, an address is not."""
    rows = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.lower(declared).alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col(host).alias("host"), F.col(host).alias("domain"),
    )
    learned = model(docs.select(F.lower(declared).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    return identify(rows, learned).withColumnRenamed("id", id)


def of_pages(pages: DataFrame, trained: tuple[list[str], np.ndarray]) -> DataFrame:
    """Web pages: markup language, address suffix (country or first path part), and host."""
    plain = F.regexp_replace(F.regexp_replace("html", "(?s)<(script|style)[^>]*>.*?</\\1>|<!--.*?-->", " "), "<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/:?#]+)", 1))
    path = F.regexp_extract("url", "^[a-zA-Z]+://[^/]+/([a-z]{2})(/|$)", 1)
    suffix = F.when(path.isin(trained[0]), path).otherwise(F.substring_index(host, ".", -1))
    rows = pages.select(
        F.col("page_id").alias("id"), plain.alias("text"), F.lower(F.regexp_extract("html", "(?i)<html[^>]*\\blang=[\"']?([a-z]{2})", 1)).alias("declared"),
        suffix.alias("suffix"), host.alias("host"), F.substring_index(host, ".", -3).alias("domain"),
    )
    return identify(rows, trained).withColumnRenamed("id", "page_id")


def known_language(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is known."""
    read = [x for n in (text, "lang", "source") for x in (F.col(n).isNull(), F.col(n))]
    # never null: rows without id, or with one id, are told apart by all that is read of them
    key = F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), F.xxhash64(F.col(id).isNull(), *read))
    kept = of_documents(docs.withColumn("__key", key), "__key", text).where("kept").select(F.col("__key").alias("__kept_key"))
    kept = saved(kept.distinct(), "known-language")
    return docs.join(kept, key == F.col("__kept_key"), "left_semi")
