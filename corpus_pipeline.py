"""From raw documents to encoded training text: five stages, each written and read again.

1. Language identification: documents whose language is not known go.
2. Jaccard join: of each group of near copies (0.8 of their five-word shingles in common)
   the first document stays.
3. Suffix-array dedup: strings of 200 bytes found more than once go from the texts.
4. Benchmark decontamination: documents that hold a benchmark item go.
5. BPE encoding and decoding: token ids of each text, and the text they stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granulake.llm import bpe, decontamination, jaccard_join, language, suffix_dedup
from granulake.llm.common import saved, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, n=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`n_chars` follows the text."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # the workers of the earlier stages are still there, so fewer words are remembered than alone
    coded = bpe.encode_decode(
        docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), known_words=100_000
    )
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

#: The first stage's learned model and the last stage's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
