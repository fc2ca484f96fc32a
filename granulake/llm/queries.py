"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granulake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def hex_digest(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.quality import judged

    return judged(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.decontamination import contaminated

    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.language import of_documents

    return of_documents(table(spark, sf, "documents"))


def language_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Markup, address and host evidence, with text likelihoods learned from the documents."""
    from granulake.llm.language import model, of_pages

    return of_pages(table(spark, sf, "pages"), model(table(spark, sf, "documents").select("lang", "text").where("text is not null")))


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from granulake.llm.bpe import encode_decode

    coded = encode_decode(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.substring_dedup import dedup

    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    done = dedup(table(spark, sf, "documents"))
    return done.select("doc_id", "n_words", removed.alias("n_removed"), hex_digest(F.col("kept")).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.suffix_dedup import cut_repeats

    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    done = cut_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select(
        "row.doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


def op7_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.language_model import score

    return score(table(spark, sf, "documents"))


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.licenses import scan

    found = scan(table(spark, sf, "documents"))
    return found.withColumns({n: F.array_join(n, " ") for n in ("sentence_ids", "licenses")})


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.toxicity import score

    return score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.jaccard_join import joined

    return joined(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    from granulake.llm.lexical_search import ranked

    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from granulake.llm.sentence_pieces import encode_decode

    coded = encode_decode(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from granulake.llm.alignment import aligned

    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    hashed = aligned(
        table(spark, sf, "documents"), *files, groups=lambda text: F.when(text == "", "").otherwise(hex_digest(text))
    )
    return hashed.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Query]:
    return {name: value for name, value in globals().items() if name.startswith(("op", "language_")) and callable(value)}
