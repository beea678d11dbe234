"""A training corpus from the documents: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import storage
from tripmill.llm import decontaminate, language_id, sentencepiece_codec, simhash, suffix_dedup
from tripmill.llm.shared import scratch, table, tokenizer_file
from tripmill.session import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose best language has less than this share is rejected.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that their labels teach; those without a letter, or of no clear language, go."""
    model = language_id.train(docs, F.lit(True))
    found = language_id.predict(docs, model)
    clear = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
    return found.where(clear).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.keep_one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that start more than once among the documents left."""
    return suffix_dedup.without_repeats(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    model = tokenizer_file()
    coded = sentencepiece_codec.encode(docs, model, exact="round_trip")
    n_tokens = F.size("token_ids").cast("long").alias("n_tokens")
    return coded.select("doc_id", "lang", "source", n_tokens, "token_ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("benchmark_decontamination", drop_test_items),
    ("sentencepiece", tokenize),
]

#: SQL can't express the stages; tests/llm compares them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's rows written to the shared folder and read again.

    What a stage has written on its way goes when its rows are there, and these go when the next stage's are.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        with scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(folder)
        docs = spark.read.schema(found.schema).parquet(folder)
        if before is not None:
            storage.remove(spark, before)
        before = folder
    return docs
