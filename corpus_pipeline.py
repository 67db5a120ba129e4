"""Corpus preparation: documents whose language is known, one of each group of near copies, without benchmark passages and personal
data, mixed to target weights. Each stage works on all that the one before kept.

Every stage takes any table with the columns of documents, and further columns of any name, which stay as they are (``mix`` replaces those that it adds itself). An
empty table gives an empty one; a null id, language or source takes part; what null and empty texts and rows that repeat come to is said at each stage. All but
the last return the columns that they were given, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm import decontaminate, langid, mixing, pii, simhash
from fieldlens.llm.queries import MIX_LEVELS, MIX_WEIGHTS, with_domain
from fieldlens.llm.shared import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that holds two fifths of their words go; so do null texts and those without a letter. Rows that repeat stay or go together.
    Learned from all rows with a language; without any, nothing goes."""
    return langid.recognised(docs, langid.train(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within two bits the document with the smallest id stays (a null id is the largest, ties go by the text's hash, then by the other columns). Texts
    without a word, null ones included, share the fingerprint zero and are copies of each other; of rows that repeat one stays."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of a benchmark item go. Null, empty and short texts hold none and stay; rows that repeat stay or go together; items without
    a word are in no text."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), share=0.8, words=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; ``n_chars`` follows the text, and stays where the text is null. Every row stays, repeated ones too."""
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights select, a row for each epoch, with the tokens taken of each. Texts without a word have no tokens and are not selected; a
    null language or source is a node of its own; rows that repeat (id, text) count once, the first by their other columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain = docs.drop("domain")
    chosen = mixing.select(plain, MIX_LEVELS, MIX_WEIGHTS, attach=lambda rows: with_domain(rows, labels))
    return mixing.selected(plain, chosen, also=("domain",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mix", mix),
]

#: Stages with trained models have no SQL; the stages' operators are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
