"""The corpus pipeline: raw documents in, packed training windows out.

Every stage works on all rows that its predecessor kept. All but the last return the
columns of ``documents``; the last returns the pieces of the packed windows.

Every stage takes nulls in any column, empty and very long texts (always whole), repeated
rows, an empty table (the result is empty) and further columns of any name, which pass
through unread up to packing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import pii, quality
from adjudica.llm.base import shared_folder, table
from adjudica.llm.exact import drop_exact_copies
from adjudica.llm.near import drop_near_copies
from adjudica.llm.packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels that are not held out, does not reject.

    Null and empty texts score alike and go or stay together; a score at the threshold stays.
    """
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    The one with the most characters stays, then the smallest id. Null, empty and blank texts
    are one group; of rows that repeat id and text one stays.
    """
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity 0.8 or more.

    The smallest id stays. Null ids and texts without words stay; rows that repeat an id stay
    or go together.
    """
    return drop_near_copies(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; ``n_chars`` follows the text.

    Null texts stay null, with a null ``n_chars``.
    """
    return pii.redact(docs, pii.learn(docs)).withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens: one row per piece with its ids.

    Null and empty texts are one end token each; repeated rows are packed each for itself.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", redact_personal_data),
    ("packing", packing),
]

#: SQL cannot express the classifier, the tagger or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
