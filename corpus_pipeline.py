"""From raw documents to packed training sequences.

Six stages, each a function of (spark, docs, sf_dir) on all that the stage before kept. All but the last
return the columns of documents; what a stage returns is written as Parquet and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.llm.common import read, stage
from hearthlift.llm.exact_dedup import without_copies
from hearthlift.llm.near_copies import without_near_copies
from hearthlift.llm.packing import pack
from hearthlift.llm.quality_rules import passing
from hearthlift.llm.suffix_index import WORDS, cut_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and repetition rules reject go."""
    return passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lowered) the document with the largest id stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 or more (five-word shingles) the one with the smallest id stays."""
    return without_near_copies(docs)


def _counted_again(cut: DataFrame) -> DataFrame:
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))


def word_passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words found elsewhere are cut out, however short; every document stays."""
    return _counted_again(cut_documents(docs, unit=WORDS))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes or more found elsewhere are cut out; every document stays."""
    return _counted_again(cut_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("word-passage dedup", word_passage_dedup),
    ("suffix-array dedup", passage_dedup),
    ("packing", packing),
]

# Fingerprints by XXH64 and token ids are not to be had in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
