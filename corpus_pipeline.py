"""The stages of a training corpus, each over all its predecessor kept.

Null, empty and blank texts fail the quality rules, so no later stage has one. Very long
texts pass whole through every stage; suffix dedup and packing read them in parts. Of
rows that tie or repeat, the exact stage keeps the one with the smallest doc_id; a null
doc_id comes last. Columns of the input keep their names and values through all stages
but the last, also where operators have columns of those names, and only ``text``
changes, in suffix dedup. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import exact, minhash, packing, quality, suffix
from newsloom.llm.common import documents, landed


#: Bytes of a repeated passage that the corpus loses: 51 words of four letters and a space.
PASSAGE_BYTES = 256


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the quality rules."""
    return quality.filtered(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return minhash.deduplicated(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of ``PASSAGE_BYTES`` or more that repeat."""
    return suffix.deduplicated(docs, PASSAGE_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every segment of every document, by its tokens."""
    return packing.packed(docs, path=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("packing", pack),
]

#: Several stages have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
