"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import collocations, crossentropy, exact, idfiles, language, lexicon, minhash, packing, prefixjoin, quality, suffix, transducer, whitening
from newsloom.llm.common import documents

#: The id that ends each document in the id files.
END_ID = 2


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.spans_removed(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.classes(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.cross_checked(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = crossentropy.good_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return crossentropy.scored(documents(spark, sf_dir), good, path=public_tokenizers.path("byte_bpe_50k.json"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), path=public_tokenizers.path("byte_bpe_50k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = idfiles.write(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return idfiles.read(manifest)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked(documents(spark, sf_dir), 4)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(documents(spark, sf_dir))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixjoin.linked(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_cross_entropy": op6_cross_entropy,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_files": op9_token_files,
    "op10_minhash": op10_minhash,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_ngram_join": op13_ngram_join,
}
