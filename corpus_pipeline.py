"""The corpus pipeline: from raw documents to a deduplicated, mixed and tokenised corpus.

Every stage takes and gives the columns of ``documents``; the last adds ``tokens``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.llm import line_dedup, quality_rules, simhash_dedup, source_mix, token_streams

TOKENIZER = "byte_bpe_50k.json"


def _like(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return _like(quality_rules.cascade(docs).where("kept"), docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows; their length counts what is left."""
    left = line_dedup.remove_repeated_lines(docs)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return _like(left.withColumn("n_chars", length), docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints are linked."""
    return simhash_dedup.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return _like(source_mix.repeated(source_mix.mix(docs)), docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and in the place of the text what the ids decode to (the same)."""
    return token_streams.tokenised(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", keep_good_texts),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenise),
]

#: SQL expresses neither fingerprints nor byte-pair encoding; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
