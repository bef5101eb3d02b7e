"""The corpus pipeline: language ID, near-duplicates, secrets, mixing and packing, one after the other over `documents`.

Each stage works on all its predecessor kept. What it returns is written as Parquet to the folder all executors share and
read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import language_id, mixing, near_dedup, packing, secret_scan
from skyledger.sources import tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text in a language (no letter at all) go."""
    return language_id.with_language_only(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) one document stays."""
    return near_dedup.without_near_duplicates(docs, width=5, threshold_percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are masked."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources ask for."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences; `row` tells repeated documents apart."""
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing, MinHash, string kernels and packing are no SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the rows of the last one. What a stage stages for itself and the
    documents it read are removed once its result is written."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        written = tables.scratch_path(spark, name)
        with tables.temporary(spark):
            result = step(spark, docs, sf_dir)
            result.write.parquet(written)
        if read:
            tables.discard(spark, read)
        docs, read = spark.read.schema(result.schema).parquet(written), written
    return docs
