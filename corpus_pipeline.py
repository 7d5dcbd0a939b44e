"""From raw documents to training shards, as stages that each read what the one before wrote.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet to the
shared folder and rereads it as the next one's docs. All but the last keep the columns of
documents. Order: what fails the quality score goes, then repeated lines, then near copies; what is
left is mixed to the target weights and encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymill.llm import bpe, lines, minhash, mixing, quality
from entitymill.llm.common import discard, documents, materialize, scratch_tables


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; its labels are those of the same folder."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; a document of such lines only stays, empty."""
    kept = lines.rewrite_documents(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole while words are taken, at least one time."""
    return mixing.copy_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        with scratch_tables() as made:
            docs = materialize(stage(spark, docs, sf_dir), name)
        # what the stage made on its way, and what it read, is not read again
        discard(spark, before + made[:-1])
        before = made[-1:]
    return docs
