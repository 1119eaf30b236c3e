"""A corpus pipeline: quality, toxicity, near-duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.
All but the last return rows of `documents` as they are. `run` writes every stage's result as
Parquet to the shared folder (spark.checkpoint.dir) and reads it again for the next, which removes it when done.

An empty table goes through every stage and comes out empty; null texts are scored and kept
like empty ones. SQL cannot express the trained models, so there is no ORACLE_SQL.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.llm import bpe, decontaminate, quality, simhash, toxicity
from foldergrid.session import cut_lineage, forget

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity_segments(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids instead of their texts, and the digests of ids and bytes."""
    done = bpe.encode_and_decode(docs, "text", VOCABULARY)
    return done.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "ids", "offsets", "decoded")], "ids",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_segments),
    ("simhash_near_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        forget(*written)  # what this stage has read
        written = [docs]
    return docs
