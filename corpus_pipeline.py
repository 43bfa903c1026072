"""From raw documents to an encoded training mix: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusweave.llm import mixing, quality, sentencepieces, toxicity, weighted_minhash
from corpusweave.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", not_toxic),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

# Compression, learned scores, weighted sampling and piece merges have no SQL; tests compare each
# stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
