"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result as Parquet in the shared checkpoint folder and reads it again as the
next stage's input, so a lost executor repeats at most the stage it was in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import cgk_leaks, fertility, packing, secret_owners, simhash_ring
from tickwise.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return fertility.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    return simhash_ring.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return cgk_leaks.drop_leaks(docs, benchmark)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets found in them replaced."""
    return secret_owners.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences; ids as their CRC."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination),
          ("secret_scan", secret_scan), ("packing", pack_windows)]

# Tokenisers and fingerprints cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = scratch_path(spark, f"llm/pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        out = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
