"""A corpus from raw documents to token ids: toxicity, exact dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written as Parquet in the
folder that spark.checkpoint.dir names and read again, so that no stage computes another one's work twice. Every
stage but the last returns the columns of documents.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyguard.llm import exact_dedup, minhash, mixing, sentencepiece, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op 1 does not predict toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact copies."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    return minhash.drop_near_duplicates(docs, k=5, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can express neither the classifier nor the sketches; tests hold each stage against its brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    shared = shared or tempfile.mkdtemp(prefix="spark-checkpoint-")
    folder = f"{shared.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
