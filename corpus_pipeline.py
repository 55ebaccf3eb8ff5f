"""A corpus pipeline: reject poor texts, drop exact and near copies, drop benchmark leaks, encode.

Each stage takes all documents that its predecessor kept, as a stored table, and returns a DataFrame.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from parley.llm import bpe, decontaminate, exact, quality, simhash  # noqa: E402
from parley.llm.common import held_out  # noqa: E402
from parley.session import materialize  # noqa: E402


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.drop_poor(docs, labels, ~held_out(F.col("doc_id"), 3, 1))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, words=simhash.SHINGLE_WORDS, distance=simhash.DISTANCE)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", drop_poor), ("exact dedup", drop_exact), ("near dedup", drop_near), ("decontamination", drop_leaks),
    ("byte BPE", encode),
]

# a trained classifier decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
