"""The engine's input frames, derived from the test tables; each covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.embed import embed

EMBEDDING_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str, message: bool = False, embedding: bool = False) -> DataFrame:
    """events as interactions. Campaign is NULL for k = 0.

    The message, if asked for, is a document's whole text; ``embedding`` adds its vector, made once per document.
    """
    # one evaluation of the JSON path per row
    campaign = F.nullif(F.concat(F.lit("c"), F.get_json_object("props", "$.k")), F.lit("c0"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id")).alias("userid"),
        campaign.alias("campaign"),
        F.col("ts").alias("timestamp"),
    )
    return with_messages(spark, sf_dir, events, embedding) if message else events


def with_messages(spark: SparkSession, sf_dir: str, events: DataFrame, embedding: bool = False) -> DataFrame:
    """Events with their messages. Whole texts come last and are shuffled once a document, so join everything else to the events before."""
    documents = table(spark, sf_dir, "documents")
    n_documents = documents.agg(F.count("*").alias("n")).scalar()
    texts = documents.select("doc_id", F.col("text").alias("message"))
    if embedding:
        texts = embed(texts, "message", dim=EMBEDDING_DIM)
    return events.withColumn("doc_id", F.col("event_id") % n_documents).join(texts, "doc_id", "left").drop("doc_id")


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as interactions: about ten per customer, so that all three tiers occur."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("u"), F.col("o_custkey")).alias("userid"),
        F.col("o_orderpriority").alias("campaign"),
        F.col("o_orderdate").alias("timestamp"),
    )


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All interactions with their messages and the messages' vectors."""
    return interactions(spark, sf_dir, message=True, embedding=True)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        (F.col("value") / 1000).alias("duration_seconds"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


def step_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as step metrics: one run per user, counts taken from the JSON payload."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("r"), F.col("user_id")).alias("run_id"),
        F.col("event_type").alias("step_name"),
        F.col("value").alias("duration_seconds"),
        (k * 2).alias("input_count"),
        k.alias("output_count"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as runs: finished orders succeeded, open ones failed, the rest still run."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.col("o_custkey")).alias("run_id"),
        F.when(status == "F", "completed").when(status == "O", "failed").otherwise("running").alias("status"),
        (F.col("o_totalprice") / 1000).alias("total_duration_seconds"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_orderkey").alias("seq"),
    )
