"""Distinct users per day and campaign as stored bitmaps, which add up over batches, days and campaigns.

Users get numbers from a stored dictionary, so that a bitmap has a bit for each user, and distinct counts are exact. Numbers are
given by shards of the user id, each counting on by itself, so no task numbers all users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.session import materialize
from parley.sources.tables import list_dirs

SHARDS = 1024
DICTIONARY = "userid string, shard int, place long"
COLUMNS = ["activity_date", "campaign", "bucket"]


def _number() -> F.Column:
    return F.col("place") * SHARDS + F.col("shard")


def known_users(spark: SparkSession, path: str) -> DataFrame:
    """(userid, shard, place) of all users so far."""
    folders = [d for d in list_dirs(spark, path) if d.startswith("batch=")]
    if not folders:
        return spark.createDataFrame([], DICTIONARY)
    return spark.read.schema(DICTIONARY).parquet(*[f"{path}/{d}" for d in sorted(folders)])


def add_users(spark: SparkSession, users: DataFrame, path: str, batch_id: int) -> None:
    """Number the users that the dictionary lacks. A batch writes its own folder, so a replay overwrites it."""
    earlier = [d for d in list_dirs(spark, path) if d.startswith("batch=") and d != f"batch={batch_id}"]
    known = spark.read.schema(DICTIONARY).parquet(*[f"{path}/{d}" for d in earlier]) if earlier else spark.createDataFrame([], DICTIONARY)
    fresh = users.select("userid").filter("userid IS NOT NULL").distinct().join(known.select("userid"), "userid", "left_anti")
    fresh = fresh.withColumn("shard", F.pmod(F.xxhash64("userid"), F.lit(SHARDS)).cast("int"))
    used = known.groupBy("shard").agg(F.max("place").alias("last"))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("userid")) + F.coalesce("last", F.lit(-1))
    fresh.join(used, "shard", "left").select("userid", "shard", place.cast("long").alias("place")).write.mode("overwrite").parquet(
        f"{path}/batch={batch_id}"
    )


def user_bitmaps(events: DataFrame, users: DataFrame) -> DataFrame:
    """(activity_date, campaign, bucket, bitmap, message_count) of events (userid, campaign, timestamp)."""
    each = events.filter("userid IS NOT NULL").groupBy(F.to_date("timestamp").alias("activity_date"), "campaign", "userid").agg(F.count("*").alias("n"))
    number = _number()
    numbered = each.join(users, "userid").select(
        "activity_date", "campaign", "n", F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")
    )
    return numbered.groupBy(*COLUMNS).agg(F.bitmap_construct_agg("bit").alias("bitmap"), F.sum("n").alias("message_count"))


def merged_bitmaps(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*COLUMNS).agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("message_count").alias("message_count"))


def distinct_users(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Messages and exact distinct users by any of activity_date and campaign, from the stored bitmaps."""
    buckets = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("message_count").alias("message_count"))
    return buckets.groupBy(*by).agg(F.sum("message_count").alias("message_count"), F.sum(F.bitmap_count("bitmap")).alias("unique_users"))


def store_batch(events: DataFrame, root: str, batch_id: int) -> None:
    """Add a batch to the dictionary and to the bitmaps under ``root``. A replay of the batch writes the same files again."""
    spark = events.sparkSession
    events = materialize(events.select("userid", "campaign", "timestamp"), "batch")
    add_users(spark, events, f"{root}/users", batch_id)
    bitmaps = user_bitmaps(events, known_users(spark, f"{root}/users"))
    bitmaps.write.mode("overwrite").parquet(f"{root}/bitmaps/batch={batch_id}")


def stored_bitmaps(spark: SparkSession, root: str) -> DataFrame:
    """The bitmaps of all batches, merged."""
    return merged_bitmaps(spark.read.parquet(f"{root}/bitmaps").select(*COLUMNS, "bitmap", "message_count"))
