"""User engagement, campaign performance, daily activity and the report's rankings.

Every aggregate is algebraic or first reduced to distinct keys, so map-side partial results carry
a hot user or campaign and no task sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.columns import HIGH_ABOVE, MEDIUM_ABOVE, PLACEHOLDER_SENTIMENT, engagement_tier, tier_number

# How many campaigns are listed as preferred; names of output columns below.
PREFERRED = 3


def user_engagement(
    df: DataFrame,
    preferred: int = PREFERRED,
    high_above: int = HIGH_ABOVE,
    medium_above: int = MEDIUM_ABOVE,
    prefer_by: str = "first_use",
) -> DataFrame:
    """Message count, tier, last activity and the first ``preferred`` campaigns of each user.

    Events are reduced to (user, campaign) once. From there the totals are plain sums, and the
    preferred campaigns a ranking that Spark cuts to ``preferred`` rows per user before it shuffles.
    Both sides end up partitioned by user, so the join adds no shuffle.
    """
    per_pair = df.filter(F.col("userid").isNotNull()).groupBy("userid", "campaign").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_use"), F.max("timestamp").alias("last_use")
    )
    totals = per_pair.groupBy("userid").agg(
        F.sum("n").alias("message_count"),
        # never below the latest first use; naming it keeps the column in this branch too, see below
        F.greatest(F.max("last_use"), F.max("first_use")).alias("last_active"),
    )
    order = {
        "first_use": [F.col("first_use").asc_nulls_last(), F.col("campaign"), F.col("n"), F.col("last_use")],
        "count": [F.col("n").desc(), F.col("campaign"), F.col("first_use"), F.col("last_use")],
    }[prefer_by]
    # NULL campaigns rank last and are dropped only when collecting, and both branches use every column:
    # so they read the very same (user, campaign) shuffle and the events are scanned once
    last = F.col("campaign").isNull()
    ranked = (
        per_pair.withColumn("rank", F.row_number().over(Window.partitionBy("userid").orderBy(last, *order)))
        .filter(F.col("rank") <= preferred)
        .groupBy("userid")
        .agg(F.collect_list(F.when(~last, F.struct("rank", "campaign"))).alias("top"))
        .select("userid", F.array_sort("top")["campaign"].alias("preferred_campaigns"))
    )
    return totals.join(ranked, "userid", "left").select(
        F.col("userid").alias("user_id"),
        "message_count",
        engagement_tier(F.col("message_count"), high_above, medium_above).alias("engagement_score"),
        "last_active",
        F.coalesce("preferred_campaigns", F.array().cast("array<string>")).alias("preferred_campaigns"),
    )


def campaign_performance(df: DataFrame, sentiment: str | None = None) -> DataFrame:
    """Messages, distinct users and last message per campaign; a NULL campaign is its own group.

    ``sentiment`` names a numeric column to average; without one the fixed placeholder is reported.
    """
    score = F.avg(sentiment) if sentiment else F.max(F.lit(PLACEHOLDER_SENTIMENT))
    return df.groupBy(F.col("campaign").alias("campaign_id")).agg(
        F.count("*").alias("total_messages"),
        F.count_distinct("userid").alias("unique_users"),
        score.alias("avg_sentiment"),
        F.max("timestamp").alias("last_updated"),
    )


def daily_activity(df: DataFrame) -> DataFrame:
    """Messages and the set of campaigns per day and user."""
    per_campaign = df.groupBy(F.to_date("timestamp").alias("activity_date"), "userid", "campaign").agg(
        F.count("*").alias("n")
    )
    return per_campaign.groupBy("activity_date", F.col("userid").alias("user_id")).agg(
        F.sum("n").alias("message_count"),
        F.array_sort(F.collect_list("campaign")).alias("campaigns_interacted"),
    )


def campaign_engagement_frequency(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("campaign").alias("campaign_id")).agg(
        F.count("*").alias("engagement_count"),
        F.count_distinct("userid").alias("unique_users"),
        F.max("timestamp").alias("last_engagement"),
    )


def campaign_frequency_lookup(freq: DataFrame, campaigns: list[str] | DataFrame | None = None) -> DataFrame:
    """Frequencies by count, of all campaigns or of the given ids (a list, or a table of ``campaign_id``)."""
    if isinstance(campaigns, DataFrame):
        freq = freq.join(campaigns.select("campaign_id"), "campaign_id", "left_semi")
    elif campaigns:
        freq = freq.filter(F.col("campaign_id").isin(campaigns))
    return freq.select("campaign_id", "engagement_count", "unique_users", "last_engagement").orderBy(
        F.desc("engagement_count"), "campaign_id"
    )


def report_summary(df: DataFrame, engagement: DataFrame) -> DataFrame:
    """One row of totals. NULL counts as one campaign and one user here, as ``distinct`` would count it."""
    totals = df.agg(
        F.count("*").alias("total_messages"),
        _distinct_with_null("userid").alias("total_users"),
        _distinct_with_null("campaign").alias("total_campaigns"),
    )
    score = engagement.agg(
        F.coalesce(F.avg(tier_number(F.col("engagement_score"))), F.lit(0.0)).alias("avg_engagement_score")
    )
    return totals.select(
        "total_users", "total_campaigns", "total_messages", score.scalar().alias("avg_engagement_score")
    )


def _distinct_with_null(name: str):
    any_null = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
    return F.count_distinct(name) + any_null


def most_engaged_users(engagement: DataFrame, n: int = 5) -> DataFrame:
    return engagement.orderBy(F.desc("message_count"), "user_id").limit(n)


def best_campaigns(performance: DataFrame, n: int = 5) -> DataFrame:
    return performance.orderBy(F.desc("total_messages"), F.col("campaign_id").asc_nulls_last()).limit(n)


def messages_per_day(df: DataFrame, days: int = 7) -> DataFrame:
    """Messages on each of the latest ``days`` days that have any."""
    return (
        df.groupBy(F.to_date("timestamp").alias("activity_date"))
        .agg(F.count("*").alias("message_count"))
        .orderBy(F.desc("activity_date"))
        .limit(days)
    )


def daily_trend(daily: DataFrame, days: int = 7) -> DataFrame:
    """Active users and messages per day from the daily table, which holds one row per day and user."""
    return (
        daily.groupBy("activity_date")
        .agg(F.count_distinct("user_id").alias("active_users"), F.sum("message_count").alias("messages"))
        .orderBy(F.desc("activity_date"))
        .limit(days)
    )


def document_stats(docs: DataFrame) -> DataFrame:
    return docs.agg(
        F.count("*").alias("total_documents"),
        _distinct_with_null("userid").alias("unique_users"),
        _distinct_with_null("campaign").alias("unique_campaigns"),
    )
