"""The analytics report as one nested row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators import metrics


def _in_order(top: DataFrame, *order: Column) -> Column:
    """The few rows of a ranking as one array of structs."""
    keyed = top.select(F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)]).alias("k"), F.struct("*").alias("row"))
    return keyed.agg(F.array_sort(F.collect_list(F.struct("k", "row")))["row"].alias("rows")).scalar()


def _by_day(days: DataFrame, value: Column) -> Column:
    entries = days.agg(F.sort_array(F.collect_list(F.struct(F.col("activity_date").cast("string"), value)), asc=False).alias("e"))
    return F.map_from_entries(entries.scalar())


def analytics_report(
    df: DataFrame, engagement: DataFrame, performance: DataFrame, daily: DataFrame, at: Column | None = None
) -> DataFrame:
    """Totals, top performers and seven-day trends. Every array and map holds at most seven entries."""
    users = metrics.most_engaged_users(engagement).select(
        "user_id", "message_count", "engagement_score", "preferred_campaigns", "last_active"
    )
    campaigns = metrics.best_campaigns(performance)
    return metrics.report_summary(df, engagement).select(
        (F.current_timestamp() if at is None else at).alias("report_timestamp"),
        F.struct("total_users", "total_campaigns", "total_messages", "avg_engagement_score").alias("summary"),
        F.struct(
            _in_order(users, -F.col("message_count"), F.col("user_id")).alias("most_engaged_users"),
            _in_order(campaigns, -F.col("total_messages"), F.col("campaign_id")).alias("best_performing_campaigns"),
        ).alias("top_performers"),
        F.struct(
            _by_day(metrics.messages_per_day(df), F.col("message_count")).alias("messages_last_7_days"),
            _by_day(
                metrics.daily_trend(daily),
                F.struct("active_users", F.coalesce("messages", F.lit(0)).alias("messages")),
            ).alias("user_activity"),
        ).alias("trends"),
    )
