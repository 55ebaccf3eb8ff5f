"""The user-message-campaign graph as vertex and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.columns import engagement_tier, epoch_millis, message_id
from parley.operators.joins import lookup_join
from parley.operators.pairs import BLOCK, pair_changes
from parley.session import materialize


def with_message_id(df: DataFrame) -> DataFrame:
    return df if "message_id" in df.columns else df.withColumn("message_id", message_id())


def message_nodes(df: DataFrame) -> DataFrame:
    """One row per message id, so repeated events are one node. The id settles text and time, so whole rows compare."""
    return (
        with_message_id(df)
        .select("message_id", F.col("message").alias("text"), epoch_millis(df, "timestamp").alias("timestamp"))
        .distinct()
    )


def user_nodes(df: DataFrame) -> DataFrame:
    """Users with the message count and tier that the graph keeps on them."""
    return (
        sent_edges(df)
        .groupBy(F.col("src").alias("user_id"))
        .agg(F.count("*").alias("message_count"))
        .withColumn("engagement_score", engagement_tier(F.col("message_count")))
    )


def campaign_nodes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("campaign").isNotNull()).select(F.col("campaign").alias("campaign_id")).distinct()


def sent_edges(df: DataFrame) -> DataFrame:
    return with_message_id(df).select(F.col("userid").alias("src"), F.col("message_id").alias("dst")).distinct()


def about_edges(df: DataFrame) -> DataFrame:
    return (
        with_message_id(df)
        .filter(F.col("campaign").isNotNull())
        .select(F.col("message_id").alias("src"), F.col("campaign").alias("dst"))
        .distinct()
    )


def graph_nodes(df: DataFrame) -> DataFrame:
    """All vertices as (label, id), in one pass over the messages."""
    node = F.inline(F.array(
        F.struct(F.lit("User").alias("label"), F.col("userid").alias("id")),
        F.struct(F.lit("Campaign").alias("label"), F.col("campaign").alias("id")),
        F.struct(F.lit("Message").alias("label"), F.col("message_id").alias("id")),
    ))
    return with_message_id(df).select("userid", "campaign", "message_id").select(node).filter("label <> 'Campaign' OR id IS NOT NULL").distinct()


def graph_edges(df: DataFrame) -> DataFrame:
    """SENT and ABOUT edges as (label, src, dst), in one pass over the messages."""
    edge = F.inline(F.array(
        F.struct(F.lit("SENT").alias("label"), F.col("userid").alias("src"), F.col("message_id").alias("dst")),
        F.struct(F.lit("ABOUT").alias("label"), F.col("message_id").alias("src"), F.col("campaign").alias("dst")),
    ))
    return with_message_id(df).select("userid", "campaign", "message_id").select(edge).filter("label <> 'ABOUT' OR dst IS NOT NULL").distinct()


def merge_missing(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` plus the incoming rows whose key it lacks; rows already there stay untouched."""
    fresh = incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh)


def user_campaigns(df: DataFrame) -> DataFrame:
    known = F.col("userid").isNotNull() & F.col("campaign").isNotNull()
    return df.filter(known).select("userid", "campaign").distinct()


def user_similarity(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """SIMILAR_TO: one row (src < dst) per pair of users with a common campaign; weight = common campaigns.

    All pairs, so quadratic by nature; but only users travel, MOST_BLOCKS times at most, and each pair is counted in one task.
    """
    pairs = materialize(user_campaigns(df), "user_campaigns")
    return pair_changes(pairs.select("*", F.lit(True).alias("now"), F.lit(False).alias("before")), block)


def similar_users(df: DataFrame, user_id: str, k: int = 5) -> DataFrame:
    """The k users that share most campaigns with one user.

    Read off the user-campaign table directly: linear in the users of that user's campaigns, with no
    need for the table of all pairs.
    """
    pairs = user_campaigns(df)
    own = pairs.filter(F.col("userid") == user_id).select("campaign")
    return (
        pairs.filter(F.col("userid") != user_id)
        .join(own, "campaign", "left_semi")
        .groupBy(F.col("userid").alias("user_id"))
        .agg(F.count("*").alias("similarity"))
        .orderBy(F.desc("similarity"), "user_id")
        .limit(k)
    )


def similar_users_from_edges(edges: DataFrame, user_id: str, k: int = 5) -> DataFrame:
    """The same from a stored SIMILAR_TO table, whose edges count in either direction."""
    touching = (F.col("src") == user_id) | (F.col("dst") == user_id)
    return (
        edges.filter(touching)
        .select(
            F.when(F.col("src") == user_id, F.col("dst")).otherwise(F.col("src")).alias("user_id"),
            F.col("weight").alias("similarity"),
        )
        .orderBy(F.desc("similarity"), "user_id")
        .limit(k)
    )


def campaigns_for_users(df: DataFrame, users: list[str]) -> DataFrame:
    """Campaigns that any of a few named users wrote about, by number of those users, who are listed."""
    pairs = user_campaigns(df).filter(F.col("userid").isin(users))
    found = [F.count("*").alias("user_count"), F.array_sort(F.collect_list("userid")).alias("user_list")]
    return pairs.groupBy(F.col("campaign").alias("campaign_id")).agg(*found).orderBy(F.desc("user_count"), "campaign_id")


def campaign_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """(campaign_id, userid, user_count): the same for a table of users, a row for each user, so that no row grows with the table."""
    pairs = user_campaigns(df).join(users.select("userid").distinct(), "userid", "left_semi")
    counts = pairs.groupBy("campaign").agg(F.count("*").alias("user_count"))
    return lookup_join(pairs, counts, ["campaign"], "userid").select(F.col("campaign").alias("campaign_id"), "userid", "user_count")


def graph_user_engagement(users: DataFrame, sent: DataFrame, messages: DataFrame) -> DataFrame:
    """Every user with message count, tier and time of the latest message; users without messages stay."""
    last = (
        sent.join(messages.select(F.col("message_id").alias("dst"), "timestamp"), "dst")
        .groupBy(F.col("src").alias("user_id"))
        .agg(F.count("*").alias("message_count"), F.max("timestamp").alias("last_activity"))
    )
    return (
        users.select("user_id")
        .join(last, "user_id", "left")
        .select(
            "user_id",
            "message_count",
            F.when(F.col("message_count").isNotNull(), engagement_tier(F.col("message_count"))).alias(
                "engagement_score"
            ),
            "last_activity",
        )
    )


def graph_integrity(users: DataFrame, messages: DataFrame, sent: DataFrame, about: DataFrame) -> DataFrame:
    """One row: messages without a sender, messages without a campaign, users without messages."""
    by_message = messages.select("message_id")
    senders = sent.select(F.col("dst").alias("message_id"))
    topics = about.select(F.col("src").alias("message_id"))
    unsent = by_message.join(senders, "message_id", "left_anti").agg(F.count("*").alias("n"))
    untagged = by_message.join(topics, "message_id", "left_anti").agg(F.count("*").alias("n"))
    silent = (
        users.select("user_id")
        .join(sent.select(F.col("src").alias("user_id")), "user_id", "left_anti")
        .agg(F.count("*").alias("n"))
    )
    return unsent.select(
        F.col("n").alias("messages_without_sender"),
        untagged.scalar().alias("messages_without_campaign"),
        silent.scalar().alias("users_without_messages"),
    )


def edges_since(edges: DataFrame, messages: DataFrame, since_ms: int, label: str = "SENT") -> DataFrame:
    """Rolling window of edges: those whose message is at least as recent as ``since_ms``."""
    end = "dst" if label == "SENT" else "src"
    recent = messages.filter(F.col("timestamp") >= since_ms).select(F.col("message_id").alias(end))
    return edges.join(recent, end, "left_semi").select(*edges.columns)
