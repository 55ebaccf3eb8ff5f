"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Engagement tiers, message length limit and recommendation weights.
HIGH_ABOVE = 10
MEDIUM_ABOVE = 5
MAX_MESSAGE_CHARS = 1000
SIMILARITY_WEIGHT = 0.3
USER_COUNT_WEIGHT = 0.2
FREQUENCY_WEIGHT = 0.5
CONFIDENCE_BOOST = 1.2
PLACEHOLDER_SENTIMENT = 0.75


def engagement_tier(n: Column, high_above: int = HIGH_ABOVE, medium_above: int = MEDIUM_ABOVE) -> Column:
    return F.when(n > high_above, "high").when(n > medium_above, "medium").otherwise("low")


def tier_number(tier: Column) -> Column:
    return F.when(tier == "high", 3).when(tier == "medium", 2).otherwise(1)


def message_id(
    userid: str = "userid", campaign: str = "campaign", timestamp: str = "timestamp", message: str = "message"
) -> Column:
    """Stable id of a message; a missing part is spelled ``None`` so that ids stay comparable."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in (userid, campaign, timestamp, message)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970, truncated. A zone-less time is read as UTC whatever the session zone is."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(name))
    return F.unix_millis(F.col(name).cast("timestamp"))


def is_blank(c: Column) -> Column:
    return F.trim(c) == ""


def throughput(output_count: Column, duration: Column) -> Column:
    return F.when(duration > 0, output_count / duration).otherwise(F.lit(0.0))


def stringify_nested(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text, for sinks that take flat rows only."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema
        ]
    )
