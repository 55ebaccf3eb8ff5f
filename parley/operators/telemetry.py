"""Runs, steps, lineage and request latency, computed from tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.columns import throughput
from parley.operators.quantiles import ranked_values

# Retention, history length and percentiles.
KEEP_RUNS = 100
KEEP_REQUESTS = 1000
HISTORY = 10
THRESHOLD = 2.0
WINDOW_MINUTES = 60
PERCENTILES = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def retain_last(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The latest ``n`` rows in ``order``; each task keeps at most ``n`` before they meet."""
    return df.orderBy(*order).limit(n)


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return retain_last(runs, n, [F.desc("start_time"), F.desc("run_id")])


def step_throughput(steps: DataFrame) -> DataFrame:
    return steps.withColumn(
        "throughput_records_per_second", throughput(F.col("output_count"), F.col("duration_seconds"))
    )


def run_summary(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """One row over all runs; zeros when there are none."""
    total = F.count("*")
    status = F.col("status")
    records = steps.agg(F.coalesce(F.sum("output_count"), F.lit(0)).alias("n"))
    return runs.agg(
        total.alias("total_runs"),
        F.count_if(status == "completed").alias("successful_runs"),
        F.count_if(status == "failed").alias("failed_runs"),
        F.coalesce(F.try_divide(F.count_if(status == "completed"), total), F.lit(0.0)).alias("success_rate"),
        F.coalesce(
            F.try_divide(F.sum(F.coalesce("total_duration_seconds", F.lit(0.0))), total), F.lit(0.0)
        ).alias("average_duration_seconds"),
    ).withColumn("total_records_processed", records.scalar())


def latency_anomalies(
    steps: DataFrame,
    threshold: float = THRESHOLD,
    history: int = HISTORY,
    order: list[Column] | None = None,
    exclude_latest: bool = False,
) -> DataFrame:
    """Steps whose latest duration exceeds mean + threshold * population deviation of the last ``history``.

    Spark keeps at most ``history`` rows per step and task before the shuffle. ``exclude_latest``
    leaves the judged run out of its own history.
    """
    recency = order or [F.desc("timestamp")]
    kept = history + 1 if exclude_latest else history
    recent = steps.withColumn("age", F.row_number().over(Window.partitionBy("step_name").orderBy(*recency))).filter(
        F.col("age") <= kept
    )
    base = F.when(F.col("age") > 1, F.col("duration_seconds")) if exclude_latest else F.col("duration_seconds")
    newest = F.col("age") == 1
    stats = recent.groupBy("step_name").agg(
        F.count("*").alias("n"),
        (F.avg(base) + threshold * F.stddev_pop(base)).alias("expected_max"),
        F.max(F.when(newest, F.col("duration_seconds"))).alias("duration"),
        F.max(F.when(newest, F.col("timestamp"))).alias("timestamp"),
    )
    return stats.filter((F.col("n") >= 2) & (F.col("duration") > F.col("expected_max"))).select(
        "step_name", "duration", "expected_max", (F.col("duration") - F.col("expected_max")).alias("deviation"), "timestamp"
    )


def latency_stats(
    requests: DataFrame,
    now: datetime | Column,
    window_minutes: int | None = WINDOW_MINUTES,
    endpoint: str | None = None,
) -> DataFrame:
    """Request count, mean and exact percentiles in ms per endpoint over the trailing window."""
    at = now if isinstance(now, Column) else F.lit(now)
    recent = requests
    if window_minutes is not None:
        recent = recent.filter(F.col("timestamp") >= at - F.make_dt_interval(mins=F.lit(window_minutes)))
    if endpoint:
        recent = recent.filter(F.col("endpoint") == endpoint)
    recent = recent.select("endpoint", (F.col("duration_seconds") * 1000).alias("ms"))
    stats = ranked_values(recent, "endpoint", "ms", PERCENTILES, {"avg_latency_ms": F.avg("ms")})
    return stats.select("endpoint", F.col("total").alias("count"), "avg_latency_ms", *PERCENTILES)


def overall_latency(requests: DataFrame, now: datetime | Column, window_minutes: int | None = WINDOW_MINUTES) -> DataFrame:
    """``latency_stats`` over all endpoints together; one row, zeros when the window is empty."""
    stats = latency_stats(requests.withColumn("endpoint", F.lit("all")), now, window_minutes)
    names = ["count", "avg_latency_ms", *PERCENTILES]
    return stats.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names])


def lineage_summary(lineage: DataFrame) -> DataFrame:
    """Per pipeline run: steps and records in and out."""
    return lineage.groupBy("pipeline_run_id").agg(
        F.count("*").alias("total_steps"),
        F.sum("input_record_count").alias("input_records"),
        F.sum("output_record_count").alias("output_records"),
        F.min("timestamp").alias("first_step"),
        F.max("timestamp").alias("last_step"),
    )


def minute_sketches(requests: DataFrame) -> DataFrame:
    """(endpoint, minute, count, total_ms, sketch): a mergeable sketch of the durations of each endpoint and minute.

    It is small whatever the number of requests, so a trailing window is answered from some 60 rows per endpoint.
    """
    ms = F.col("duration_seconds") * 1000
    return requests.filter(ms.isNotNull()).groupBy("endpoint", F.date_trunc("minute", "timestamp").alias("minute")).agg(
        F.count("*").alias("count"), F.sum(ms).alias("total_ms"), F.kll_sketch_agg_double(ms).alias("sketch")
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The same for the rows of one minute that came in several batches."""
    return sketches.groupBy("endpoint", "minute").agg(
        F.sum("count").alias("count"), F.sum("total_ms").alias("total_ms"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def sketched_latency(sketches: DataFrame, now: Column, minutes: int | None = WINDOW_MINUTES) -> DataFrame:
    """Count and mean exactly, percentiles within the sketch's rank error (about 1.3 %), over the minutes that lie in the window."""
    recent = sketches if minutes is None else sketches.filter(F.col("minute") > now - F.make_dt_interval(mins=F.lit(minutes)))
    merged = recent.groupBy("endpoint").agg(
        F.sum("count").alias("count"), (F.sum("total_ms") / F.sum("count")).alias("avg_latency_ms"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(
        "endpoint", "count", "avg_latency_ms", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for n, p in PERCENTILES.items()]
    )
