"""Batch jobs: metrics, graph, recommendations and the whole pipeline with its gates."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley import schemas
from parley.operators import graph, metrics, quality, telemetry
from parley.operators.embed import EMBEDDING_DIM, embed
from parley.operators.recommend import recommendations
from parley.operators.similar import similar_users_all
from parley.plans.report import analytics_report
from parley.session import TEXT_CODEC, recover_folder, scratch_scope, swap_folder
from parley.sources import tables
from parley.sources.events import ingest


# Texts of the errors that end a run; the names of steps below are fixed as well.
SCHEMA_FAILED = "Schema validation failed: {}"
EMBEDDINGS_FAILED = "Embedding validation failed: {}"


def _now() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    """Steps and lineage of one run; a handful of rows that are appended to tables when the run ends."""

    def __init__(self, spark: SparkSession, root: str, input_path: str | None = None, run_id: str | None = None):
        self.spark, self.root, self.input_path = spark, root, input_path
        self.run_id = run_id or str(uuid.uuid4())
        self.started = _now()
        self.steps: list[dict] = []
        self.lineage: list[dict] = []

    def record(
        self,
        step: str,
        duration: float,
        input_count: int,
        output_count: int,
        errors: list[str] | None = None,
        anomalies: dict[str, float] | None = None,
        input_hash: str | None = None,
        output_hash: str | None = None,
        metadata: dict | None = None,
    ) -> None:
        at = _now()
        self.steps.append(
            {
                "run_id": self.run_id, "step_name": step, "duration_seconds": float(duration),
                "input_count": input_count, "output_count": output_count,
                "throughput_records_per_second": output_count / duration if duration > 0 else 0.0,
                "timestamp": at, "errors": errors, "anomalies": anomalies,
            }
        )
        self.lineage.append(
            {
                "pipeline_run_id": self.run_id, "step_name": step, "timestamp": at,
                "input_record_count": input_count, "output_record_count": output_count,
                "input_hash": input_hash, "output_hash": output_hash,
                "metadata": {k: str(v) for k, v in (metadata or {}).items()},
            }
        )

    @contextmanager
    def step(self, name: str, input_count: int):
        """Times a step; the body sets ``output_count`` and whatever else ``record`` takes."""
        facts: dict = {"output_count": input_count}
        began = time.monotonic()
        yield facts
        self.record(name, time.monotonic() - began, input_count, **facts)

    def finish(self, status: str, error: str | None = None) -> None:
        end = _now()
        if error:
            self.record("pipeline_failure", 0.0, 0, 0, errors=[error], metadata={"error": error})
        run = {
            "run_id": self.run_id, "status": status, "start_time": self.started, "end_time": end,
            "total_duration_seconds": (end - self.started).total_seconds(), "input_path": self.input_path, "error": error,
        }
        for name, rows, schema in (
            ("runs", [run], schemas.RUNS),
            ("step_metrics", self.steps, schemas.STEP_METRICS),
            ("lineage", self.lineage, schemas.LINEAGE),
        ):
            recover_folder(self.spark, f"{self.root}/{name}")
            if rows:
                self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")
        keep_latest(self.spark, f"{self.root}/runs", telemetry.KEEP_RUNS, [F.desc("start_time"), F.desc("run_id")])


def keep_latest(spark: SparkSession, path: str, n: int, order: list[Column]) -> None:
    """Cut a log to its latest ``n`` rows. They are written aside first and then take the log's place."""
    log = spark.read.parquet(path)
    if log.count() > n:
        aside = f"{path}.new"
        telemetry.retain_last(log, n, order).coalesce(1).write.mode("overwrite").parquet(aside)
        swap_folder(spark, aside, path)
        spark.catalog.refreshByPath(path)


def log_requests(requests: DataFrame, root: str, keep: int = telemetry.KEEP_REQUESTS) -> None:
    """Append served requests (a table, as read from JSON Lines) to the log that the latency statistics read."""
    path, names = f"{root}/request_log", schemas.REQUEST_LOG.names
    recover_folder(requests.sparkSession, path)
    requests.select(*names).write.mode("append").parquet(path)
    # a hash of the row parts requests of the same time
    keep_latest(requests.sparkSession, path, keep, [F.desc("timestamp"), F.xxhash64(*names)])


def save_monitoring_report(spark: SparkSession, root: str, keep: int = 20) -> None:
    """The run summary and the latest runs as JSON."""
    runs, steps = spark.read.parquet(f"{root}/runs"), spark.read.parquet(f"{root}/step_metrics")
    tables.export_json(telemetry.run_summary(runs, steps), f"{root}/reports/run_summary")
    tables.export_json(telemetry.recent_runs(runs, keep), f"{root}/reports/recent_runs")


def metrics_job(spark: SparkSession, df: DataFrame, root: str) -> None:
    """Compute the three metric tables once, store them, and take report and CSV exports from the stored ones."""
    tables.save_table(metrics.user_engagement(df), f"{root}/user_engagement", lookup="user_id")
    tables.save_table(metrics.campaign_performance(df), f"{root}/campaign_performance", lookup="campaign_id")
    tables.save_daily(metrics.daily_activity(df), f"{root}/user_activity_daily")
    engagement = spark.read.parquet(f"{root}/user_engagement")
    performance = spark.read.parquet(f"{root}/campaign_performance")
    daily = spark.read.parquet(f"{root}/user_activity_daily")
    tables.export_json(analytics_report(df, engagement, performance, daily), f"{root}/reports/analytics_report")
    for name, table in (("user_engagement", engagement), ("campaign_performance", performance), ("daily_activity", daily)):
        tables.export_csv(table, f"{root}/reports/{name}_csv")


def graph_job(spark: SparkSession, df: DataFrame, root: str) -> None:
    """Rebuild the graph tables; stale similarity edges do not survive a rebuild."""
    ids = graph.with_message_id(df)
    with scratch_scope(spark):
        _write_graph(ids, root)


def _write_graph(ids: DataFrame, root: str) -> None:
    for name, table in (
        ("users", graph.user_nodes(ids)),
        ("campaigns", graph.campaign_nodes(ids)),
        ("messages", graph.message_nodes(ids)),
        ("sent", graph.sent_edges(ids)),
        ("about", graph.about_edges(ids)),
        ("similar_to", similar_users_all(ids)),
    ):
        table.write.mode("overwrite").option("compression", TEXT_CODEC).parquet(f"{root}/graph/{name}")


def frequency_table(spark: SparkSession, root: str) -> tables.KeyedTable:
    return tables.KeyedTable(
        spark, f"{root}/campaign_engagement_frequency", schemas.CAMPAIGN_ENGAGEMENT_FREQUENCY, ["campaign_id"]
    )


def update_campaign_frequency(spark: SparkSession, df: DataFrame, root: str, replace: bool = False) -> None:
    """Upsert the batch's campaign counts; campaigns it lacks stay, unless ``replace``."""
    batch = metrics.campaign_engagement_frequency(df).withColumn("updated_at", F.current_timestamp())
    table = frequency_table(spark, root)
    if replace:
        table.replace(batch)
    else:
        table.upsert(batch)


def recommend_job(spark: SparkSession, df: DataFrame, root: str, dim: int = EMBEDDING_DIM, **options) -> None:
    """Write everybody's recommendations, ordered for lookups by user."""
    with scratch_scope(spark):
        tables.save_table(recommendations(df, dim, **options), f"{root}/recommendations", lookup="user_id")


def user_lookup(spark: SparkSession, root: str, user_id: str) -> DataFrame:
    """Engagement of one user from the stored table."""
    return spark.read.parquet(f"{root}/user_engagement").filter(F.col("user_id") == user_id)


def campaign_lookup(spark: SparkSession, root: str, campaign_id: str) -> DataFrame:
    """Performance of one campaign from the stored table."""
    return spark.read.parquet(f"{root}/campaign_performance").filter(F.col("campaign_id") == campaign_id)


def run_pipeline(
    spark: SparkSession,
    root: str,
    input_path: str | None = None,
    encoder: Callable | None = None,
    dim: int = EMBEDDING_DIM,
    multi_line: bool = True,
) -> str:
    """Ingest, check, store, embed, build the graph and the metrics under ``root``; returns the run id.

    A failed schema or embedding check aborts the run, which is logged as failed.
    """
    log = RunLog(spark, root, input_path)
    try:
        with log.step("ingestion", 0) as facts:
            seen = Observation("ingested")
            clean = ingest(spark, input_path, multi_line).observe(seen, F.count("*").alias("n"))
            clean.write.mode("overwrite").option("compression", TEXT_CODEC).parquet(f"{root}/interactions")
            events = spark.read.parquet(f"{root}/interactions")
            n = seen.get["n"]
            ok, errors = quality.validate_schema(events)
            if not ok:
                raise ValueError(SCHEMA_FAILED.format(errors))
            profile = quality.detect_anomalies(events).first().asDict()
            in_hash = quality.table_fingerprint(events).first()["content_sum"]
            facts |= {
                "output_count": n, "input_hash": in_hash, "anomalies": {k: float(v) for k, v in profile.items()},
                "metadata": profile,
            }
        with log.step("document_storage", n) as facts:
            with scratch_scope(spark):
                counts = tables.store_documents(spark, events, f"{root}/documents")
            facts |= {"output_count": counts["inserted"] + counts["updated"], "metadata": counts}
        with log.step("embedding_generation", n) as facts:
            tables.save_embeddings(embed(events, encoder=encoder, dim=dim), f"{root}/embedded")
            embedded = tables.load_embeddings(spark, f"{root}/embedded")
            ok, errors = quality.validate_embeddings(embedded, dim)
            if not ok:
                raise ValueError(EMBEDDINGS_FAILED.format(errors))
            out_hash = quality.table_fingerprint(embedded).first()["content_sum"]
            facts |= {"input_hash": in_hash, "output_hash": out_hash}
        with log.step("vector_storage", n):
            tables.store_vectors(embedded, f"{root}/vectors")
        with log.step("graph_build", n):
            graph_job(spark, embedded, root)
        with log.step("analytics_aggregation", n):
            metrics_job(spark, embedded, root)
            update_campaign_frequency(spark, embedded, root)
    except Exception as e:
        log.finish("failed", str(e))
        save_monitoring_report(spark, root)
        raise
    log.finish("completed")
    save_monitoring_report(spark, root)
    # steps of this and earlier runs that took much longer than usual
    slow = telemetry.latency_anomalies(spark.read.parquet(f"{root}/step_metrics"), order=[F.desc("timestamp")])
    slow.coalesce(1).write.mode("overwrite").parquet(f"{root}/latency_anomalies")
    return log.run_id
