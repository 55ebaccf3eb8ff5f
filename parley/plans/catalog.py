"""All queries by name. Each reads whole tables and emits flat, comparable columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.columns import stringify_nested
from parley.operators import distinct, graph, knn, metrics, quality, recommend, rolling, similar, telemetry, upsert
from parley.operators.embed import embed
from parley.plans import jobs, views
from parley.plans.report import analytics_report
from parley.schemas import CONVERSATION
from parley.session import materialize, scratch_path
from parley.sources import events as event_source
from parley.sources import tables
from parley.streaming import events as stream

DIM = views.EMBEDDING_DIM
# cells of the exact searches: several at every size of the test tables
CELLS = 16
# the least confidence that a filtered request asks for
CONFIDENT = 0.7
# events of a file of JSON Lines
LINES_PER_FILE = 50_000
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# the test events span January 2024; history and arriving batch overlap and together cover them all
HISTORY_END = "2024-01-21"
ARRIVING_FROM = "2024-01-11"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def flat(df: DataFrame) -> DataFrame:
    """Times and dates as text, arrays joined, doubles rounded."""

    def show(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        return c.alias(f.name)

    return df.select(*[show(f) for f in df.schema])


def micros(c: Column, scale: int = 1_000_000) -> Column:
    """A vector as text of scaled integers."""
    return F.concat_ws(",", F.transform(c, lambda x: F.round(x.cast("double") * scale).cast("bigint").cast("string")))


@query
def ingest_clean(spark, sf_dir):
    """Every event delivered twice, as after a replay, then cleaned."""
    raw = views.interactions(spark, sf_dir, message=True).drop("event_id")
    cleaned = event_source.clean(raw.unionByName(raw))
    return flat(
        cleaned.select(
            "userid", "campaign", "timestamp", F.md5("message").alias("message_md5"),
            F.length("message").cast("bigint").alias("message_length"),
        )
    )


@query
def time_parse(spark, sf_dir):
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    events = views.interactions(spark, sf_dir).select("event_id", iso.alias("text"))
    return flat(events.select("event_id", event_source.parse_time(F.col("text")).alias("parsed")))


@query
def message_ids(spark, sf_dir):
    return graph.with_message_id(views.interactions(spark, sf_dir, message=True)).select("event_id", "message_id")


@query
def user_engagement(spark, sf_dir):
    return flat(metrics.user_engagement(views.interactions(spark, sf_dir)))


@query
def user_engagement_tiers(spark, sf_dir):
    return flat(metrics.user_engagement(views.order_interactions(spark, sf_dir)))


@query
def campaign_performance(spark, sf_dir):
    return flat(metrics.campaign_performance(views.interactions(spark, sf_dir)))


@query
def daily_activity(spark, sf_dir):
    return flat(metrics.daily_activity(views.interactions(spark, sf_dir)))


@query
def report_summary(spark, sf_dir):
    df = views.order_interactions(spark, sf_dir)
    return flat(metrics.report_summary(df, metrics.user_engagement(df)))


@query
def messages_last_7_days(spark, sf_dir):
    return flat(metrics.messages_per_day(views.interactions(spark, sf_dir)))


@query
def daily_trend(spark, sf_dir):
    return flat(metrics.daily_trend(metrics.daily_activity(views.interactions(spark, sf_dir))))


@query
def campaign_engagement_frequency(spark, sf_dir):
    return flat(metrics.campaign_engagement_frequency(views.interactions(spark, sf_dir)))


@query
def campaign_freq_lookup(spark, sf_dir):
    frequency = metrics.campaign_engagement_frequency(views.interactions(spark, sf_dir))
    return flat(metrics.campaign_frequency_lookup(frequency, ["c1", "c2", "c3", "c50", "c99", "none"]))


@query
def most_engaged_users(spark, sf_dir):
    return flat(metrics.most_engaged_users(metrics.user_engagement(views.interactions(spark, sf_dir))))


@query
def best_campaigns(spark, sf_dir):
    return flat(metrics.best_campaigns(metrics.campaign_performance(views.interactions(spark, sf_dir))))


@query
def analytics_report_rows(spark, sf_dir):
    """The nested report, listed as (section, key, value)."""
    df = views.interactions(spark, sf_dir)
    report = analytics_report(
        df, metrics.user_engagement(df), metrics.campaign_performance(df), metrics.daily_activity(df)
    )

    def entry(section: str, key: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("string").alias("value")
        )

    totals = [
        entry("summary", F.lit(n), F.col(f"summary.{n}"))
        for n in ("total_users", "total_campaigns", "total_messages", "avg_engagement_score")
    ]
    users = F.transform(
        "top_performers.most_engaged_users", lambda x: entry("users", x["user_id"], x["message_count"])
    )
    campaigns = F.transform(
        "top_performers.best_performing_campaigns", lambda x: entry("campaigns", x["campaign_id"], x["total_messages"])
    )
    days = F.transform(F.map_entries("trends.messages_last_7_days"), lambda x: entry("days", x["key"], x["value"]))
    active = F.transform(
        F.map_entries("trends.user_activity"), lambda x: entry("active", x["key"], x["value"]["active_users"])
    )
    return report.select(F.inline(F.concat(F.array(*totals), users, campaigns, days, active)))


@query
def document_stats(spark, sf_dir):
    return metrics.document_stats(views.interactions(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the vectors of their ids, and with their messages."""
    vectors = views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("event_id"), "embedding")
    events = views.with_messages(spark, sf_dir, views.interactions(spark, sf_dir).join(vectors, "event_id", "left"))
    return events.select("event_id", "userid", "campaign", "timestamp", "message", "embedding")


@query
def validate_schema(spark, sf_dir):
    """The conversation schema made stricter: a campaign is required too."""
    strict = T.StructType([T.StructField(f.name, f.dataType, False) for f in CONVERSATION])
    return quality.schema_errors(_checked(spark, sf_dir), strict)


@query
def validate_embeddings(spark, sf_dir):
    return quality.embedding_profile(_checked(spark, sf_dir))


@query
def detect_anomalies(spark, sf_dir):
    return flat(quality.detect_anomalies(_checked(spark, sf_dir)))


@query
def table_fingerprint(spark, sf_dir):
    df = views.interactions(spark, sf_dir, message=True)
    return quality.table_fingerprint(df, ["event_id", "userid", "campaign", "timestamp", "message"])


@query
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(views.interactions(spark, sf_dir, message=True))


@query
def graph_edges(spark, sf_dir):
    return graph.graph_edges(views.interactions(spark, sf_dir, message=True))


@query
def graph_merge(spark, sf_dir):
    """SENT edges of the history, merged with those of an overlapping later batch."""
    df = views.interactions(spark, sf_dir, message=True)
    stored = graph.sent_edges(df.filter(F.col("timestamp") < HISTORY_END))
    arriving = graph.sent_edges(df.filter(F.col("timestamp") >= ARRIVING_FROM))
    return graph.merge_missing(stored, arriving, ["src", "dst"]).select(F.lit("SENT").alias("label"), "src", "dst")


@query
def graph_edges_window(spark, sf_dir):
    df = _identified(spark, sf_dir)
    since = 1_705_795_200_000  # 2024-01-21 in ms
    return graph.edges_since(graph.sent_edges(df), graph.message_nodes(df), since)


@query
def user_similarity(spark, sf_dir):
    """Blocks of 40, so that a campaign's users fill several."""
    return graph.user_similarity(views.interactions(spark, sf_dir), block=40)


@query
def similarity_rolling(spark, sf_dir):
    """SIMILAR_TO over a window of ten days that moves through all days of the events, and at last back by some."""
    root = scratch_path(spark, "rolling")
    events = views.interactions(spark, sf_dir)
    rolling.store_days(events, root)
    found = None
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-08", "2024-01-17"), ("2024-01-22", "2024-01-31"), ("2024-01-17", "2024-01-26")):
        found = rolling.move_window(spark, root, date.fromisoformat(first), date.fromisoformat(last))
    return found


@query
def similar_users_all(spark, sf_dir):
    """Few sets ask together, so that several groups of them occur."""
    found = similar.similar_users_all(views.interactions(spark, sf_dir), asking=64, compared=100)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query
def similar_users_graph(spark, sf_dir):
    return graph.similar_users(views.interactions(spark, sf_dir), "u1")


@query
def campaigns_for_users(spark, sf_dir):
    return flat(graph.campaigns_for_users(views.interactions(spark, sf_dir), ["u1", "u2", "u3", "u5", "u8"]))


@query
def campaigns_for_user_table(spark, sf_dir):
    wealthy = views.table(spark, sf_dir, "customer").filter("c_acctbal > 5000")
    users = wealthy.select(F.concat(F.lit("u"), F.col("c_custkey")).alias("userid"))
    return graph.campaign_users(views.interactions(spark, sf_dir), users)


def _everyone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey")).alias("user_id"))


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with their ids, stored once because several graph tables derive from them.

    None of these reads a text, so its digest, which tells texts apart as well, stands in its place.
    """
    df = graph.with_message_id(views.interactions(spark, sf_dir, message=True))
    return materialize(df.withColumn("message", F.sha2("message", 256)), "identified")


@query
def graph_user_engagement(spark, sf_dir):
    df = _identified(spark, sf_dir)
    return graph.graph_user_engagement(_everyone(spark, sf_dir), graph.sent_edges(df), graph.message_nodes(df))


@query
def graph_integrity(spark, sf_dir):
    df = _identified(spark, sf_dir)
    return graph.graph_integrity(
        _everyone(spark, sf_dir), graph.message_nodes(df), graph.sent_edges(df), graph.about_edges(df)
    )


@query
def vector_table(spark, sf_dir):
    rows = tables.vector_rows(views.embedded(spark, sf_dir))
    return rows.select(
        "message_id", "user_id", "campaign_id", F.md5("message").alias("message_md5"), "timestamp",
        micros(F.col("embedding")).alias("embedding"),
    )


@query
def documents_projection(spark, sf_dir):
    return flat(
        tables.documents(_checked(spark, sf_dir)).select(
            "message_id", "userid", F.md5("message").alias("message_md5"), "timestamp", "campaign",
            "metadata.has_embedding", "metadata.embedding_dim",
        )
    )


@query
def docs_by_user(spark, sf_dir):
    docs = tables.documents(views.interactions(spark, sf_dir, message=True))
    latest = tables.latest_documents(docs, user="u1")
    return flat(latest.select("message_id", "campaign", "timestamp", F.md5("message").alias("message_md5")))


@query
def docs_by_campaign(spark, sf_dir):
    docs = tables.documents(views.interactions(spark, sf_dir, message=True))
    latest = tables.latest_documents(docs, campaign="c7")
    return flat(latest.select("message_id", "userid", "timestamp", F.md5("message").alias("message_md5")))


@query
def save_json_cols(spark, sf_dir):
    engagement = metrics.user_engagement(views.interactions(spark, sf_dir))
    return stringify_nested(engagement.withColumn("last_active", F.col("last_active").cast("string")))


def _document_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = graph.with_message_id(views.interactions(spark, sf_dir, message=True))
    stored = df.filter(F.col("timestamp") < HISTORY_END)
    arriving = df.filter(F.col("timestamp") >= ARRIVING_FROM)
    pick = ["message_id", "userid"]
    return (
        stored.select(*pick, F.lit("2024-02-01").alias("processed")),
        arriving.select(*pick, F.lit("2024-02-02").alias("processed")),
    )


@query
def upsert_documents(spark, sf_dir):
    stored, arriving = _document_batches(spark, sf_dir)
    return upsert.upsert(stored, arriving, ["message_id"], [F.col("processed")], null_keys=False)


@query
def upsert_counts(spark, sf_dir):
    stored, arriving = _document_batches(spark, sf_dir)
    return upsert.upsert_counts(stored, arriving, ["message_id"])


@query
def upsert_campaign_freq(spark, sf_dir):
    """The stored frequency table after the history and an overlapping later batch."""
    df, root = views.interactions(spark, sf_dir), scratch_path(spark, "frequency")
    jobs.update_campaign_frequency(spark, df.filter(F.col("timestamp") < HISTORY_END), root)
    jobs.update_campaign_frequency(spark, df.filter(F.col("timestamp") >= ARRIVING_FROM), root)
    return jobs.frequency_table(spark, root).read().select("campaign_id", "engagement_count", "unique_users")


@query
def step_throughput(spark, sf_dir):
    steps = telemetry.step_throughput(views.step_metrics(spark, sf_dir))
    return flat(steps.select("seq", F.col("throughput_records_per_second").alias("throughput")))


@query
def lineage_summary(spark, sf_dir):
    lineage = views.step_metrics(spark, sf_dir).select(
        F.col("run_id").alias("pipeline_run_id"), "timestamp", F.col("input_count").alias("input_record_count"),
        F.col("output_count").alias("output_record_count"),
    )
    return flat(telemetry.lineage_summary(lineage))


@query
def recent_runs(spark, sf_dir):
    order = [F.desc("start_time"), F.desc("seq")]
    return flat(
        telemetry.retain_last(views.runs(spark, sf_dir), 20, order).select("run_id", "status", "start_time", "seq")
    )


@query
def retain_last_n(spark, sf_dir):
    order = [F.desc("timestamp"), F.desc("seq")]
    return telemetry.retain_last(views.request_log(spark, sf_dir), telemetry.KEEP_REQUESTS, order).select("seq", "endpoint")


@query
def run_summary(spark, sf_dir):
    return flat(telemetry.run_summary(views.runs(spark, sf_dir), views.step_metrics(spark, sf_dir)))


def _latency(spark: SparkSession, sf_dir: str, minutes: int | None) -> DataFrame:
    requests = views.request_log(spark, sf_dir)
    return flat(telemetry.latency_stats(requests, requests.agg(F.max("timestamp")).scalar(), minutes))


@query
def latency_stats(spark, sf_dir):
    return _latency(spark, sf_dir, None)


@query
def latency_recent(spark, sf_dir):
    return _latency(spark, sf_dir, telemetry.WINDOW_MINUTES)


@query
def latency_sketched(spark, sf_dir):
    """From stored sketches of each endpoint and minute: counts and means, and whether each percentile's rank is near the wanted one."""
    requests, path = views.request_log(spark, sf_dir), scratch_path(spark, "sketches")
    # the log arrives in two batches, which share minutes
    for half in (0, 1):
        telemetry.minute_sketches(requests.filter(F.col("seq") % 2 == half)).write.mode("append").parquet(path)
    stats = materialize(telemetry.sketched_latency(telemetry.merged_sketches(spark.read.parquet(path)), F.current_timestamp(), None), "stats")
    ms = F.col("duration_seconds") * 1000
    below = [F.count_if(ms <= F.col(n)).alias(f"{n}_below") for n in telemetry.PERCENTILES]
    # an endpoint has one row of statistics
    ranks = requests.join(F.broadcast(stats), "endpoint").groupBy("endpoint", "count", "avg_latency_ms").agg(*below)
    near = [(F.abs(F.col(f"{n}_below") / F.col("count") - p) < 0.03).alias(f"{n}_near") for n, p in telemetry.PERCENTILES.items()]
    return flat(ranks.select("endpoint", "count", "avg_latency_ms", *near))


@query
def latency_anomalies(spark, sf_dir):
    """A low threshold, so that some step exceeds it."""
    order = [F.desc("timestamp"), F.desc("seq")]
    return flat(telemetry.latency_anomalies(views.step_metrics(spark, sf_dir), 0.5, order=order).drop("timestamp"))


@query
def embed_messages(spark, sf_dir):
    """Whole documents, as (document, position, value) of the non-zero entries."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    entries = embed(docs, "text", dim=DIM).select("doc_id", F.posexplode("embedding").alias("position", "v"))
    return flat(entries.filter(F.col("v") != 0).select("doc_id", "position", F.col("v").cast("double").alias("value")))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _asking(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))


def _hits(df: DataFrame) -> DataFrame:
    return flat(df.select("qid", "id", "distance", F.col("rank").cast("bigint").alias("rank")))


@query
def knn_exact(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return _hits(knn.knn(_asking(vectors), knn.build_index(vectors, DIM, nlist=CELLS, block=20), 5, query_block=10))


@query
def knn_filtered(spark, sf_dir):
    """Searches of one saved index, each after a metadata filter: only vectors of one label are candidates."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "index")
    knn.build_index(vectors, DIM, nlist=CELLS, facets=["label"], path=path)
    index = knn.load_index(spark, path)
    found = [_hits(knn.knn(_asking(vectors), index, 5, where=F.col("label") == label)).withColumn("label", F.lit(label)) for label in (3, 7)]
    return found[0].unionByName(found[1])


@query
def knn_growing(spark, sf_dir):
    """An index that grows: half of the labels, then an overlapping rest with other vectors for those it replaces, then deletions
    and their return. It answers like one that is built anew."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "index")
    early = vectors.filter("label < 6")
    turned = F.when(F.col("label") >= 4, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding"))
    knn.build_index(early.withColumn("embedding", turned), DIM, nlist=CELLS, trainer="kmeans", block=20, path=path)
    knn.append(knn.load_index(spark, path), vectors.filter("label >= 4"))
    knn.delete(knn.load_index(spark, path), vectors.filter("label IN (1, 8)"))
    knn.append(knn.load_index(spark, path), vectors.filter("label IN (1, 8)"))
    return _hits(knn.knn(_asking(vectors), knn.load_index(spark, path), 5))


@query
def stream_index(spark, sf_dir):
    """Vectors as a stream, each delivered twice, into a stored index that is then searched in every cell by codes."""
    vectors = _vectors(spark, sf_dir)
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "index")
    knn.build_index(vectors.filter("label = 0"), DIM, nlist=CELLS, path=path)
    for _ in range(2):
        vectors.write.mode("append").parquet(source)
    arriving = spark.readStream.schema(vectors.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream.maintain_index(arriving, path, scratch_path(spark, "stream")).awaitTermination()
    return _hits(knn.knn(_asking(vectors), knn.load_index(spark, path), 5, nprobe=CELLS, refine=100))


@query
def knn_ivf(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    index = knn.build_index(vectors, DIM, nlist=knn.NLIST, trainer="kmeans")
    return _hits(knn.knn(_asking(vectors), index, 5, nprobe=knn.NPROBE))


@query
def knn_ivf_all_cells(spark, sf_dir):
    """The approximate search with every cell probed, over an index that was saved and loaded: exact."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "index")
    knn.build_index(vectors, DIM, nlist=CELLS, trainer="kmeans").save(path)
    return _hits(knn.knn(_asking(vectors), knn.load_index(spark, path), 5, nprobe=CELLS, refine=100))


@query
def knn_ivf_recall(spark, sf_dir):
    """How many exact neighbours the default search finds, where it is used: at least 0.9 of the 5 and of the 50 nearest."""
    vectors = _vectors(spark, sf_dir)
    index = knn.build_index(vectors, DIM, nlist=knn.NLIST, trainer="kmeans")
    asking, found = _asking(vectors), []
    for k in (recommend.SIMILAR_USERS, recommend.SIMILAR_USERS * recommend.POOL_FACTOR):
        share = knn.recall(knn.knn(asking, index, k, nprobe=knn.NPROBE), knn.knn(asking, index, k))
        found.append(share.select(F.lit(k).alias("k"), "expected", (F.col("recall") >= 0.9).alias("enough")))
    return found[0].unionByName(found[1])


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vector table that the recommendation steps read: ids and vectors. They read no text, so none is stored."""
    return materialize(graph.with_message_id(views.embedded(spark, sf_dir)).drop("message"), "embedded")


@query
def user_centroids(spark, sf_dir):
    df = recommend.user_centroids(views.embedded(spark, sf_dir))
    return df.select("userid", micros(F.col("centroid"), 100_000).alias("centroid"))


@query
def similar_users_vector(spark, sf_dir):
    similar = recommend.similar_users_vector(_messages(spark, sf_dir), DIM, search="exact", nlist=CELLS)
    return flat(similar.withColumn("rank", F.col("rank").cast("bigint")))


def _flat_recommendations(df: DataFrame) -> DataFrame:
    extra = [c for c in ("explanation",) if c in df.columns]
    return flat(
        df.select(
            "user_id", "campaign_id", "score", "confidence", *extra, F.col("rank").cast("bigint").alias("rank"), "metadata.*"
        )
    )


@query
def recommendations(spark, sf_dir):
    return _flat_recommendations(recommend.recommendations(_messages(spark, sf_dir), DIM, search="exact", nlist=CELLS))


@query
def recommendations_filtered(spark, sf_dir):
    return _flat_recommendations(
        recommend.recommendations(_messages(spark, sf_dir), DIM, search="exact", nlist=CELLS, min_confidence=CONFIDENT, include_explanation=False)
    )


@query
def recommendations_fallback(spark, sf_dir):
    everyone = _everyone(spark, sf_dir).withColumnRenamed("user_id", "userid")
    return _flat_recommendations(
        recommend.recommendations(
            _messages(spark, sf_dir), DIM, search="exact", nlist=CELLS, include_explanation=False, fallback=True, users=everyone
        )
    )


@query
def recommendations_two_stage(spark, sf_dir):
    """Approximate retrieval, then the full score."""
    return _flat_recommendations(recommend.recommendations(_messages(spark, sf_dir), DIM, search="ivf"))


@query
def recommendations_ivf_all_cells(spark, sf_dir):
    """The two-stage way with every cell probed and all candidates compared: the same as the exact one."""
    return _flat_recommendations(
        recommend.recommendations(_messages(spark, sf_dir), DIM, search="ivf", nlist=CELLS, nprobe=CELLS, refine=10_000)
    )


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as their source delivers them: four text fields, time with a zone."""
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return views.interactions(spark, sf_dir, message=True).select("userid", "message", time.alias("timestamp"), "campaign")


def _write_lines(df: DataFrame, path: str) -> None:
    """JSON Lines, packed: whole texts take a third of the space. A packed file is read by one task, so none gets long."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).json(path)


def _digest(df: DataFrame) -> DataFrame:
    return flat(df.select("userid", "campaign", "timestamp", F.md5("message").alias("message_md5")))


@query
def events_from_json_lines(spark, sf_dir):
    """Every event written as JSON Lines and read back, with its processing time set."""
    path = scratch_path(spark, "json_events")
    _write_lines(_event_texts(spark, sf_dir), path)
    read = event_source.read_events(spark, path, multi_line=False)
    return _digest(read.filter(F.col("processing_timestamp").isNotNull()))


@query
def events_with_rejects(spark, sf_dir):
    """The same where each fifth time cannot be read: counts of good and rejected records by reason."""
    path = scratch_path(spark, "mixed_events")
    texts = _event_texts(spark, sf_dir)
    spoilt = F.when(F.col("userid").endswith("5"), "never").otherwise(F.col("timestamp"))
    _write_lines(texts.withColumn("timestamp", spoilt), path)
    good, rejects = event_source.read_events_with_rejects(spark, path)
    parts = good.select(F.lit("good").alias("reason"), "userid").unionByName(rejects.select("reason", "userid"))
    return parts.groupBy("reason", "userid").agg(F.count("*").alias("n"))


@query
def raw_events_by_day(spark, sf_dir):
    """Raw events stored by day, twice, and read back: a rerun doubles nothing."""
    path, events = scratch_path(spark, "raw_events"), views.interactions(spark, sf_dir, message=True).drop("event_id")
    for _ in range(2):
        event_source.write_raw_by_date(events, path)
    return _digest(spark.read.parquet(path).filter(F.col("event_date") == F.to_date("timestamp")))


@query
def embeddings_stored(spark, sf_dir):
    """All messages with their vectors, saved and loaded."""
    path = scratch_path(spark, "embeddings")
    tables.save_embeddings(views.embedded(spark, sf_dir), path)
    return tables.load_embeddings(spark, path).select("event_id", micros(F.col("embedding")).alias("embedding"))


@query
def csv_export(spark, sf_dir):
    """User engagement as CSV, read back as text."""
    path = scratch_path(spark, "csv")
    engagement = metrics.user_engagement(views.interactions(spark, sf_dir))
    tables.export_csv(engagement.withColumn("last_active", F.col("last_active").cast("string")), path)
    read = spark.read.option("header", True).option("escape", "\\").csv(path)
    return read.withColumn("message_count", F.col("message_count").cast("bigint"))


@query
def document_store(spark, sf_dir):
    """History, then an overlapping batch, put into the stored document table: ids and what the second write did."""
    path, df = scratch_path(spark, "documents"), views.interactions(spark, sf_dir, message=True)
    tables.store_documents(spark, df.filter(F.col("timestamp") < HISTORY_END), path)
    done = tables.store_documents(spark, df.filter(F.col("timestamp") >= ARRIVING_FROM), path)
    stored = spark.read.parquet(path).select("message_id", "userid", F.md5("message").alias("message_md5"))
    return stored.select("*", *[F.lit(done[k]).cast("bigint").alias(k) for k in ("inserted", "updated")])


@query
def stream_documents(spark, sf_dir):
    """The messages as a stream into the document table; every one arrives twice."""
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "stream_documents")
    texts = _event_texts(spark, sf_dir)
    _write_lines(texts.unionByName(texts), source)
    arriving = stream.read_event_stream(spark, source)
    stream.maintain_documents(arriving, path, scratch_path(spark, "stream"), delay="31 days").awaitTermination()
    return spark.read.parquet(path).select("message_id", "userid", F.md5("message").alias("message_md5"))


@query
def stream_embeddings(spark, sf_dir):
    """The messages as a stream, embedded per micro-batch and compacted."""
    source, path, whole = (scratch_path(spark, n) for n in ("arriving", "stream_vectors", "compacted"))
    _write_lines(_event_texts(spark, sf_dir), source)
    arriving = stream.read_event_stream(spark, source)
    stream.maintain_embeddings(arriving, path, scratch_path(spark, "stream"), dim=DIM, delay="31 days").awaitTermination()
    tables.compact(spark, path, whole)
    return spark.read.parquet(whole).select("message_id", micros(F.col("embedding"), 100_000).alias("embedding"))


@query
def stream_daily_counts(spark, sf_dir):
    """The events as a stream into a table of daily counts."""
    schema = views.table(spark, sf_dir, "events").schema
    campaign = F.nullif(F.concat(F.lit("c"), F.get_json_object("props", "$.k")), F.lit("c0"))
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select(campaign.alias("campaign"), F.col("ts").cast("timestamp").alias("timestamp"))
    )
    path = scratch_path(spark, "daily_counts")
    stream.maintain_daily_counts(arriving, path, scratch_path(spark, "stream"), delay="31 days").awaitTermination()
    return flat(spark.read.schema(stream.DAILY_COUNTS).parquet(path))


@query
def stream_distinct_users(spark, sf_dir):
    """The events as a stream of three batches into bitmaps: messages and distinct users by day, by campaign, and by both."""
    source, root = scratch_path(spark, "arriving"), scratch_path(spark, "distinct")
    events = views.interactions(spark, sf_dir).select("userid", "campaign", F.col("timestamp").cast("timestamp").alias("timestamp"))
    for part in range(3):
        events.filter(F.pmod(F.xxhash64("userid", "timestamp"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream.maintain_distinct_users(arriving, root, scratch_path(spark, "stream")).awaitTermination()
    bitmaps = distinct.stored_bitmaps(spark, root)
    day, campaign = F.col("activity_date").cast("string").alias("activity_date"), F.col("campaign").alias("campaign_id")
    both = distinct.distinct_users(bitmaps, ["activity_date", "campaign"]).select(F.lit("both").alias("by"), day, campaign, "message_count", "unique_users")
    days = distinct.distinct_users(bitmaps, ["activity_date"]).select(F.lit("day"), day, F.lit(None).cast("string"), "message_count", "unique_users")
    campaigns = distinct.distinct_users(bitmaps, ["campaign"]).select(F.lit("campaign"), F.lit(None).cast("string"), campaign, "message_count", "unique_users")
    return both.union(days).union(campaigns)


def _tally(name: str, df: DataFrame, key: Column, n: Column) -> DataFrame:
    return df.select(F.lit(name).alias("table"), key.cast("string").alias("key"), n.cast("bigint").alias("n"))


@query
def created_tables(spark, sf_dir):
    """The declared tables, created, filled from the events, and read back by their names."""
    database = f"parley_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    engagement, performance, daily, frequency = tables.create_tables(spark, database)
    df = views.interactions(spark, sf_dir)
    tables.fill_table(metrics.user_engagement(df), engagement)
    tables.fill_table(metrics.campaign_performance(df), performance)
    tables.fill_table(metrics.daily_activity(df), daily)
    tables.fill_table(metrics.campaign_engagement_frequency(df), frequency)
    out = _tally("user_engagement", spark.table(engagement), F.col("user_id"), F.col("message_count"))
    out = out.union(_tally("campaign_performance", spark.table(performance), F.col("campaign_id"), F.col("total_messages")))
    days = F.concat_ws(" ", F.col("activity_date").cast("string"), F.col("user_id"))
    out = out.union(_tally("user_activity_daily", spark.table(daily), days, F.col("message_count")))
    return out.union(_tally("campaign_engagement_frequency", spark.table(frequency), F.col("campaign_id"), F.col("unique_users")))


def _metric_tallies(spark: SparkSession, root: str) -> DataFrame:
    read = spark.read.parquet
    out = _tally("user_engagement", read(f"{root}/user_engagement"), F.col("user_id"), F.col("message_count"))
    out = out.union(_tally("campaign_performance", read(f"{root}/campaign_performance"), F.col("campaign_id"), F.col("total_messages")))
    days = F.concat_ws(" ", F.col("activity_date").cast("string"), F.col("user_id"))
    out = out.union(_tally("user_activity_daily", read(f"{root}/user_activity_daily"), days, F.col("message_count")))
    report = spark.read.json(f"{root}/reports/analytics_report")
    return out.union(_tally("report", report, F.lit("total_messages"), F.col("summary.total_messages")))


@query
def metrics_job_tables(spark, sf_dir):
    """The metrics job, run twice, and the tables and the report that it leaves."""
    root, df = scratch_path(spark, "metrics_job"), views.interactions(spark, sf_dir)
    for _ in range(2):
        jobs.metrics_job(spark, df, root)
    return _metric_tallies(spark, root)


@query
def whole_run_tables(spark, sf_dir):
    """The whole pipeline over all events as JSON Lines, and what it leaves: metrics, documents, vectors, graph, frequencies, run log."""
    source, root = scratch_path(spark, "run_events"), scratch_path(spark, "run")
    _write_lines(_event_texts(spark, sf_dir), source)
    jobs.run_pipeline(spark, root, source, dim=DIM, multi_line=False)
    read, n = spark.read.parquet, F.count("*").alias("n")
    out = _metric_tallies(spark, root)
    for name, key in (("documents", "userid"), ("vectors", "user_id"), ("graph/sent", "src"), ("graph/about", "dst"), ("step_metrics", "step_name")):
        out = out.union(_tally(name, read(f"{root}/{name}").groupBy(key).agg(n), F.col(key), F.col("n")))
    frequency = jobs.frequency_table(spark, root).read()
    return out.union(_tally("frequency", frequency, F.col("campaign_id"), F.col("unique_users")))
