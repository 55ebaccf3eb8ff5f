import json

from pyspark.sql import functions as F

from parley.operators import metrics, quality
from parley.operators.graph import with_message_id
from parley.sources.events import clean, ingest, parse_time, read_events, read_events_with_rejects, write_raw_by_date

EVENT = {"userid": "u1", "message": "hello", "timestamp": "2026-01-10T10:00:00Z", "campaign": "c1"}


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([EVENT, {**EVENT, "timestamp": "bad"}], indent=1))
    (tmp_path / "b.jsonl").write_text(json.dumps(EVENT) + "\n")
    rows = read_events(spark, str(tmp_path / "a.json")).orderBy(F.col("timestamp").desc_nulls_last()).collect()
    assert [str(r["timestamp"]) for r in rows] == ["2026-01-10 10:00:00", "None"]
    assert read_events(spark, str(tmp_path / "b.jsonl"), multi_line=False).count() == 1
    spark.conf.set("parley.input.path", str(tmp_path / "a.json"))
    assert ingest(spark).count() == 2


def test_rejects(spark, tmp_path):
    lines = [json.dumps(EVENT), json.dumps({**EVENT, "timestamp": "bad"}), "{broken"]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    good, rejects = read_events_with_rejects(spark, str(tmp_path / "x.jsonl"))
    assert good.count() == 1
    assert sorted(r["reason"] for r in rejects.collect()) == ["bad timestamp", "corrupt record"]


def test_time_formats(spark):
    texts = ["2026-01-10T10:00:00Z", "2026-01-10T10:00:00.25Z", "2026-01-10T12:00:00+02:00", "bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = [r[0] for r in df.select(parse_time(F.col("t"), strict=True).cast("string")).collect()]
    assert strict == ["2026-01-10 10:00:00", None, None, None, None]
    lenient = [r[0] for r in df.select(parse_time(F.col("t")).cast("string")).collect()]
    assert lenient == ["2026-01-10 10:00:00", "2026-01-10 10:00:00.25", "2026-01-10 10:00:00", None, None]


def test_clean(spark):
    long = "ä" * 1000
    rows = [
        ("u1", "hi", "c"), ("u1", "hi", "c"), (None, "hi", "c"), ("u1", None, "c"), ("u1", long + "x", "c"),
        ("u1", long + "y", "c"), ("u1", long + "y", "c"), ("u1", "  ", None),
    ]
    out = clean(spark.createDataFrame(rows, "userid string, message string, campaign string"))
    assert out.columns == ["userid", "message", "campaign"]
    # messages that differ beyond the limit stay apart although their shortened texts agree
    assert sorted(r["message"] for r in out.collect()) == sorted(["hi", "  ", long, long])


def test_raw_by_date_replaces_only_its_days(spark, sample, tmp_path):
    path = str(tmp_path / "raw")
    write_raw_by_date(sample, path)
    later = sample.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day"))
    write_raw_by_date(later, path)
    write_raw_by_date(later, path)
    assert spark.read.parquet(path).count() == 16


def test_raw_by_date_shuffles_nothing(spark, tmp_path):
    """Each of three tasks writes its rows of both days, packed."""
    rows = spark.range(60, numPartitions=3).selectExpr("concat('u', id) AS userid", "repeat('text ', 99) AS message", "timestamp'2024-01-01' + make_interval(0, 0, 0, id % 2) AS timestamp")
    write_raw_by_date(rows, str(tmp_path / "raw"))
    assert [len(list((tmp_path / "raw" / f"event_date=2024-01-0{d}").glob("*.zstd.parquet"))) for d in (1, 2)] == [3, 3]
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 60


def test_sample_metrics(sample):
    users = {r["user_id"]: r for r in metrics.user_engagement(sample).collect()}
    assert {u: r["message_count"] for u, r in users.items()} == {"u1": 2, "u2": 2, "u3": 2, "u4": 1, "u5": 1}
    assert {r["engagement_score"] for r in users.values()} == {"low"}
    assert users["u2"]["preferred_campaigns"] == ["c1", "c3"]
    campaigns = {r["campaign_id"]: r for r in metrics.campaign_performance(sample).collect()}
    assert (campaigns["c1"]["total_messages"], campaigns["c1"]["unique_users"]) == (3, 2)
    assert campaigns["c1"]["avg_sentiment"] == 0.75
    summary = metrics.report_summary(sample, metrics.user_engagement(sample)).first()
    assert tuple(summary) == (5, 5, 8, 1.0)
    assert tuple(metrics.daily_trend(metrics.daily_activity(sample)).first())[1:] == (5, 8)


def test_metrics_options_and_null_campaigns(spark):
    rows = [("a", None, 1), ("a", None, 2), ("a", "x", 3), ("a", "y", 4), ("a", "y", 5), ("b", None, 1)]
    df = spark.createDataFrame(rows, "userid string, campaign string, s int").withColumn(
        "timestamp", F.timestamp_seconds(F.col("s"))
    )
    first = {r["user_id"]: r["preferred_campaigns"] for r in metrics.user_engagement(df).collect()}
    assert first == {"a": ["x", "y"], "b": []}
    by_count = {r["user_id"]: r["preferred_campaigns"] for r in metrics.user_engagement(df, prefer_by="count").collect()}
    assert by_count["a"] == ["y", "x"]
    assert metrics.document_stats(df).first()["unique_campaigns"] == 3
    scores = {r["campaign_id"]: r["avg_sentiment"] for r in metrics.campaign_performance(df, "s").collect()}
    assert scores["y"] == 4.5
    empty = df.limit(0)
    assert metrics.report_summary(empty, metrics.user_engagement(empty)).first()["avg_engagement_score"] == 0.0


def test_quality(spark, sample):
    assert quality.validate_schema(sample) == (True, [])
    dirty = sample.withColumn("message", F.when(F.col("userid") != "u1", F.col("message")).otherwise("  "))
    dirty = dirty.withColumn("userid", F.when(F.col("userid") != "u5", F.col("userid")))
    ok, errors = quality.validate_schema(dirty)
    assert not ok
    assert sorted(errors) == [
        "Found 1 null values in required field: userid", "Found 2 empty values in required field: message",
    ]
    ok, errors = quality.validate_schema(sample.drop("message").withColumn("userid", F.lit(1)))
    assert sorted(errors) == [
        "Column userid type mismatch: expected string, got int", "Missing required column: message",
    ]
    profile = quality.detect_anomalies(dirty.withColumn("campaign", F.lit(""))).first()
    assert (profile["empty_messages"], profile["missing_campaigns"], profile["total_records"]) == (2, 8, 8)
    assert profile["anomaly_rate"] == 10 / 8 and profile["affected_rows"] == 8
    assert quality.detect_anomalies(sample.limit(0)).first()["anomaly_rate"] == 0.0


def test_embedding_checks(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],), ([1.0],), ([],), (None,)], "embedding array<float>")
    ok, errors = quality.validate_embeddings(df)
    assert not ok and errors == [
        "Found 1 null embeddings", "Found 1 empty embeddings",
        "Found 2 embeddings with wrong dimension (expected 2)",
    ]
    assert quality.validate_embeddings(df.limit(2)) == (True, [])
    assert quality.validate_embeddings(df.drop("embedding")) == (False, ["Missing 'embedding' column"])


def test_fingerprint_ignores_order_but_not_repeats(spark, sample):
    base = quality.table_fingerprint(sample).first()
    assert quality.table_fingerprint(sample.orderBy("message").repartition(3)).first() == base
    assert quality.table_fingerprint(sample.union(sample)).first() != base


def test_message_id_matches_hashlib(sample):
    import hashlib

    rows = with_message_id(sample.withColumn("campaign", F.lit(None).cast("string"))).collect()
    for r in rows:
        raw = f"{r['userid']}|None|{r['timestamp']}|{r['message']}"
        assert r["message_id"] == hashlib.sha256(raw.encode()).hexdigest()
