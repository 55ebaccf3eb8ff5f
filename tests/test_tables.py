import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parley import schemas
from parley.operators import metrics, quantiles, telemetry
from parley.operators.upsert import upsert, upsert_counts
from parley.plans import jobs
from parley.plans.report import analytics_report
from parley.sources import tables
from parley.streaming import events as stream


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), (None, 3, 1)], "k string, v int, t int")
    batch = spark.createDataFrame([("b", 9, 2), ("c", 3, 2), ("c", 4, 3), (None, 5, 2)], "k string, v int, t int")
    once = upsert(old, batch, ["k"], [F.col("t")])
    expected = {("a", 1, 1), ("b", 9, 2), ("c", 4, 3), (None, 5, 2)}
    assert {tuple(r) for r in once.collect()} == expected and once.count() == 4
    assert {tuple(r) for r in upsert(once, batch, ["k"], [F.col("t")]).collect()} == expected
    assert {tuple(r) for r in upsert(old, batch.limit(0), ["k"]).collect()} == {tuple(r) for r in old.collect()}
    assert upsert(old.limit(0), batch, ["k"], [F.col("t")]).count() == 3
    named = batch.filter("k is not null")
    assert tuple(upsert_counts(old, named, ["k"]).first()) == (1, 2, 3)


def test_documents_by_day(spark, sample, tmp_path):
    path = str(tmp_path / "docs")
    assert tables.store_documents(spark, sample, path) == {"inserted": 8, "updated": 0, "errors": 0, "total": 8}
    later = sample.limit(2).withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day"))
    untimed = sample.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert tables.store_documents(spark, later.union(untimed), path)["inserted"] == 3
    other = untimed.withColumn("userid", F.lit("someone"))
    assert tables.store_documents(spark, sample.union(other), path) == {
        "inserted": 1, "updated": 8, "errors": 0, "total": 9,
    }
    stored = spark.read.parquet(path)
    assert stored.count() == 12 and stored.select("message_id").distinct().count() == 12
    assert stored.select("metadata.has_embedding", "metadata.embedding_dim").distinct().collect() == [(False, 0)]
    mine = tables.latest_documents(stored.filter("day = date'2026-01-10'"), 1, user="u1")
    assert [r["message"] for r in mine.collect()] == ["bought the blue bottle twice"]
    assert tables.latest_documents(stored, campaign="c1").count() >= 3


def test_merged_documents(spark, tmp_path, monkeypatch):
    """The same as a plain upsert, with repeats, ties and other rows on the same bits; texts of ids that occur once are not shuffled."""
    row = "message_id string, userid string, message string, timestamp timestamp, campaign string, processing_timestamp timestamp, n int"
    at = [datetime(2024, 1, d) for d in range(1, 5)]
    old = [(f"m{i}", f"u{i % 7}", "x" * i, at[i % 3], None, at[0], 0) for i in range(200)]
    new = [(f"m{i}", f"u{i % 7}", "x" * i, at[i % 3], None, at[1 + n % 2], n) for i in range(150, 300) for n in range(1 + i % 3)]
    new += [("m1", "u1", None, None, "c", None, 1), ("m1", "u1", "x", None, "c", None, 1), ("m1", None, "z", None, "c", None, 1)]
    stored, batch = (spark.createDataFrame(rows, row) for rows in (old, new))
    expected = sorted(map(repr, upsert(stored, batch, ["message_id"], [F.col("processing_timestamp")], null_keys=False).collect()))
    for bits in (tables.MARK_BITS, 64):
        monkeypatch.setattr(tables, "MARK_BITS", bits)
        assert sorted(map(repr, tables.merged_documents(stored, batch).collect())) == expected
    monkeypatch.undo()
    path = str(tmp_path / "docs")
    long = spark.range(300, numPartitions=3).select(
        F.concat(F.lit("u"), F.col("id")).alias("userid"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 50).alias("message"),
        F.lit("c").alias("campaign"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
    )
    assert tables.store_documents(spark, long, path)["inserted"] == 300
    # every task wrote the rows that it had read, packed
    files = list((tmp_path / "docs" / "day=2024-01-01").glob("*.zstd.parquet"))
    assert len(files) == 3 and spark.read.parquet(path).count() == 300


def test_keyed_table(spark, tmp_path):
    """An upsert leaves the files of partitions alone that none of its keys fall into."""
    path = tmp_path / "freq"
    table = tables.KeyedTable(spark, str(path), schemas.CAMPAIGN_ENGAGEMENT_FREQUENCY, ["campaign_id"], parts=8)
    assert table.read().count() == 0
    row = "campaign_id string, engagement_count long, unique_users long"

    def files():
        return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}

    table.upsert(spark.createDataFrame([(f"c{i}", i, 1) for i in range(40)] + [(None, 7, 1), ("c3", 100, 1)], row), [F.col("engagement_count")])
    assert table.read().count() == 41 and {r[0]: r[1] for r in table.read().collect()}["c3"] == 100
    before = files()
    table.upsert(spark.createDataFrame([("c5", 500, 2), (None, 9, 2)], row))
    after, got = files(), {r[0]: r[1] for r in table.read().collect()}
    assert got["c5"] == 500 and got[None] == 9 and got["c3"] == 100 and len(got) == 41
    parts = {f.split("/")[0] for f in before ^ after}
    assert 1 <= len(parts) <= 2 and {f for f in before if f.split("/")[0] not in parts} <= after
    table.upsert(spark.createDataFrame([], row))
    assert files() == after
    table.replace(spark.createDataFrame([("only", 1, 1)], row))
    assert [r[0] for r in table.read().collect()] == ["only"]


def test_conform(spark):
    df = spark.createDataFrame([("x",)], "campaign_id string")
    assert schemas.conform(df, schemas.CAMPAIGN_PERFORMANCE).schema.names == schemas.CAMPAIGN_PERFORMANCE.names
    with pytest.raises(ValueError):
        schemas.conform(df, schemas.CONVERSATION)


def test_sinks(spark, sample, tmp_path):
    engagement = metrics.user_engagement(sample)
    tables.export_csv(engagement, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "csv"))
    assert {r["user_id"]: r["preferred_campaigns"] for r in back.collect()}["u2"] == '["c1","c3"]'
    tables.save_table(engagement, str(tmp_path / "t"), flat=True)
    tables.save_table(engagement, str(tmp_path / "t"), mode="append", flat=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10
    tables.save_daily(metrics.daily_activity(sample), str(tmp_path / "d"))
    tables.save_daily(metrics.daily_activity(sample), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 5
    tables.compact(spark, str(tmp_path / "t"), str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == 10
    with_vectors = sample.withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    tables.save_embeddings(with_vectors, str(tmp_path / "e"))
    assert tables.load_embeddings(spark, str(tmp_path / "e")).count() == 8
    with pytest.raises(ValueError):
        tables.vector_rows(sample)


def test_create_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics_test")
    names = tables.create_tables(spark, "analytics_test")
    assert tables.create_tables(spark, "analytics_test") == names
    for name, schema in zip(names, schemas.TABLES.values()):
        assert [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]


def test_jdbc_options():
    plain = tables.jdbc_options("h", 5432, "db", "me", "pw", "t")
    assert plain["url"] == "jdbc:postgresql://h:5432/db" and plain["dbtable"] == "t"
    split = tables.jdbc_options("h", 5432, "db", "me", "pw", "t", "id", (0, 10), 4)
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == ("id", "10", "4")
    with pytest.raises(ValueError):
        tables.jdbc_options("h", 1, "d", "u", "p", partition_column="id")


def _steps(spark, durations):
    rows = [("s", float(d), i) for i, d in enumerate(durations)]
    return spark.createDataFrame(rows, "step_name string, duration_seconds double, i int").withColumn(
        "timestamp", F.timestamp_seconds("i")
    )


@pytest.mark.parametrize(
    "durations,fires",
    [([9], False), ([1, 9], False), ([1, 1, 1, 1, 9], False), ([1, 1, 1, 1, 1, 9], True), ([1] * 11 + [9], True), ([2, 2, 2], False)],
)
def test_latency_anomalies(spark, durations, fires):
    found = telemetry.latency_anomalies(_steps(spark, durations)).collect()
    assert bool(found) == fires
    if fires:
        assert found[0]["duration"] == 9.0 and found[0]["deviation"] > 0


def test_latency_anomaly_outside_own_history(spark):
    assert telemetry.latency_anomalies(_steps(spark, [1, 1.1, 9]), exclude_latest=True).count() == 1


def test_ranked_values_are_exact_for_any_sketch(spark):
    """A hot group, many equal values, and a sketch far too coarse: the ranks still are exact."""
    values = [float((i * 7919) % 1000) for i in range(900)] + [5.0] * 600
    rows = [("hot", v) for v in values] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 0.9999}
    for accuracy in (2, 20_000):
        got = {r["g"]: r for r in quantiles.ranked_values(df, "g", "v", shares, accuracy=accuracy).collect()}
        assert set(got) == {"hot", "one", "two"}
        for g in got:
            mine = sorted(v for h, v in rows if h == g)
            assert {n: got[g][n] for n in shares} == {n: mine[int(len(mine) * p)] for n, p in shares.items()}


def test_large_pieces_are_counted_again(spark):
    """One group of 10^6 different values, and pieces of a thousand at most that one task ranks."""
    df = spark.range(1_000_000).selectExpr("'hot' AS g", "double((id * 7919) % 1000000) AS v").unionByName(
        spark.range(300).selectExpr("'equal' AS g", "1.5D AS v")
    )
    shares = {"least": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 0.9999999}
    got = {r["g"]: r for r in quantiles.ranked_values(df, "g", "v", shares, piece_values=1000).collect()}
    assert {n: got["hot"][n] for n in shares} == {"least": 0.0, "p50": 500000.0, "p95": 950000.0, "p99": 990000.0, "top": 999999.0}
    assert {got["equal"][n] for n in shares} == {1.5} and got["hot"]["total"] == 1_000_000


def test_latency_sketches(spark):
    df = spark.range(20_000).selectExpr("concat('/', id % 2) AS endpoint", "(id % 1000) / 1000 AS duration_seconds", "timestamp_seconds(id % 7200) AS timestamp")
    halves = [telemetry.minute_sketches(df.filter(F.col("duration_seconds") < 0.5)), telemetry.minute_sketches(df.filter(F.col("duration_seconds") >= 0.5))]
    merged = telemetry.merged_sketches(halves[0].unionByName(halves[1]))
    assert merged.count() == 2 * 120
    got = telemetry.sketched_latency(merged, F.timestamp_seconds(F.lit(7200)), 60).collect()
    assert {r["endpoint"] for r in got} == {"/0", "/1"}
    exact = {r["endpoint"]: r for r in telemetry.latency_stats(df, F.timestamp_seconds(F.lit(7200)), 59).collect()}
    for r in got:
        assert r["count"] == exact[r["endpoint"]]["count"]
        assert abs(r["p50_latency_ms"] - exact[r["endpoint"]]["p50_latency_ms"]) < 30


def test_latency_window(spark):
    rows = [("/a", 0.1, 0), ("/a", 0.2, 5000), ("/b", 0.3, 5100)]
    df = spark.createDataFrame(rows, "endpoint string, duration_seconds double, s int").withColumn(
        "timestamp", F.timestamp_seconds("s")
    )
    now = F.timestamp_seconds(F.lit(5200))
    got = {r["endpoint"]: r["count"] for r in telemetry.latency_stats(df, now).collect()}
    assert got == {"/a": 1, "/b": 1}
    assert telemetry.overall_latency(df, now).first()["count"] == 2
    assert telemetry.overall_latency(df, F.timestamp_seconds(F.lit(10**6))).first()["count"] == 0


def test_empty_run_summary(spark):
    runs = spark.createDataFrame([], schemas.RUNS)
    steps = spark.createDataFrame([], schemas.STEP_METRICS)
    assert tuple(telemetry.run_summary(runs, steps).first()) == (0, 0, 0, 0.0, 0.0, 0)


def test_report(spark, sample):
    frames = metrics.user_engagement(sample), metrics.campaign_performance(sample), metrics.daily_activity(sample)
    row = analytics_report(sample, *frames).first()
    assert row["summary"]["total_messages"] == 8
    assert [u["user_id"] for u in row["top_performers"]["most_engaged_users"]] == ["u1", "u2", "u3", "u4", "u5"]
    assert row["top_performers"]["best_performing_campaigns"][0]["campaign_id"] == "c1"
    assert row["trends"]["messages_last_7_days"] == {"2026-01-10": 8}
    assert row["trends"]["user_activity"]["2026-01-10"]["active_users"] == 5


def _write_sample(path, sample, lines=False, **override):
    rows = [
        {"userid": r["userid"], "message": r["message"], "timestamp": r["timestamp"].strftime("%Y-%m-%dT%H:%M:%SZ"),
         "campaign": r["campaign"], **override}
        for r in sample.collect()
    ]
    path.write_text("\n".join(json.dumps(r) for r in rows) if lines else json.dumps(rows))


def test_pipeline(spark, sample, tmp_path):
    _write_sample(tmp_path / "in.json", sample)
    root = str(tmp_path / "out")
    for _ in range(2):
        run_id = jobs.run_pipeline(spark, root, str(tmp_path / "in.json"), dim=32)
    read = spark.read.parquet
    assert read(f"{root}/documents").count() == 8
    assert read(f"{root}/vectors").count() == 8
    assert read(f"{root}/user_activity_daily").count() == 5
    assert read(f"{root}/graph/similar_to").count() == 2
    assert set(read(f"{root}/latency_anomalies").columns) >= {"step_name", "duration", "expected_max"}
    assert jobs.frequency_table(spark, root).read().count() == 5
    assert read(f"{root}/runs").filter(F.col("status") == "completed").count() == 2
    assert read(f"{root}/step_metrics").filter(F.col("run_id") == run_id).count() == 6
    assert telemetry.lineage_summary(read(f"{root}/lineage")).filter(
        F.col("pipeline_run_id") == run_id
    ).first()["total_steps"] == 6
    assert jobs.user_lookup(spark, root, "u1").first()["message_count"] == 2
    assert jobs.campaign_lookup(spark, root, "c1").first()["total_messages"] == 3
    jobs.recommend_job(spark, read(f"{root}/embedded"), root, 32)
    assert read(f"{root}/recommendations").count() > 0


def test_pipeline_gate(spark, sample, tmp_path):
    _write_sample(tmp_path / "in.json", sample, timestamp="never")
    root = str(tmp_path / "out")
    with pytest.raises(ValueError, match="Schema validation failed"):
        jobs.run_pipeline(spark, root, str(tmp_path / "in.json"), dim=8)
    run = spark.read.parquet(f"{root}/runs").first()
    assert run["status"] == "failed" and "timestamp" in run["error"]
    assert spark.read.parquet(f"{root}/lineage").first()["step_name"] == "pipeline_failure"


def test_streams_equal_batch(spark, sample, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write_sample(folder / "a.jsonl", sample, lines=True)
    _write_sample(folder / "b.jsonl", sample, lines=True)
    events = stream.read_event_stream(spark, str(folder), files_per_batch=1)
    docs = str(tmp_path / "docs")
    stream.maintain_documents(events, docs, str(tmp_path / "cp1")).awaitTermination()
    assert spark.read.parquet(docs).count() == 8
    vectors = str(tmp_path / "vectors")
    stream.maintain_embeddings(events, vectors, str(tmp_path / "cp2"), dim=16).awaitTermination()
    assert spark.read.parquet(vectors).count() == 8
    expected = {"c1": 3, "c2": 2, "c3": 1, "c4": 1, "c5": 1}
    running = str(tmp_path / "running")
    stream.maintain_daily_counts(events, running, str(tmp_path / "cp3")).awaitTermination()
    assert {r["campaign_id"]: r["message_count"] for r in spark.read.parquet(running).collect()} == {c: 2 * n for c, n in expected.items()}
    for name, day in (("y", 3), ("z", 6)):
        later = sample.limit(1).withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(days=F.lit(day)))
        _write_sample(folder / f"{name}.jsonl", later, lines=True)
    closed = str(tmp_path / "closed")
    stream.maintain_daily_counts(events, closed, str(tmp_path / "cp4"), distinct=True).awaitTermination()
    first_day = spark.read.parquet(closed).filter("activity_date = date'2026-01-10'")
    assert {r["campaign_id"]: r["message_count"] for r in first_day.collect()} == expected


def test_expire_days(spark, sample, tmp_path):
    path = str(tmp_path / "docs")
    tables.store_documents(spark, sample, path)
    later = sample.withColumn("timestamp", F.col("timestamp") + F.expr("interval 5 days"))
    tables.store_documents(spark, later, path)
    assert tables.expire_days(spark, path, "2026-01-12") == ["2026-01-10"]
    assert spark.read.parquet(path).count() == 8


def test_request_log(spark, tmp_path):
    from datetime import datetime, timezone

    at = datetime(2026, 1, 10, tzinfo=timezone.utc)
    row = {"endpoint": "/r", "method": "GET", "status_code": 200, "duration_seconds": 0.5, "user_id": "u1", "timestamp": at}
    requests = spark.createDataFrame([row, row], schemas.REQUEST_LOG)
    jobs.log_requests(requests, str(tmp_path))
    log = spark.read.parquet(str(tmp_path / "request_log"))
    assert telemetry.latency_stats(log, F.lit(at)).first()["p50_latency_ms"] == 500.0


def test_stream_rejects_are_kept(spark, sample, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write_sample(folder / "a.jsonl", sample, lines=True)
    _write_sample(folder / "b.jsonl", sample, lines=True, timestamp="never")
    (folder / "c.jsonl").write_text("{not json\n")
    path = str(tmp_path / "rejects")
    stream.store_rejects(stream.read_reject_stream(spark, str(folder)), path, str(tmp_path / "cp")).awaitTermination()
    counts = {r["reason"]: r["count"] for r in spark.read.parquet(path).groupBy("reason").count().collect()}
    assert counts == {"bad timestamp": 8, "corrupt record": 1}
    good = str(tmp_path / "good")
    events = stream.read_event_stream(spark, str(folder))
    stream.maintain_embeddings(events, good, str(tmp_path / "cp2"), dim=8).awaitTermination()
    assert spark.read.parquet(good).count() == 8


def test_logs_are_kept_short(spark, tmp_path):
    from datetime import datetime, timezone

    rows = [("/r", "GET", 200, 0.1 * i, f"u{i}", datetime(2026, 1, 1 + i, tzinfo=timezone.utc)) for i in range(9)]
    names = ["endpoint", "method", "status_code", "duration_seconds", "user_id", "timestamp"]
    requests = spark.createDataFrame([dict(zip(names, r)) for r in rows], schemas.REQUEST_LOG)
    jobs.log_requests(requests, str(tmp_path), keep=4)
    kept = spark.read.parquet(str(tmp_path / "request_log"))
    assert sorted(r["user_id"] for r in kept.collect()) == ["u5", "u6", "u7", "u8"]


def test_a_cut_off_swap_is_undone(spark, tmp_path):
    from parley.session import recover_folder, swap_folder

    path = str(tmp_path / "log")
    spark.range(3).write.parquet(path + ".old")
    recover_folder(spark, path)
    assert spark.read.parquet(path).count() == 3
    spark.range(5).write.parquet(path + ".new")
    swap_folder(spark, path + ".new", path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "log.old").exists()


def test_every_late_row_is_counted(spark, tmp_path):
    """Also in batches whose progress Spark no longer keeps, and once for a batch that is stored twice."""
    from datetime import datetime, timedelta

    folder, table, kept = tmp_path / "in", str(tmp_path / "late"), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    schema = "userid string, campaign string, timestamp timestamp"
    start = datetime(2026, 1, 10)
    for i in range(8):
        # a row that moves the watermark on, and two that come too late: Spark drops by the watermark before the last batch
        rows = [("u", "c", start + timedelta(days=3 * i))] + [("u", f"late{j}", start + timedelta(minutes=i)) for j in range(2) if i > 2]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    listener = stream.LateRows(spark, table)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(listener)
    try:
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        query = stream.maintain_daily_counts(events, str(tmp_path / "daily"), str(tmp_path / "cp"), delay="1 hour")
        query.awaitTermination()
        assert len(query.recentProgress) <= 2
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(200):
            if stream.late_rows(spark, table).first() and stream.late_rows(spark, table).first()["dropped"] == 10:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    rows = stream.late_rows(spark, table).collect()
    assert [r["dropped"] for r in rows] == [10]
    spark.read.parquet(table).write.mode("append").parquet(str(tmp_path / "copy"))
    spark.read.parquet(table).write.mode("append").parquet(str(tmp_path / "copy"))
    assert stream.late_rows(spark, str(tmp_path / "copy")).first()["dropped"] == 10


def test_bitmaps_of_distinct_users(spark, tmp_path):
    """Batches that share users, days and campaigns, one of them replayed, against plain sets."""
    import random
    from datetime import datetime, timedelta

    from parley.operators import distinct

    rng, root = random.Random(3), str(tmp_path / "distinct")
    rows = [(f"u{rng.randrange(300)}" if rng.random() < 0.97 else None, rng.choice(["a", "b", None]), datetime(2026, 1, 1) + timedelta(hours=rng.randrange(72))) for _ in range(900)]
    rows += [(f"v{i}", "a", datetime(2026, 1, 2)) for i in range(40_000)]
    for i in (0, 1, 1, 2):
        part = spark.createDataFrame(rows[i::3], "userid string, campaign string, timestamp timestamp")
        distinct.store_batch(part, root, i)
    users = distinct.known_users(spark, f"{root}/users")
    assert users.count() == users.select("userid").distinct().count() == users.select("shard", "place").distinct().count()
    bitmaps = distinct.stored_bitmaps(spark, root)
    named = [r for r in rows if r[0]]
    for by, key in ((["campaign"], lambda r: (r[1],)), (["activity_date"], lambda r: (r[2].date(),)), ([], lambda r: ())):
        want = {}
        for r in named:
            want.setdefault(key(r), [set(), 0])[0].add(r[0])
            want[key(r)][1] += 1
        got = {tuple(r[c] for c in by): (r["unique_users"], r["message_count"]) for r in distinct.distinct_users(bitmaps, by).collect()}
        assert got == {k: (len(s), n) for k, (s, n) in want.items()}


def test_merged_days_leave_other_days_alone(spark, tmp_path):
    schema, path = "activity_date date, campaign_id string, message_count long, last_message timestamp", str(tmp_path / "daily")
    batches = [[("2026-01-01", "a", 1), ("2026-01-02", "a", 5), ("2026-01-01", None, 2)], [("2026-01-01", "a", 3), ("2026-01-03", "b", 1)], []]
    for rows in batches:
        batch = spark.createDataFrame(rows, "d string, c string, n long").selectExpr("date(d)", "c", "n", "timestamp'2026-01-05'")
        stream.merge_days(batch.toDF("activity_date", "campaign_id", "message_count", "last_message"), path, ["activity_date", "campaign_id"])
    got = {(str(r["activity_date"]), r["campaign_id"]): r["message_count"] for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {("2026-01-01", "a"): 3, ("2026-01-01", None): 2, ("2026-01-02", "a"): 5, ("2026-01-03", "b"): 1}


def test_scratch_scope_removes_its_tables(spark):
    import os

    from parley.session import materialize, scratch_root, scratch_scope

    before = set(os.listdir(scratch_root(spark)))
    with scratch_scope(spark):
        assert materialize(spark.range(3), "gone").count() == 3
    assert set(os.listdir(scratch_root(spark))) == before


def test_streamed_texts_travel_packed_and_whole(spark, tmp_path):
    """What the search for repeats shuffles is packed; empty, long and odd texts come back as they were, and stored vectors are packed too."""
    from parley.sources import tables
    from parley.streaming import events as stream

    texts = ["", "a" * 100_000, "é |\U0001f600", "plain", "plain"]
    rows = spark.createDataFrame([(f"u{min(i, 3)}", t, "2026-01-10T10:00:00Z", None) for i, t in enumerate(texts)], "userid string, message string, timestamp string, campaign string")
    rows.write.json(str(tmp_path / "in"))
    read = stream.read_event_stream(spark, str(tmp_path / "in"))
    path, whole = str(tmp_path / "vectors"), str(tmp_path / "whole")
    plan = stream.distinct_events(read)._jdf.queryExecution().analyzed().toString()
    assert plan.index("_unpack(") < plan.index("DeduplicateWithinWatermark") < plan.index("_pack(")
    stream.maintain_embeddings(read, path, str(tmp_path / "cp"), dim=8).awaitTermination()
    tables.compact(spark, path, whole)
    for folder in (path, whole):
        assert sorted(r["message"] for r in spark.read.parquet(folder).collect()) == sorted(set(texts))
    assert all(".zstd." in f.name for f in (tmp_path / "whole").glob("*.parquet"))
