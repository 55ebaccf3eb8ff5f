"""What grows with the tables: rows that a search sends, texts that need not move, parts of a batch."""

import glob
import gzip

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm.common import maybe_among
from parley.operators import embed, knn
from parley.plans import catalog, oracle
from parley.sources import tables


def _points(spark, n, dim=8):
    x = np.random.default_rng(5).normal(size=(n, dim)).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, embedding array<float>")


def _nearest(x, q, k):
    d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
    return sorted((round(float(v), 6), i) for i, v in enumerate(d))[:k]


def _pairs(hits):
    out = {}
    for r in hits.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append((round(r["distance"], 6), r["id"]))
    return out


@pytest.fixture(scope="module")
def searched(spark):
    """A search in very many short lists, and how many rows each meeting of queries and lists took and gave."""
    x, vectors = _points(spark, 400)
    index = knn.build_index(vectors, 8, nlist=8, block=5)
    asking = vectors.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    seen, meet = [], knn._meet

    def watched(left, visited, *rest):
        met = meet(left, visited, *rest)
        seen.append((left.count(), met.count()))
        return met

    knn._meet = watched
    try:
        exact = _pairs(knn.knn(asking, index, 3, query_block=10))
        coded = _pairs(knn.knn(asking, index, 3, nprobe=8, refine=100))
        whole = _pairs(knn.knn(asking, index, 3, nprobe=8, refine=1000))
    finally:
        knn._meet = meet
    return x, index, seen, (exact, coded, whole)


def test_a_query_travels_once_to_a_bin(searched):
    x, index, seen, found = searched
    bins = len(np.unique(index.list_bin))
    assert len(index.list_cell) >= 80 and bins <= 2 * knn.BINS
    for sent, given in seen:
        assert sent <= 400 * bins and given <= 400 * bins * 3
    want = {q: _nearest(x, q, 3) for q in range(400)}
    assert all(f == want for f in found)


def test_probed_cells_only(spark):
    """Where more are compared than are settled by codes, the cells that are not probed stay closed."""
    x, vectors = _points(spark, 200)
    index = knn.build_index(vectors, 8, nlist=10)
    asking = vectors.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    one = _pairs(knn.knn(asking, index, 2, nprobe=3, refine=2000))
    cells = {r["id"]: r["cell"] for r in index.rows.select("id", "cell").collect()}
    for q, hits in one.items():
        near = set(np.argsort(((index.pivots - x[q]) ** 2).sum(axis=1), kind="stable")[:3])
        inside = [i for i in range(200) if cells[i] in near]
        assert [i for _, i in hits] == [i for _, i in _nearest(x, q, 200) if i in inside][:2]


def test_filter_of_confidence_is_the_stated_one():
    assert catalog.CONFIDENT == 0.7 and ">= 0.7" in oracle.SQL["recommendations_filtered"]


def _tables(spark, folder):
    spark.createDataFrame([(i, f"text {i} " * 50) for i in range(7)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    events = [(i, i % 5, '{"k": %d}' % (i % 4), f"2024-01-{1 + i % 28:02d} 10:00:00", "click", float(i)) for i in range(60)]
    rows = spark.createDataFrame(events, "event_id long, user_id long, props string, ts string, event_type string, value double")
    rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(i, [0.5, 1.0]) for i in range(0, 60, 2)], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(i,) for i in range(9)], "c_custkey long").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_texts_are_joined_last(spark, tmp_path):
    """Whole texts are not shuffled again to meet the vectors, and tables of ids hold no texts."""
    folder = _tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog._checked(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        documents, joins = plan.index("text#"), [i for i in range(len(plan)) if plan.startswith("Join", i)]
        assert len(joins) == 2
        depth = {name: len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() for name in ("text#", "embedding#") if "Relation" in line and name in line}
        assert documents and depth["text#"] < depth["embedding#"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = catalog._identified(spark, folder)
    assert stored.agg(F.max(F.length("message"))).first()[0] == 64 and stored.count() == 60
    assert "message" not in catalog._messages(spark, folder).columns


def test_lines_are_packed(spark, tmp_path, monkeypatch):
    folder = _tables(spark, tmp_path / "in")
    monkeypatch.setattr(catalog, "LINES_PER_FILE", 20)
    catalog._write_lines(catalog._event_texts(spark, folder), str(tmp_path / "lines"))
    files = glob.glob(f"{tmp_path}/lines/*.json.gz")
    assert sum(len(gzip.open(f).readlines()) for f in files) == 60
    assert max(len(gzip.open(f).readlines()) for f in files) <= 20


def test_features_of_a_part_are_those_of_the_batch(monkeypatch):
    texts = pa.array(["one two two", None, "", "three " * 40, "Four four", "x"])
    whole = embed.hashed_features(texts, 16)
    monkeypatch.setattr(embed, "SLICE_BYTES", 12)
    assert [len(s) for s in embed._slices(texts)] == [3, 1, 2]
    assert (embed.hashed_features(texts, 16) == whole).all() and embed.hashed_features(texts[:0], 16).shape == (0, 16)


def test_compaction_keeps_rows_without_a_shuffle(spark, tmp_path):
    source, target = str(tmp_path / "small"), str(tmp_path / "whole")
    spark.range(1000).repartition(20).write.parquet(source)
    tables.compact(spark, source, target)
    assert len(glob.glob(f"{target}/*.parquet")) == 1 and sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(1000))


def test_texts_without_label_do_not_move(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(5000)] + [(None, "t")], "doc_id long, text string")
    keys = spark.createDataFrame([(i,) for i in range(0, 9000, 90)] + [(None,), (0,)], "doc_id long")
    kept = [r["doc_id"] for r in maybe_among(docs, keys, "doc_id").collect()]
    assert set(range(0, 5000, 90)) <= set(kept) and len(kept) < 1000
    assert maybe_among(docs, keys.limit(0), "doc_id").count() == 0


def test_search_far_from_the_origin_and_in_turns(spark, monkeypatch):
    """Single precision only picks candidates: vectors that differ in the last places of long numbers are told apart, in turns of few queries too."""
    rng = np.random.default_rng(5)
    x = (1000.0 + rng.integers(0, 40, (300, 6)) / 16.0).astype(np.float32)
    x[250:] = x[:50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    d = ((x[:, None, :].astype(float) - x[None].astype(float)) ** 2).sum(axis=2)
    want = {(q, int(i)) for q in range(300) for i in np.lexsort((np.arange(300), d[q]))[:4]}
    for kind, most in (("float", 100_000), ("double", 90)):
        monkeypatch.setattr(knn, "TASK_QUERIES", most)
        monkeypatch.setattr(knn, "TASKS", 1)
        vectors = spark.createDataFrame(rows, f"id long, embedding array<{kind}>")
        index = knn.build_index(vectors, 6, nlist=3)
        asking = vectors.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
        for options in ({}, {"nprobe": 3, "refine": 60}):
            assert {(r["qid"], r["id"]) for r in knn.knn(asking, index, 4, **options).collect()} == want
