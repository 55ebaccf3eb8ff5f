from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import embed, knn, recommend


def _table(spark, x, extra=None):
    rows = [(i, [float(v) for v in row], f"u{i % 7}") for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, user_id string")


def _by_hand(queries, x, k):
    out = {}
    for q, v in queries:
        d = ((x.astype(np.float32).astype(float) - v) ** 2).sum(axis=1)
        out[q] = sorted((round(float(dist), 6), i) for i, dist in enumerate(d))[:k]
    return out


def _collect(hits):
    out = {}
    for r in hits.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append((round(r["distance"], 6), r["id"]))
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 4
    x = centres[rng.integers(0, 6, 150)] + rng.normal(size=(150, 8))
    # a third of all vectors are one and the same point, so ties and one hot cell are unavoidable
    return np.concatenate([x, np.zeros((75, 8))]).astype(np.float32)


@pytest.mark.parametrize("nlist,vector_block,query_block", [(1, 20_000, 4_000), (12, 20, 5), (225, 1000, 1000)])
def test_exact_knn_equals_brute_force(spark, points, nlist, vector_block, query_block):
    queries = [(i, points[i * 9].astype(float) + 0.05 * (i % 2)) for i in range(25)]
    qdf = spark.createDataFrame([(q, [float(a) for a in v]) for q, v in queries], "qid long, qvec array<double>")
    index = knn.build_index(_table(spark, points), 8, nlist=nlist, block=vector_block)
    hits = knn.knn(qdf, index, 12, carry=["user_id"], query_block=query_block)
    assert _collect(hits) == _by_hand(queries, points, 12)
    assert all(r["user_id"] == f"u{r['id'] % 7}" for r in hits.collect())


def test_nan_and_null_elements_have_no_neighbours(spark, points):
    """A broken vector in every cell changes nothing for the others, and a broken query gets no answer."""
    x = points[:150]
    broken = [(1000 + i, [float(v) for v in row], "x") for i, row in enumerate(x[::10])]
    for i, (_, v, _) in enumerate(broken):
        v[i % 8] = float("nan") if i % 2 else None
    table = _table(spark, x)
    both = table.unionByName(spark.createDataFrame(broken, table.schema))
    queries = [(i, x[i * 5].astype(float)) for i in range(25)]
    qdf = spark.createDataFrame([(q, [float(a) for a in v]) for q, v in queries] + [(99, broken[1][1])], "qid long, qvec array<double>")
    assert _collect(knn.knn(qdf, knn.build_index(both, 8, nlist=12), 5)) == _by_hand(queries, x, 5)


def test_saved_index(spark, points, tmp_path):
    table = _table(spark, points)
    queries = table.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec")).filter("qid < 20")
    built = knn.build_index(table, 8, nlist=12)
    built.save(str(tmp_path / "index"))
    loaded = knn.load_index(spark, str(tmp_path / "index"))
    assert _collect(knn.knn(queries, loaded, 5)) == _collect(knn.knn(queries, built, 5))
    assert _collect(knn.knn(queries, loaded, 5, nprobe=2)) == _collect(knn.knn(queries, built, 5, nprobe=2))
    # with every cell and enough candidates the codes lose nothing
    assert _collect(knn.knn(queries, loaded, 5, nprobe=12, refine=50)) == _collect(knn.knn(queries, built, 5))
    with pytest.raises(FileNotFoundError):
        knn.load_index(spark, str(tmp_path / "none"))


def _searches(spark, index, x, k=7):
    qdf = spark.createDataFrame([(i, [float(a) for a in x[i]]) for i in range(0, len(x), 7)], "qid long, qvec array<double>")
    return _collect(knn.knn(qdf, index, k)), _collect(knn.knn(qdf, index, k, nprobe=len(index.pivots), refine=60))


def test_an_index_leaves_no_copy_of_its_vectors(spark, points, tmp_path, monkeypatch):
    """What an index was built from in the scratch folder goes once it holds the vectors."""
    made = []
    stored = knn.materialize
    monkeypatch.setattr(knn, "materialize", lambda df, name, *a: made.append(stored(df, name, *a)) or made[-1])
    vectors = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, embedding array<float>")
    index = knn.build_index(vectors, points.shape[1], nlist=3, path=str(tmp_path / "i"))
    files = [f for df in made for f in df.inputFiles()]
    assert files and not any(Path(f.removeprefix("file://")).exists() for f in files)
    assert index.rows.count() == len(points) == knn.load_index(spark, str(tmp_path / "i")).rows.count()


def test_growing_index(spark, points, tmp_path):
    """Appended, replaced, deleted and returned rows, in lists that overflow, against brute force after each step."""
    path, x = str(tmp_path / "index"), points[:150].copy()
    schema = "id long, embedding array<float>, user_id string"

    def rows(ids, of):
        return spark.createDataFrame([(int(i), [float(v) for v in of[i]], f"u{i % 7}") for i in ids], schema)

    def brute(alive, of):
        q = [(i, x[i].astype(float)) for i in range(0, len(x), 7)]
        ids = sorted(alive)
        found = _by_hand(q, of[ids], 7)
        return {i: sorted((d, ids[j]) for d, j in hits) for i, hits in found.items()}

    def check(alive, of):
        index = knn.load_index(spark, path)
        want = brute(alive, of)
        for got in _searches(spark, index, x):
            assert {i: sorted(h) for i, h in got.items()} == want
        assert index.counts.sum() == index.live().count() == len(alive)

    knn.build_index(rows(range(60), x), 8, nlist=6, block=12, facets=["user_id"], path=path)
    # 40 to 59 replaced by other vectors, and new ones; a repeated id counts once
    moved = x.copy()
    moved[40:60] = -x[40:60]
    more = rows(range(40, 120), moved)
    grown = knn.append(knn.load_index(spark, path), more.unionByName(rows([119], moved)))
    assert len(grown.list_cell) > 12 and grown.generation == 2 and grown.counts.sum() == 120
    knn.delete(knn.load_index(spark, path), spark.createDataFrame([(i,) for i in (0, 41, 119, 999)], "id long"))
    knn.append(knn.load_index(spark, path), rows([*range(120, 150), 0], moved), replacing=False)
    # an unusable vector takes away what was there
    knn.append(knn.load_index(spark, path), spark.createDataFrame([(5, None, "u5")], schema))
    alive = set(range(150)) - {5, 41, 119}
    check(alive, moved)
    index = knn.load_index(spark, path)
    for where, passes in ((F.col("user_id") == "u3", lambda i: i % 7 == 3),):
        qdf = spark.createDataFrame([(1, [0.0] * 8)], "qid long, qvec array<double>")
        some = sorted(i for i in alive if passes(i))
        want = sorted((round(float((moved[i].astype(float) ** 2).sum()), 6), i) for i in some)[:7]
        assert _collect(knn.knn(qdf, index, 7, where=where)).get(1, []) == want
        # few cells are asked for, but cells go on until they hold enough that pass
        assert len(_collect(knn.knn(qdf, index, 7, nprobe=1, where=where)).get(1, [])) == len(want)
        assert index.cells_passing(where).sum() == len(some)
    index.save(str(tmp_path / "compact"))
    compact = knn.load_index(spark, str(tmp_path / "compact"))
    assert compact.generation == 1 and compact.rows.count() == len(alive) and index.cells_passing(F.col("user_id") == "none").sum() == 0


def test_a_failed_append_changes_nothing(spark, points, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    knn.build_index(_table(spark, points[:50]), 8, nlist=4, path=path)

    def fails(index):
        raise OSError("disk full")

    monkeypatch.setattr(knn, "_write_state", fails)
    with pytest.raises(OSError):
        knn.append(knn.load_index(spark, path), _table(spark, points[:80]))
    monkeypatch.undo()
    index = knn.load_index(spark, path)
    assert index.generation == 1 and index.live().count() == 50
    grown = knn.append(index, _table(spark, points[:80]))
    assert grown.live().count() == knn.load_index(spark, path).live().count() == 80


def test_appending_to_an_empty_index(spark, points, tmp_path):
    path = str(tmp_path / "index")
    knn.build_index(_table(spark, points[:0]), 8, path=path)
    knn.append(knn.load_index(spark, path), _table(spark, points[:30]))
    qdf = spark.createDataFrame([(0, [0.0] * 8)], "qid long, qvec array<double>")
    assert _collect(knn.knn(qdf, knn.load_index(spark, path), 3)) == _by_hand([(0, np.zeros(8))], points[:30], 3)


def test_only_queries_are_shuffled(spark, points, tmp_path):
    """In every executed stage of a search, what reads the index's table has no exchange above it but the last top-k."""
    path = str(tmp_path / "index")
    knn.build_index(_table(spark, points), 8, nlist=12, path=path)
    index = knn.load_index(spark, path)
    table = _table(spark, points)
    queries = table.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    plans = []
    meet = knn._meet

    def watched(*args):
        found = meet(*args)
        found.collect()
        plans.append(found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return found

    knn._meet = watched
    try:
        knn.knn(queries, index, 5).collect()
        knn.knn(queries, index, 5, nprobe=3).collect()
    finally:
        knn._meet = meet
    # two rounds of the exact search, codes and vectors of the approximate one
    assert len(plans) == 4
    for plan in plans:
        met, scan = plan.index("FlatMapCoGroupsInArrow"), plan.index("Bucketed: true")
        side = plan[plan.rindex("Exchange", met, scan) :]
        # the one exchange is that of the queries; the side of the index begins after it, with a sort
        assert plan.count("Exchange hashpartitioning(list") == 1 and side.index("FileScan") > 0
        index_side = plan[plan.rindex(":- ", met, scan) :]
        assert "Exchange" not in index_side[index_side.rindex("+- ", 0, index_side.index("Bucketed: true")) :]


def test_cells_are_bounded(spark, points):
    with pytest.raises(ValueError):
        knn.build_index(_table(spark, points), 8, nlist=knn.MAX_CELLS + 1)


def test_more_neighbours_than_vectors(spark, points):
    index = knn.build_index(_table(spark, points[:5]), 8, nlist=3)
    qdf = spark.createDataFrame([(0, [0.0] * 8), (1, None)], "qid long, qvec array<double>")
    assert knn.knn(qdf, index, 10).count() == 5


def test_ivf_recall(spark, points):
    table = _table(spark, points[:150])
    queries = table.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    exact = knn.knn(queries, knn.build_index(table, 8), 5)
    index = knn.build_index(table, 8, nlist=10, trainer="kmeans")
    everything = knn.recall(knn.knn(queries, index, 5, nprobe=10), exact).first()["recall"]
    probed = knn.recall(knn.knn(queries, index, 5, nprobe=3), exact).first()["recall"]
    assert everything == 1.0
    assert probed >= 0.8


def test_index_skips_unusable_vectors(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [])], "id long, embedding array<float>")
    index = knn.build_index(df, 2)
    assert [r["id"] for r in index.rows.collect()] == [1]
    index.save(str(tmp_path / "cells"))
    assert knn.load_index(spark, str(tmp_path / "cells")).live().count() == 1


def test_hash_embedding(spark):
    texts = [(1, "Red red BLUE"), (2, "  "), (3, None), (4, "été, été!"), (5, "!!")]
    df = embed.embed(spark.createDataFrame(texts, "id int, message string"), dim=16)
    vectors = {r["id"]: np.array(r["embedding"]) for r in df.collect()}
    assert all(len(v) == 16 for v in vectors.values())
    assert not vectors[2].any() and not vectors[3].any() and not vectors[5].any()
    assert np.linalg.norm(vectors[1]) == pytest.approx(1) and np.linalg.norm(vectors[4]) == pytest.approx(1)


def test_encoder_hook(spark):
    def factory():
        def encode(texts):
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    df = spark.createDataFrame([("abc",), (" ",), (None,)], "message string")
    got = [r["embedding"] for r in embed.embed(df, encoder=factory, dim=2).collect()]
    assert got == [[3.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def _messages(spark, rows):
    df = spark.createDataFrame(rows, "userid string, campaign string, s int, embedding array<float>")
    return df.select(
        "userid", "campaign", F.concat_ws("-", "userid", "s").alias("message"),
        F.timestamp_seconds("s").alias("timestamp"), "embedding",
    )


def test_centroid_cap_takes_latest(spark):
    rows = [("a", "c", i, [float(i), 0.0]) for i in range(6)] + [("b", "c", 1, [4.0, 4.0])]
    got = {r["userid"]: (r["centroid"], r["message_count"]) for r in recommend.user_centroids(_messages(spark, rows), 2).collect()}
    assert got == {"a": ([4.5, 0.0], 2), "b": ([4.0, 4.0], 1)}


def test_messages_without_time_count_as_oldest(spark):
    df = spark.createDataFrame(
        [("a", 1, "m1"), ("a", None, "m2"), ("a", None, "m0"), ("b", None, "m3")], "userid string, s int, message_id string"
    ).withColumn("timestamp", F.timestamp_seconds("s"))
    kept = {cap: sorted(r["message_id"] for r in recommend.latest_messages(df, cap).collect()) for cap in (1, 2, 3)}
    assert kept == {1: ["m1", "m3"], 2: ["m0", "m1", "m3"], 3: ["m0", "m1", "m2", "m3"]}


def test_similar_users_fold(spark):
    rows = [
        ("q", "c1", 1, [0.0, 0.0]), ("a", "c1", 2, [1.0, 0.0]), ("a", "c2", 3, [2.0, 0.0]), ("a", "c2", 4, [3.0, 0.0]),
        ("b", "c3", 5, [0.0, 2.0]), ("far", "c4", 6, [9.0, 9.0]),
    ]
    df = _messages(spark, rows)
    similar = recommend.similar_users_vector(df, 2, k=5, pool=5, search="exact")
    got = [(r["similar_user_id"], r["distance"]) for r in similar.filter("user_id = 'q'").orderBy("rank").collect()]
    # a: ((1 + 4) / 2 + 9) / 2 = 5.75; the pool of five leaves "far" out
    assert got == [("b", 4.0), ("a", 5.75)]
    mean = recommend.similar_users_vector(df, 2, k=5, pool=5, search="exact", fold="mean").filter("user_id = 'q' and similar_user_id = 'a'")
    assert mean.first()["distance"] == pytest.approx(14 / 3)


def test_own_messages_can_fill_the_pool(spark):
    rows = [("q", "c1", i, [0.0, 0.01 * i]) for i in range(4)] + [("a", "c2", 9, [5.0, 5.0])]
    similar = recommend.similar_users_vector(_messages(spark, rows), 2, k=1, pool=4)
    assert {r["user_id"] for r in similar.collect()} == {"a"}


def test_recommendations_score_and_options(spark):
    rows = [
        ("q", "c1", 1, [0.0, 0.0]), ("a", "c1", 2, [1.0, 0.0]), ("a", "c2", 3, [1.0, 0.0]), ("b", "c2", 4, [0.0, 1.0]),
        ("b", None, 5, [0.0, 1.0]), ("b", "c2", 6, [0.0, 1.0]),
    ]
    df = _messages(spark, rows)
    recs = recommend.recommendations(df, 2)
    best = recs.filter("user_id = 'q'").orderBy("rank").collect()
    assert [r["campaign_id"] for r in best] == ["c2", "c1"]
    # c2: similarity 0.5 for both users, both of two users, the most frequent campaign
    assert best[0]["score"] == pytest.approx(0.3 * 0.5 + 0.2 + 0.5)
    assert best[0]["confidence"] == 1.0
    assert best[0]["metadata"]["similar_users"] == ["a", "b"]
    assert best[0]["explanation"] == "Recommended because 2 similar users engaged with this campaign"
    assert best[1]["score"] == pytest.approx(0.3 * 0.5 + 0.2 * 0.5 + 0.5 * 2 / 3)
    strict = recommend.recommendations(df, 2, min_confidence=0.9, include_explanation=False)
    assert "explanation" not in strict.columns and strict.filter("confidence < 0.9").count() == 0
    extra = spark.createDataFrame([("new",), ("q",)], "userid string")
    filled = recommend.recommendations(df, 2, fallback=True, users=extra).filter("user_id = 'new'").orderBy("rank").collect()
    assert [(r["campaign_id"], r["score"]) for r in filled] == [("c2", 0.5), ("c1", pytest.approx(1 / 3))]
    with pytest.raises(ValueError):
        recommend.recommendations(df, 2, top_k=21)


def test_request_for_one_user(spark):
    rows = [("q", "c1", 1, [0.0, 0.0]), ("a", "c2", 2, [1.0, 0.0]), ("b", "c3", 3, [0.0, 3.0])]
    df = _messages(spark, rows)
    everyone = recommend.recommendations(df, 2)
    one = recommend.recommendations(df, 2, for_users=["q"])
    key = ["user_id", "campaign_id", "score", "rank"]
    assert sorted(map(tuple, one.select(*key).collect())) == sorted(
        map(tuple, everyone.filter("user_id = 'q'").select(*key).collect())
    )


def test_ranking_limits_reach_below_the_shuffle(spark):
    """Rankings are cut per task before the shuffle, so a hot user cannot fill one task."""
    from parley.operators import metrics, telemetry
    from parley.plans import views

    sf_dir = "/root/testdata/sf0.001"
    frames = [
        recommend.message_cuts(recommend.with_message_id(views.embedded(spark, sf_dir))),
        metrics.user_engagement(views.interactions(spark, sf_dir)),
        telemetry.latency_anomalies(views.step_metrics(spark, sf_dir)),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_query_multiplies_tables(spark):
    from parley.plans.catalog import QUERIES

    for name in ("recommendations", "similar_users_vector", "knn_exact", "user_similarity", "report_summary"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_engagement_scans_events_once(spark):
    from parley.operators import metrics
    from parley.plans import views

    df = metrics.user_engagement(views.interactions(spark, "/root/testdata/sf0.001"))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_recall_is_that_of_the_default_search(spark, monkeypatch):
    """The query must measure the cells that recommendations probe by default: a poor default fails it."""
    import inspect

    from parley.operators import recommend
    from parley.plans import catalog

    defaults = inspect.signature(recommend.recommendations).parameters
    assert defaults["search"].default == "ivf" and defaults["nprobe"].default == knn.NPROBE
    assert inspect.signature(recommend.similar_users_vector).parameters["search"].default == "ivf"
    assert [(r["k"], r["enough"]) for r in catalog.QUERIES["knn_ivf_recall"](spark, "/root/testdata/sf0.1").collect()] == [(5, True), (50, True)]
    # the codes that are read are less than a tenth of the vectors' bytes
    assert knn.NPROBE / knn.NLIST * (0.5 / 4) < 0.1
    monkeypatch.setattr(knn, "NPROBE", 2)
    assert not any(r["enough"] for r in catalog.QUERIES["knn_ivf_recall"](spark, "/root/testdata/sf0.01").collect())
