import itertools
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import graph, similar
from parley.operators.pairs import member_pairs


def test_sample_graph(sample):
    assert [tuple(r) for r in graph.user_similarity(sample).collect()] == [("u1", "u2", 1)]
    assert [tuple(r) for r in graph.similar_users(sample, "u2").collect()] == [("u1", 1)]
    assert graph.graph_nodes(sample).count() == 5 + 5 + 8
    assert graph.graph_edges(sample).count() == 16
    edges = graph.user_similarity(sample)
    assert [tuple(r) for r in graph.similar_users_from_edges(edges, "u2").collect()] == [("u1", 1)]
    best = similar.similar_users_all(sample).orderBy("user_id").collect()
    assert [tuple(r) for r in best] == [("u1", "u2", 1, 1), ("u2", "u1", 1, 1)]


def _pairs_by_hand(rows):
    campaigns = {}
    for u, c in rows:
        if u is not None and c is not None:
            campaigns.setdefault(u, set()).add(c)
    out = set()
    for a, b in itertools.combinations(sorted(campaigns), 2):
        w = len(campaigns[a] & campaigns[b])
        if w:
            out.add((a, b, w))
    return out


def test_similarity_with_a_hot_campaign_and_equal_sets(spark):
    """A third of all rows in one campaign, blocks far smaller than it, and many users with equal sets."""
    rng = random.Random(5)
    rows = [(f"u{i:03d}", "hot") for i in range(60)]
    rows += [(f"u{rng.randrange(90):03d}", f"c{rng.randrange(12)}") for _ in range(110)]
    rows += [("u000", "hot")] * 5 + [("lonely", None)]
    df = spark.createDataFrame(rows, "userid string, campaign string")
    for block in (7, 2000):
        edges = [tuple(r) for r in graph.user_similarity(df, block).collect()]
        assert len(edges) == len(set(edges))
        assert set(edges) == _pairs_by_hand(rows)


def check_neighbours(spark, rows, k, **limits):
    df = spark.createDataFrame(rows, "userid string, campaign string")
    best, want = {}, {}
    for r in similar.similar_users_all(df, k, **limits).collect():
        best.setdefault(r["user_id"], []).append((r["rank"], -r["weight"], r["neighbour"]))
    for a, b, w in _pairs_by_hand(rows):
        want.setdefault(a, []).append((-w, b))
        want.setdefault(b, []).append((-w, a))
    assert {u: sorted(x) for u, x in best.items()} == {u: [(i + 1, *p) for i, p in enumerate(sorted(x)[:k])] for u, x in want.items()}


@pytest.mark.parametrize("k, limits", [(3, {"asking": 7, "compared": 9}), (1, {}), (6, {"asking": 20, "compared": 1000})])
def test_similar_users(spark, k, limits):
    """A campaign of all users, users with equal sets, ties everywhere, campaigns of one user, and users without any."""
    rng = random.Random(k)
    rows = [(f"u{i:03d}", "hot") for i in range(70)]
    rows += [(f"u{rng.randrange(110):03d}", f"c{int(rng.random() ** 2 * 25)}") for _ in range(230)]
    rows += [(f"u{i:03d}", f"own{i}") for i in range(40, 120)] + [("u000", "hot")] * 5 + [("lonely", None), (None, "hot")]
    rows += [(f"v{i}", c) for i in range(12) for c in ("c1", "c2", "c3")]
    check_neighbours(spark, rows, k, **limits)


def test_one_campaign_of_all_users_is_no_list_to_search(spark):
    """Its users are neighbours by the smallest ids; no set asks for its list."""
    rows = [(f"u{i:04d}", "hot") for i in range(400)] + [(f"u{i:04d}", f"c{i // 2}") for i in range(300)]
    check_neighbours(spark, rows, 3)
    sets, _ = similar._campaign_sets(spark.createDataFrame(rows, "userid string, campaign string"), 3)
    floors, _ = similar._floors(sets, similar._listed_users(sets, 3), 3)
    reach = sets.join(floors, "set").select("size", (F.col("size") - F.greatest("floor", F.lit(2)) + 1).alias("reach"))
    assert reach.filter("reach >= size").count() == 0


def test_moving_window(spark, tmp_path):
    """Each move against a plain count over its window; users enter, stay, leave and come back."""
    from datetime import date, datetime

    from parley.operators import rolling

    rng, root = random.Random(4), str(tmp_path / "rolling")
    rows = [(f"u{rng.randrange(25)}", rng.choice(["a", "b", "c", "hot", "hot", None]), datetime(2026, 1, 1 + rng.randrange(9), rng.randrange(24))) for _ in range(260)]
    df = spark.createDataFrame(rows, "userid string, campaign string, timestamp timestamp")
    for _ in range(2):
        rolling.store_days(df, root)
    for first, last in ((1, 3), (2, 5), (2, 5), (8, 9), (4, 6), (20, 21), (1, 9)):
        got = rolling.move_window(spark, root, date(2026, 1, first), date(2026, 1, last))
        want = _pairs_by_hand([(u, c) for u, c, t in rows if first <= t.day <= last])
        assert {tuple(r) for r in got.collect()} == want
    assert len([p for p in (tmp_path / "rolling").iterdir() if p.name.startswith("window-")]) == 1


def test_member_pairs_blocks_cover_each_pair_once(spark):
    df = spark.createDataFrame([("g", i) for i in range(40)] + [("h", 1), ("h", 2)], "g string, m int")
    pairs = sorted(tuple(r) for r in member_pairs(df, "g", "m", block=6).collect())
    expected = sorted(list(itertools.combinations(range(40), 2)) + [(1, 2)])
    assert pairs == expected


def test_merge_is_idempotent(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 9), ("z", 3), ("z", 3)], "k string, v int")
    once = graph.merge_missing(a, b, ["k"])
    assert sorted(tuple(r) for r in once.collect()) == [("x", 1), ("y", 2), ("z", 3)]
    assert sorted(tuple(r) for r in graph.merge_missing(once, b, ["k"]).collect()) == [("x", 1), ("y", 2), ("z", 3)]


def test_repeated_messages_count_once(spark, sample):
    twice = sample.union(sample)
    assert graph.message_nodes(twice).count() == 8
    assert {r["user_id"]: r["message_count"] for r in graph.user_nodes(twice).collect()}["u1"] == 2


def test_integrity_and_left_join(spark, sample):
    users = spark.createDataFrame([("u1",), ("ghost",)], "user_id string")
    sent, messages = graph.sent_edges(sample), graph.message_nodes(sample)
    about = graph.about_edges(sample.filter(F.col("campaign") != "c5"))
    found = graph.graph_integrity(users, messages, sent.filter(F.col("src") != "u4"), about).first()
    assert tuple(found) == (1, 1, 1)
    engagement = {r["user_id"]: r for r in graph.graph_user_engagement(users, sent, messages).collect()}
    assert engagement["u1"]["message_count"] == 2 and engagement["ghost"]["message_count"] is None


def test_pair_join_has_no_cartesian_product(sample):
    plan = graph.user_similarity(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_pair_changes_in_few_blocks(spark, monkeypatch):
    """Any number of users makes MOST_BLOCKS blocks at most, whatever block is asked for; counts in a matrix and by sorting agree with all pairs."""
    from parley.operators import pairs

    rng = random.Random(9)
    rows = {(f"u{i}", f"c{rng.randrange(most)}"): (rng.random() < 0.7, rng.random() < 0.5) for i in range(60) for most in (4, 400) for _ in range(4)}
    rows |= {("é|", "c1"): (True, False), ("z", "c1"): (True, True), ("alone", "c999"): (True, False)}
    df = spark.createDataFrame([(*k, *v) for k, v in rows.items()], "userid string, campaign string, now boolean, before boolean")
    want = {}
    for sign, n in ((1, 0), (-1, 1)):
        for a, b, w in _pairs_by_hand([k for k, v in rows.items() if v[n]]):
            want[a, b] = want.get((a, b), 0) + sign * w
    for most, piece in ((5, 1 << 20), (1, 50)):
        monkeypatch.setattr(pairs, "MOST_BLOCKS", most)
        monkeypatch.setattr(pairs, "PIECE", piece)
        found = pairs.pair_changes(df, block=2)
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and {(a, b): w for a, b, w in got} == {p: w for p, w in want.items() if w}


def test_similar_users_in_few_groups(spark, monkeypatch):
    """Sets are copied to a bounded number of groups, however few are asked to be in one."""
    rng = random.Random(11)
    rows = [(f"u{i:03d}", f"c{rng.randrange(30)}") for i in range(120) for _ in range(6)]
    seen = []
    monkeypatch.setattr(similar, "MOST_GROUPS", 3)
    monkeypatch.setattr(similar, "PAIRS", 100)
    near = similar._near_sets
    monkeypatch.setattr(similar, "_near_sets", lambda *a: seen.append(near(*a)) or seen[0])
    check_neighbours(spark, rows, 4, asking=2, compared=2)
    # each group gives a set k + 1 others at most: at most 2 * 3 groups compared with
    assert seen[0].groupBy("set").count().agg(F.max("count")).first()[0] <= 5 * 6


def test_moving_window_stores_pairs_in_sheets(spark, tmp_path, monkeypatch):
    """No row of a pair is stored or shuffled; sparse and dense sheets, several blocks, and more users than the blocks were made for."""
    from datetime import date, datetime

    from parley.operators import pairs, rolling

    rng, root = random.Random(6), str(tmp_path / "rolling")
    rows = [(f"u{rng.randrange(6 if day < 3 else 60)}", rng.choice(["a", "b", f"c{rng.randrange(40)}", "é|"]), datetime(2026, 1, day)) for day in range(1, 8) for _ in range(60)]
    rolling.store_days(spark.createDataFrame(rows, "userid string, campaign string, timestamp timestamp"), root)
    for gain, most, moves in ((100, 5, ((1, 2), (2, 4), (3, 6))), (0, 32, ((5, 7), (1, 2)))):
        monkeypatch.setattr(pairs, "PRODUCT_GAIN", gain)
        monkeypatch.setattr(pairs, "MOST_BLOCKS", most)
        for first, last in moves:
            got = rolling.move_window(spark, root, date(2026, 1, first), date(2026, 1, last), block=3)
            assert {tuple(r) for r in got.collect()} == _pairs_by_hand([(u, c) for u, c, t in rows if first <= t.day <= last])
    sheets = spark.read.parquet(f"{root}/window-5/weights")
    assert sheets.count() <= got.count() and sheets.columns[:4] == ["pair", "lefts", "rights", "weights"]
    wide = pairs.np.array([[0, 300], [70_000, 1]])
    names = pairs.pa.array(["x", "y"])
    sheet = rolling._sheets(0, wide, names, names)
    assert (rolling._sheet_weights(sheet["weights"][0].as_py(), 2, 2) == wide).all()
