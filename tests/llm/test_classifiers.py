import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import language, quality, toxicity
from parley.llm.common import held_out

EN = "the river was old and winter came with stones over every garden path".split()
DE = "der alte fluss und die steine über jedem weg durch den garten im winter".split()


def made(n, words, rng, size=60):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(size // 2, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def labelled(spark):
    """Good prose, shouted junk, and prose with insults; every third document is unlabelled."""
    rng, rows, labels = random.Random(8), [], []
    kinds = [(made(1, EN, rng)[0], 1, 0) for _ in range(90)]
    kinds += [(made(1, EN, rng)[0].upper().replace(" ", "!!! $$$ "), 0, 0) for _ in range(60)]
    for _ in range(60):
        words = made(1, EN, rng)[0].split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["you idiot", "moron", "you worthless clown", "scum"]))
        kinds.append((" ".join(words), 1, 1))
    rng.shuffle(kinds)
    for i, (text, good, toxic) in enumerate(kinds):
        rows.append((i, text, "x"))
        if i % 3:
            labels.append((i, good, toxic))
    rows += [(1000, None, None), (1001, "", "x"), (None, kinds[0][0], None), rows[0]]
    labels += [(1, None, None), (None, 1, 0), (5000, 0, 1), labels[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), kinds


def accuracy(rows, kinds, place):
    known = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 1000]
    return np.mean([r["predicted"] == kinds[r["doc_id"]][place] for r in known])


@pytest.mark.parametrize("operator, label, place", [(quality, "quality", 1), (toxicity, "toxic", 2)])
def test_classifiers(labelled, operator, label, place):
    docs, labels, kinds = labelled
    apart = held_out(F.col("doc_id"), 3, 1)
    rows = operator.train_and_score(docs, labels, ~apart, label_col=label).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert accuracy(rows, kinds, place) > 0.9
    # the same text has the same score
    assert len({r["score"] for r in rows if r["doc_id"] in (0, None)}) == 1
    assert operator.train_and_score(docs.limit(0), labels, ~apart, label_col=label).count() == 0
    untaught = operator.train_and_score(docs, labels.limit(0), ~apart, label_col=label)
    assert {r["score"] for r in untaught.collect()} == {0.5}


def test_drop_poor(labelled):
    docs, labels, kinds = labelled
    apart = held_out(F.col("doc_id"), 3, 1)
    kept = quality.drop_poor(docs, labels, ~apart)
    scores = quality.train_and_score(docs, labels, ~apart)
    assert kept.columns == docs.columns
    assert kept.count() == scores.filter("predicted = 1").count() < docs.count()


def test_context_vectors(spark):
    """Against a plain loop over all features and their neighbours."""
    texts = ["the river, the stone", "", "one", "a b c d e f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    around, want = quality.index_vectors(64, 8, 2), np.zeros((64, 8))
    import pyarrow as pa

    ids, bounds = quality.feature_runs(pa.array(texts), 64)
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                want[ids[i]] += around[ids[j]] * (i != j)
    assert (quality.context_vectors(docs, 64, 8, nonzero=2) == want).all()
    stored = quality.feature_table(docs, 64)
    assert (quality.context_vectors(stored, 64, 8, nonzero=2) == want).all()
    # pooled: the mean of the features' vectors, from texts and from stored runs
    vectors = quality.word_vectors(want.astype(np.float32), 2)
    runs = {r["doc_id"]: r["features"] for r in stored.collect()}
    by_text = quality.pooled_vectors(pa.array(texts), vectors)
    by_run = quality.pooled_vectors(pa.array([runs[i] for i in range(4)], pa.list_(pa.int16())), vectors)
    assert (by_text == by_run).all()
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        assert runs[i] == ids[a:b].tolist()
        mean = vectors[ids[a:b]].mean(axis=0) if b > a else np.zeros(16)
        assert np.allclose(by_text[i, :16], mean, atol=1e-6)
        assert np.isclose(by_text[i, 16], len(set(ids[a:b])) / max(b - a, 1)) and np.isclose(by_text[i, 17], np.log1p(b - a))


def test_one_id_with_most_labels_and_documents(spark):
    rng = random.Random(3)
    labels = spark.range(30_000).selectExpr("cast(0 as long) AS doc_id", "1 AS quality", "0 AS toxic").unionByName(
        spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 301)], "doc_id long, quality int, toxic int")
    )
    texts = made(300, EN, rng, 20)
    docs = spark.range(3000).selectExpr("cast(0 as long) AS doc_id", "concat('river ', id % 7) AS text").unionByName(
        spark.createDataFrame([(i + 1, t if i % 2 else t + " you scum") for i, t in enumerate(texts)], "doc_id long, text string")
    )
    chosen = quality.sampled_labels(labels, 2000, "doc_id", "quality", F.lit(True))
    taught = quality.taught_rows(docs, chosen, "text").collect()
    assert len(taught) == 301 and {r["doc_id"]: r["n"] for r in taught}[0] == 30_000
    assert quality.sampled_labels(labels, 100, "doc_id", "quality", F.lit(True)).count() < 150
    scored = toxicity.train_and_score(docs, labels, F.lit(True), train_rows=2000)
    assert scored.count() == 3300


def test_calibration_is_isotonic():
    rng = np.random.default_rng(2)
    raw = rng.normal(size=500)
    fitted = toxicity.Calibration(raw, (raw + rng.normal(size=500) > 0).astype(float))
    values = fitted(np.linspace(-4, 4, 200))
    assert (np.diff(values) >= 0).all() and 0 <= values.min() and values.max() <= 1


def test_word_flags():
    stated, none = frozenset(toxicity.INSULTS), frozenset()
    assert toxicity.word_flags("idiot!", stated, none) & toxicity.STATED
    assert toxicity.word_flags("1d10t", stated, none) & toxicity.DECODED
    assert toxicity.word_flags("YOU", stated, none) == toxicity.SECOND | toxicity.SHOUTED
    assert toxicity.word_flags("river", stated, none) == 0


def test_language(spark):
    rng = random.Random(9)
    rows = [(i, t, "en") for i, t in enumerate(made(40, EN, rng))] + [(100 + i, t, "de") for i, t in enumerate(made(40, DE, rng))]
    mixed = made(1, EN, rng, 300)[0] + " " + made(1, DE, rng, 120)[0]
    rows += [(200, mixed, None), (201, None, "en"), (202, "", None), (203, "123 !!!", "de"), (None, rows[0][1], None), rows[50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "'x' AS languages")
    apart = held_out(F.col("doc_id"), 4, 2)
    found = language.predict(docs, ~apart).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, _, lang in rows[:80]:
        assert by_id[i]["lang_pred"] == lang
    assert {s["lang"] for s in by_id[200]["languages"]} == {"en", "de"}
    assert by_id[200]["lang_pred"] == "en" and 0.5 < by_id[200]["score"] < 0.95
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (201, 202, 203))
    assert by_id[None]["lang_pred"] == "en"
    assert language.predict(docs.limit(0), ~apart).count() == 0
    untaught = language.predict(docs.withColumn("lang", F.lit(None).cast("string")), ~apart)
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}


def test_em_against_plain_loops():
    """Proportions, likelihoods and the language set, by loops over n-grams and languages."""
    import math

    def plain_em(chances, counts, rounds=200):
        weights = [1 / len(chances[0])] * len(chances[0])
        for _ in range(rounds):
            share = [0.0] * len(weights)
            for row, n in zip(chances, counts):
                total = sum(c * w for c, w in zip(row, weights))
                for i, (c, w) in enumerate(zip(row, weights)):
                    share[i] += n * c * w / total
            new = [s / sum(share) for s in share]
            if max(abs(a - b) for a, b in zip(new, weights)) < 1e-3:
                return new
            weights = new
        return weights

    def likelihood(chances, counts, weights):
        return sum(n * math.log(sum(c * w for c, w in zip(row, weights))) for row, n in zip(chances, counts))

    rng = np.random.default_rng(6)
    for true in ([1.0, 0, 0, 0], [0.6, 0.4, 0, 0], [0.3, 0.3, 0.4, 0], [0.25] * 4):
        chances = rng.random((120, 4)) ** 3 + 1e-4
        chances /= chances.sum(axis=0)
        counts = rng.multinomial(900, chances @ np.array(true)).astype(float)
        used = counts > 0
        chances, counts = chances[used], counts[used]
        assert np.allclose(language.proportions(chances, counts, 200), plain_em(chances.tolist(), counts.tolist()), atol=1e-9)
        got, weights = language.language_set(np.log(chances), counts)
        scaled = (chances / chances.max(axis=1, keepdims=True)).tolist()
        chosen, best = list(range(4)), plain_em(scaled, counts)
        value, penalty = likelihood(scaled, counts, best), 0.5 * math.log(counts.sum())
        while len(chosen) > 1:
            weakest = max(i for i, w in enumerate(best) if w == min(best))
            fewer = [[c for i, c in enumerate(row) if i != weakest] for row in scaled]
            again = plain_em(fewer, counts) if len(fewer[0]) > 1 else [1.0]
            if likelihood(fewer, counts, again) < value - penalty:
                break
            chosen, scaled, best, value = [c for i, c in enumerate(chosen) if i != weakest], fewer, again, likelihood(fewer, counts, again)
        assert got.tolist() == chosen and np.allclose(weights, best, atol=1e-6)


def test_toxic_features_against_plain_loops():
    import pyarrow as pa

    rng = random.Random(12)
    words = ["you", "YOU", "idiot", "1d10t!", "river", "STONE", "m*ron", "scum,", "été", "42", "!!!", "Your", "fool.", "a"]
    texts = ["", "   ", *[" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 30, 120, 400)]]
    learned, stated = frozenset(["stone"]), frozenset(toxicity.INSULTS)
    got = toxicity.dense_features(pa.array(texts), tuple(learned))
    place = {n: i for i, n in enumerate(toxicity.FEATURES)}
    for text, row in zip(texts, got):
        # a text without words counts as one empty word
        flags = [toxicity.word_flags(w, stated, learned) for w in text.split() or [""]]
        n, chars = max(len(flags), 1), max(len(text), 1)
        hits = [i for i, f in enumerate(flags) if f & (toxicity.STATED | toxicity.LEARNED | toxicity.DECODED)]
        seconds = [i for i, f in enumerate(flags) if f & toxicity.SECOND]
        near = sum(any(abs(i - j) <= toxicity.NEAR_WORDS for j in seconds) for i in hits)
        want = {
            "stated": sum(f & toxicity.STATED > 0 for f in flags) / n, "learned": sum(f & toxicity.LEARNED > 0 for f in flags) / n,
            "hits": np.log1p(len(hits)), "near": near / n, "second": len(seconds) / n, "shouted": sum(f & toxicity.SHOUTED > 0 for f in flags) / n,
            "capitals": sum(c.isupper() for c in text) / chars, "exclamations": text.count("!") / chars,
            "digits": sum(c in "0123456789" for c in text) / chars, "words": np.log1p(len(flags)),
            "length": sum(map(len, text.split())) / n, "densest": max([sum(i // 50 == k for i in hits) for k in range(20)]),
        }
        for name, value in want.items():
            assert np.isclose(row[place[name]], value), (name, text)


def test_em_finds_the_proportions():
    rng = np.random.default_rng(3)
    chances = rng.random((500, 3)) ** 4
    chances /= chances.sum(axis=0)
    true = np.array([0.7, 0.3, 0.0])
    counts = rng.multinomial(20_000, chances @ true).astype(float)
    assert np.abs(language.proportions(chances, counts, 200) - true).max() < 0.05
    chosen, weights = language.language_set(np.log(chances), counts)
    assert chosen.tolist() == [0, 1] and abs(weights[0] - 0.7) < 0.05
