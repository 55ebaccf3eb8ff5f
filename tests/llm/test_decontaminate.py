import random

import numpy as np

from parley.llm import decontaminate as dc


def least_edits(item, text):
    before = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, 1):
        now = np.minimum(before[1:] + 1, before[:-1] + (text != c))
        now = np.append(i, now)
        before = np.minimum.accumulate(now - np.arange(len(now))) + np.arange(len(now))
    return int(before.min())


def cases(n):
    rng = random.Random(3)
    for _ in range(n):
        items = ["".join(rng.choice("abcde ") for _ in range(rng.randint(20, 160))) for _ in range(3)]
        texts = []
        for _ in range(4):
            text = "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 200)))
            for item in items:
                if rng.random() < 0.5:
                    copy = list(item)
                    for _ in range(rng.randint(0, 9)):
                        at = rng.randrange(len(copy))
                        copy[at : at + rng.choice([0, 1, 1])] = rng.choice(["", "a", "b"])
                    text += "".join(copy) + "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 60)))
            texts.append(text)
        yield items, texts


def test_finds_what_brute_force_finds():
    found_some = 0
    for items, texts in cases(40):
        bench = dc.Benchmark(items)
        got = {(t, i): edits for t, i, _, _, edits in dc.search(bench, texts)}
        want = {}
        for t, text in enumerate(texts):
            for i, code in enumerate(bench.codes):
                own = dc.normalise(text)[0]
                if len(code) >= dc.LEAST_CHARS:
                    edits = least_edits(code, own)
                    if edits <= bench.edits[i]:
                        want[t, i] = edits
                elif " " + "".join(map(chr, code)) + " " in " " + "".join(map(chr, own)) + " ":
                    want[t, i] = 0
        assert got == want
        found_some += len(want)
    assert found_some > 100


def test_short_items_match_whole_words():
    items = ["What is 2 + 2?", "日本の首都は?", "a", "", "Ende", "what is"]
    bench = dc.Benchmark(items)
    texts = ["So: what IS 2+2 then?", "what is 2 + 21", "東京は日本の首都は。", "Das Ende.", "Enden", "Weekende", "A b", "ab", "what is", "", "somewhat is"]
    got = {(t, i): (b, e) for t, i, b, e, _ in dc.search(bench, texts)}
    assert set(got) == {(0, 0), (0, 5), (1, 5), (2, 1), (3, 4), (6, 2), (8, 5)}
    assert texts[0][slice(*got[0, 0])] == "what IS 2+2" and texts[2][slice(*got[2, 1])] == "日本の首都は"


def test_qgram_hashes():
    code = np.array([1, 2, 3, 4, 5, 6, 7, 1, 2, 3, 4, 5, 6, 7, 8], np.uint32)
    for q in (1, 3, 5, 7):
        got = dc.qgram_hashes(code, q)
        same = [(i, j) for i in range(len(got)) for j in range(len(got)) if got[i] == got[j]]
        assert same == [(i, j) for i in range(len(got)) for j in range(len(got)) if (code[i : i + q] == code[j : j + q]).all()]


PASSAGE = "A river runs past the old mill, and every winter the lamp in its window is lit by nobody at all."


def test_find_passages(spark, docs, no_docs, prose):
    rows = [(1, PASSAGE), (2, PASSAGE.upper().replace(",", " -")), (3, None), (4, ""), (5, "too short")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    leaks = spark.createDataFrame(
        [(900, "Before. " + PASSAGE + " After.", "en"), (901, PASSAGE.replace("every", "each"), "en"), (902, PASSAGE[:60], "en"), (903, "it is too short", "en")],
        "doc_id long, text string, lang string",
    )
    table = docs.select("doc_id", "text", "lang").unionByName(leaks)
    # blocks of so few characters that each item comes alone
    for block_chars in (4_000_000, 90):
        found = dc.find_passages(table, items, block_chars=block_chars).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(900, 1), (900, 2), (901, 1), (901, 2), (903, 5)]
        first = next(r for r in found if (r["doc_id"], r["item_id"]) == (900, 1))
        assert ("Before. " + PASSAGE)[first["begin"] : first["end"]] == PASSAGE[:-1] and first["edits"] == 0
    assert dc.find_passages(no_docs, items).count() == 0
    assert dc.find_passages(table, items.limit(0)).count() == 0
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    kept = dc.drop_contaminated(table, items)
    assert {900, 901, 902, 903} & {r["doc_id"] for r in kept.collect()} == {902}
