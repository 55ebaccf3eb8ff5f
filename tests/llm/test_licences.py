import random
import re
import textwrap

from parley.llm import license_rules as rules


def test_every_sentence_is_found():
    known = rules.Recogniser()
    for name, texts in rules.SENTENCES.items():
        for text in texts:
            found = known.sentences("Some words before. " + text + "\nand after it.")
            assert [s[0] for s in found] == [name], text


def test_every_rule_has_a_trigger():
    for _, names in rules.RULES:
        assert any(re.search(rules.TRIGGERS, t.lower()) for n in names for t in rules.SENTENCES[n])


def full(*names):
    return "\n\n".join(textwrap.fill(rules.SENTENCES[n][0], 60) for n in names)


def test_ordered_rules():
    known = rules.Recogniser()
    mit = "Copyright (c) 2020 Someone\n\n" + full("mit-grant", "mit-notice") + "\n\n" + full("mit-as-is")
    assert [x[:2] for x in known.licences(mit)] == [("MIT", ["mit-grant", "mit-notice", "mit-as-is"])]
    bsd = full("bsd-grant", "bsd-source", "bsd-binary")
    assert [x[0] for x in known.licences(bsd)] == ["BSD-2-Clause"]
    assert [x[0] for x in known.licences(bsd + "\n" + full("bsd-endorse"))] == ["BSD-3-Clause"]
    far = full("mit-grant") + "\none.\ntwo.\nthree.\n" + full("mit-notice", "mit-as-is")
    assert [x[1] for x in known.licences(far)] == [["mit-grant"]]
    assert known.licences("") == [] == known.licences("unlicensed under the sea, version 2.0")


def test_scan(spark, docs, no_docs):
    texts = ["x.\nReleased under the MIT License.\ny. Licensed under CC BY-NC 4.0. z", "A licence of no kind."]
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = rules.scan_licences(docs.select("doc_id", "text").unionByName(more)).collect()
    assert [(r["doc_id"], r["licence"]) for r in found] == [(900, "MIT"), (900, "CC-BY-NC-4.0")]
    assert texts[0][found[0]["begin"] : found[0]["end"]] == "Released under the MIT License"
    assert rules.scan_licences(no_docs).count() == 0
    assert rules.scan_licences(docs).count() == 0


def test_rights_reserved_and_common_headers():
    known = rules.Recogniser()
    for text in ["All rights reserved.", "Copyright (c) 2020 X. All rights reserved.", "Copyright 2020 by X, all rights\u00a0reserved", "\u00a9 2020 X.\nAll rights\nreserved."]:
        assert [x[0] for x in known.licences("Prose. \n" + text + "\nMore prose.")] == ["Proprietary"], text
    bsd = "Copyright (c) 2020, X\nAll rights reserved.\n\n" + full("bsd-grant", "bsd-source", "bsd-binary")
    assert [x[0] for x in known.licences(bsd)] == ["BSD-2-Clause"]
    assert [x[0] for x in known.licences(bsd + "\n" + full("bsd-endorse"))] == ["BSD-3-Clause"]
    heads = {"gpl2-free": "GPL-2.0", "lgpl21-free": "LGPL-2.1", "lgpl3-free": "LGPL-3.0", "agpl3-free": "AGPL-3.0"}
    for name, licence in heads.items():
        assert [x[0] for x in known.licences(full(name, "gpl-hope"))] == [licence]
    for name in "GPL-2.0 LGPL-2.1 AGPL-3.0 BSD-2-Clause ISC MPL-2.0 CC-BY-4.0 CC0-1.0".split():
        assert [x[0] for x in known.licences(f"// SPDX-License-Identifier: {name}\ncode")] == [name]


def test_prefilter_keeps_every_known_sentence(spark):
    """In capitals and with every word on a line of its own."""
    texts = [t for ts in rules.SENTENCES.values() for t in ts]
    texts += ["\n".join(rules.normal_words(t)).upper() for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert rows.where(rows.text.isNotNull()).filter(f"lower(text) rlike '{rules.TRIGGERS}'").count() == len(texts)
    notice = spark.createDataFrame([(1, "A text.\nAll rights reserved.\nMore.")], "doc_id int, text string")
    assert [r["licence"] for r in rules.scan_licences(notice).collect()] == ["Proprietary"]


def plain_licences(text, sentences, rules_, gap):
    """Every unit run and every rule tried, by plain loops over lists of words."""
    units = [[w.lower() for w in re.findall(r"[^\W_]+", u)] for u in re.split(r"(?<=[.!?:])(?=\s)|\n", text)]
    units = [u for u in units if u]
    known = {tuple(w.lower() for w in re.findall(r"[^\W_]+", t)): name for name, texts in sentences.items() for t in texts}
    found, at = [], 0
    while at < len(units):
        runs = [(end, known.get(tuple(w for u in units[at:end] for w in u))) for end in range(len(units), at, -1)]
        end, name = next(((e, n) for e, n in runs if n), (at + 1, None))
        if name:
            found.append((name, at, end - 1))
        at = end
    out, taken = [], set()
    for licence, names in rules_:
        for i in range(len(found) - len(names) + 1):
            run = found[i : i + len(names)]
            near = all(b[1] - a[2] - 1 <= gap for a, b in zip(run, run[1:]))
            if [r[0] for r in run] == names and near and not taken & set(range(i, i + len(names))):
                taken |= set(range(i, i + len(names)))
                out.append((i, licence, names))
    return [(licence, names) for _, licence, names in sorted(out)]


def test_rules_against_plain_loops():
    rng, known = random.Random(11), rules.Recogniser()
    names = [n for n in rules.SENTENCES if n != "rights-reserved"]
    hits = 0
    for _ in range(300):
        parts = []
        while len(parts) < 12:
            _, rule = rng.choice(rules.RULES)
            for n in rule if rng.random() < 0.8 else rng.sample(names, 2):
                parts.append(textwrap.fill(rng.choice(rules.SENTENCES[n]), rng.choice([30, 60, 500])))
                parts += ["Some other text."] * rng.choice([0, 0, 0, 1, 2, 3])
        text = "\n".join(parts)
        got = [(x[0], x[1]) for x in known.licences(text)]
        assert got == plain_licences(text, rules.SENTENCES, rules.RULES, rules.GAP_UNITS), text
        hits += len(got)
    assert hits > 1000


def test_whole_texts():
    known = rules.Recogniser()
    bsd = full("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability")
    assert [x[0] for x in known.licences("Copyright (c) 2020, X\nAll rights reserved.\n\n" + bsd)] == ["BSD-3-Clause"]
    for names, licence in ((["isc-grant", "isc-as-is", "isc-liability"], "ISC"), (["mpl-terms", "mpl-copy"], "MPL-2.0"), (["zlib-as-is", "zlib-liability", "zlib-grant"], "Zlib")):
        assert [x[0] for x in known.licences(full(*names))] == [licence]
