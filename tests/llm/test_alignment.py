import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm import alignment, vectors
from parley.session import materialize

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.ByteTokenizer(A).token_bytes()


def plain_tokens(text, libraries):
    """(ids of A, their ends, ids of B, their ends) by the libraries alone."""
    a, b, table = libraries
    if not text:
        return [], [], [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    names = [b.id_to_piece(i) for i in ids_b]
    bytes_a = [table[i] for i in ids_a]
    bytes_b = [bytes([int(n[3:5], 16)]) if b.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids_b, names)]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], [], []
    return ids_a, np.cumsum(list(map(len, bytes_a))).tolist(), ids_b, np.cumsum(list(map(len, bytes_b))).tolist()


def plain_alignment(texts, libraries):
    tokens = [plain_tokens(t, libraries) for t in texts]
    links = []
    for ids_a, end_a, ids_b, end_b in tokens:
        # the tokens of each byte; neighbouring bytes of the same two tokens are one link
        of_a = [i for i, (lo, hi) in enumerate(zip([0, *end_a], end_a)) for _ in range(lo, hi)]
        of_b = [i for i, (lo, hi) in enumerate(zip([0, *end_b], end_b)) for _ in range(lo, hi)]
        links.append([(ids_a[i], ids_b[j]) for i, j in dict.fromkeys(zip(of_a, of_b))])
    counts, best = Counter(p for found in links for p in set(found)), defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (ids_a, end_a, ids_b, end_b), found in zip(tokens, links):
        shared = sorted(set(end_a) & set(end_b))
        groups = []
        left_a, left_b = list(zip(end_a, ids_a)), list(zip(end_b, ids_b))
        for hi in shared:
            parts = []
            for left in (left_a, left_b):
                n = [e for e, _ in left[:200]].index(hi) + 1
                parts.append(",".join(str(i) for _, i in left[:n]))
                del left[:n]
            groups.append("|".join(parts))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(counts[p] == best[p[0]] for p in found)
        out.append((len(ids_a), len(ids_b), len(groups), len(found), n_best, sum(counts[p] for p in found), digest))
    return out


def test_pieces_as_the_libraries_have_them(libraries):
    rng = random.Random(6)
    signs = "abcXYZ'stdrevl   \n\t\r\x00.,!?-_<|>012²é日ßñ▁😀　 ́ﬁ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([1, 2, 5, 30, 200]))) for _ in range(3000)]
    for _ in range(1500):
        kinds = (range(32, 0x250), range(0x3000), range(0xD800), range(0x1F300, 0x1F700))
        texts.append("".join(chr(rng.choice(rng.choice(kinds))) + rng.choice(["", "", " ", "."]) for _ in range(12)))
    texts += ["<|endoftext|> <s></s>", "<0x41>", "a <unk>", " ", "  ", " a", "a ", "\n", "don't  we'll", "x" * 3000]
    ids_a, n_a, ids_b, n_b = alignment.encode_both([" " + t for t in texts], A, B)
    at_a, at_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
    for i, text in enumerate(texts):
        want_a, _, want_b, _ = plain_tokens(text, libraries)
        got_b = ids_b[at_b[i] : at_b[i + 1]].tolist()
        if alignment.LOST in got_b:
            assert not want_a, text
            continue
        assert ids_a[at_a[i] : at_a[i + 1]].tolist() == want_a, text
        assert got_b == want_b, text


def check(rows, texts, libraries):
    want = plain_alignment(texts, libraries)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(want)


def test_align(docs, prose, no_docs, libraries, monkeypatch):
    texts = [prose[7 if r["doc_id"] is None else r["doc_id"]] for r in docs.select("doc_id").collect()]
    check(alignment.align(docs, A, B).collect(), texts, libraries)
    # many small shards, and several tables of them
    check(alignment.align(docs, A, B, shard_pairs=50, table_pairs=300).collect(), texts, libraries)
    assert alignment.align(no_docs, A, B).count() == 0
    without = alignment.align(docs.withColumn("text", F.lit(None).cast("string")), A, B).collect()
    assert len(without) == len(texts) and {(r["n_a"], r["count_sum"], r["groups_sha256"]) for r in without} == {(0, 0, "")}


def test_texts_that_tokens_do_not_give_back_and_long_ones(spark, libraries, monkeypatch):
    texts = ["a▁b", "▁", "fine text", "日本 語。" * 50, "river " * 4000, "x" * 9000, "a▁b"]
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 1000)
    found = alignment.align(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), A, B)
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    for text, r in zip(texts, rows):
        ids_a, _, ids_b, _ = plain_tokens(text, libraries)
        assert (r["n_a"], r["n_b"]) == (len(ids_a), len(ids_b))
    assert [r["n_links"] for r in rows][:2] == [0, 0]


def test_perfect_hash():
    rng = np.random.default_rng(4)
    shards = [rng.choice(2**40, n, replace=False).astype(np.uint64) for n in (0, 1, 2, 700, 5000, 0)]
    built = [vectors.perfect_levels(keys) for keys in shards]
    table = vectors.PerfectHash(*[[b[k] for b in built] for k in range(3)])
    before = 0
    for i, keys in enumerate(shards):
        slots = table.slots(keys, np.full(len(keys), i))
        assert sorted(slots.tolist()) == list(range(before, before + len(keys)))
        assert (table.keys[slots] == keys).all()
        before += len(keys)
        others = rng.choice(2**40, 100).astype(np.uint64) + np.uint64(2**41)
        assert (table.slots(others, np.full(100, i)) == -1).all()
    with pytest.raises(ValueError):
        vectors.perfect_levels(np.array([5, 5], np.uint64))


def test_tree_sum(spark):
    rng = np.random.default_rng(7)
    rows = {(s, p): rng.integers(-5, 2**40, 20) for s in range(3) for p in range(70)}
    parts = spark.createDataFrame([(s, p, bytearray(v.astype("<i8").tobytes())) for (s, p), v in rows.items()], "segment int, part long, values binary")
    parts = materialize(parts, "parts")
    for fan in (2, 16):
        got = {r["segment"]: np.frombuffer(r["values"], "<i8") for r in vectors.tree_sum(parts, "<i8", fan).collect()}
        assert set(got) == {0, 1, 2} and all((got[s] == sum(rows[s, p] for p in range(70))).all() for s in got)
    assert vectors.tree_sum(parts.limit(0), "<i8").count() == 0
