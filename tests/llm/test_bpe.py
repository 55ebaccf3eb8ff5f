import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from parley.llm import bpe, edit_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def odd_texts(n):
    rng = random.Random(1)
    signs = "abc'stmdrevl  \n\t 12.,!é  ß日𝔘٣́\x00😀"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    for _ in range(n):
        kinds = (range(0x250), range(0x3000), range(0xD800), range(0xE000, 0x110000))
        out.append("".join(chr(rng.choice(rng.choice(kinds))) for _ in range(20)))
    return out + ["", "a" * 5000, " " * 300 + "x", "--" * 400, "don't 's ''s they'll I've\n", "x \n\n  y  "]


def test_same_ids_as_library(library):
    texts = odd_texts(3000)
    assert [ids.tolist() for ids, _, _ in bpe.encode_each(texts, RANKS)] == [library.encode_ordinary(t) for t in texts]


def test_block_size_changes_no_boundary():
    text = odd_texts(50)
    code = np.frombuffer("\x00".join([*text, ""]).encode("utf-32-le"), np.uint32)
    symbols = bpe._symbols(code, np.cumsum([len(t) + 1 for t in text]) - 1)
    assert all((bpe.piece_starts(symbols, b) == bpe.piece_starts(symbols, 1)).all() for b in (2, 7, 512))


def test_long_text_in_parts(library):
    text = " ".join(odd_texts(200))
    parts = list(bpe.safe_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 5
    assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_long_piece_by_heap(library):
    ranks = bpe.read_ranks(RANKS)
    for piece in (b"abcabc" * 40, b"the" * 100, b"\xff\xfe" * 80):
        assert bpe._merge_long(piece, ranks) == bpe.Merges(ranks)._merge([piece])[0].tolist()


def test_round_trip(docs, prose, library):
    texts = [t or "" for t in prose]
    expected = [*enumerate(texts), (3, texts[3]), (None, texts[7])]
    want = sorted(
        (
            (i is None, i, len(ids := library.encode_ordinary(t)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest())
            for i, t in expected
        ),
        key=repr,
    )
    got = sorted(((r[0] is None, *r) for r in bpe.round_trip(docs, RANKS).collect()), key=repr)
    assert got == want


def test_encode_then_decode(docs, no_docs):
    encoded = bpe.encode(docs, RANKS)
    rows = {(r["doc_id"], len(r["ids"])): r for r in encoded.collect()}
    assert all(sum(r["piece_tokens"]) == len(r["ids"]) for r in rows.values())
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(encoded, RANKS).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert bpe.round_trip(no_docs, RANKS).count() == 0


def edited(text, edits):
    for begin, end, new in edits:
        begin = min(max(begin, 0), len(text))
        text = text[:begin] + new + text[min(max(end, begin), len(text)) :]
    return text


def test_edits_give_the_full_count(library):
    rng = random.Random(2)
    signs = "abc'stmdrevl  \n 12.,!é日"

    def some(n):
        return "".join(rng.choice(signs) for _ in range(n))

    texts = [some(rng.choice([0, 1, 5, 60, 300, 3000])) for _ in range(200)]
    edits = []
    for t in texts:
        own = []
        for _ in range(rng.randint(0, 5)):
            begin = rng.randint(-2, len(t) + 3)
            own.append((begin, begin + rng.choice([0, 1, 3, 30, 400]), some(rng.choice([0, 0, 1, 4, 40, 3000]))))
        edits.append(own)
    trees = list(edit_counts.build_trees(texts, RANKS))
    got, encoded = edit_counts.apply_edits(texts, trees, edits, RANKS)
    assert got == [edited(t, e) for t, e in zip(texts, edits)]
    assert [t.total for t in trees] == [len(library.encode_ordinary(t)) for t in got]
    assert all(int(t.chars.sum()) == len(x) for t, x in zip(trees, got))


def test_small_edit_of_long_text_encodes_little():
    text = "one two three, four five six. " * 2000
    trees = list(edit_counts.build_trees([text], RANKS))
    _, encoded = edit_counts.apply_edits([text], trees, [[(30000, 30005, "seven")]], RANKS)
    assert encoded[0] < 2000


def test_recount(spark, docs, no_docs, library):
    from pyspark.sql import functions as F

    change = F.array(F.struct(F.lit(1).alias("begin"), F.lit(4).alias("end"), F.lit("new").alias("replacement")))
    counted = edit_counts.count_tokens(docs, RANKS, keep={"edits": F.when(F.col("doc_id") % 2 == 0, change)})
    rows = edit_counts.recount(counted, RANKS).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["n_tokens"] == len(library.encode_ordinary(r["text"]))
    none = edit_counts.count_tokens(no_docs, RANKS, keep={"edits": change})
    assert edit_counts.recount(none, RANKS).count() == 0
