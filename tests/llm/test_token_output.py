import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from parley.llm import token_output
from parley.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_as_the_tokenizer_has_them():
    rng, tokenizer = random.Random(2), Tokenizer.from_file(PATH)
    signs = "abcXYZ'stdrevl  \n\t\x0b 12.,!?-_<|>é日ßİΣς´́  \x85½"
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 5, 30]))) for _ in range(3000)]
    for _ in range(3000):
        kinds = (range(32, 0x250), range(0x3000), range(0xD800))
        texts.append("".join(chr(rng.choice(rng.choice(kinds))) + rng.choice(["", ".", "!?", " "]) for _ in range(10)))
    texts += ["<|endoftext|>", "a<|endoftext|>. b", "x <|startoftext|>!!", "Don't. they'LL!"]
    ids, counts = token_output.encode_words(pa.array(texts), PATH, 2)
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_blocks():
    rng = np.random.default_rng(1)
    for n in (1, 7, 4096, 65535):
        for most in (1, 2, 300, 49408, 2**31, 2**32):
            ids = rng.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
            assert (token_output.unpack_block(token_output.pack_block(ids)) == ids).all()
            sparse = np.where(rng.random(n) < 0.03, ids, 3).astype(np.uint32)
            packed = token_output.pack_block(sparse)
            assert (token_output.unpack_block(b"zz" + packed, 2) == sparse).all()
    # outliers do not widen the block
    ids = np.full(4096, 5, np.uint32)
    ids[7] = 49000
    assert len(token_output.pack_block(ids)) < 30


def test_files(spark, docs, prose, no_docs):
    path = scratch_path(spark, "tokens")
    token_output.write_tokens(docs, path, PATH, 2, file_text_bytes=20_000)
    got = sorted(token_output.read_tokens(spark, path, ids=True).collect(), key=lambda r: r["start"])
    assert len(list(spark.read.format("binaryFile").load(path).filter("length > 0").select("path").collect())) > 1
    ids_in_order = [r["doc_id"] for r in got]
    assert ids_in_order[0] is None and ids_in_order[1:] == sorted(ids_in_order[1:]) and ids_in_order.count(3) == 2
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for r in got:
        text = prose[7 if r["doc_id"] is None else r["doc_id"]] or ""
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(want), want)
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    empty = scratch_path(spark, "no_tokens")
    token_output.write_tokens(no_docs, empty, PATH, 2)
    assert token_output.read_tokens(spark, empty).count() == 0


def test_one_row_very_often(spark):
    """Repeats of one row are dealt to several files, and each has its place."""
    rows = spark.range(3000).selectExpr("cast(7 as long) AS doc_id", "'the same river and the same stone' AS text").unionByName(
        spark.range(300).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    )
    path = scratch_path(spark, "hot_tokens")
    token_output.write_tokens(rows, path, PATH, 2, file_text_bytes=10_000)
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("length").collect()
    assert len(files) >= 8 and max(r["length"] for r in files) < 4 * min(r["length"] for r in files) + 4000
    got = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == 3300 and [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
