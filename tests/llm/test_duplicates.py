import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parley.llm import exact, simhash
from parley.llm.components import components


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def check_exact(rows, prose):
    texts = [(r["doc_id"], lowered(prose[7 if r["doc_id"] is None else r["doc_id"]])) for r in rows]
    sizes, largest = Counter(t for _, t in texts), {}
    for i, t in texts:
        largest[t] = max(largest.get(t, -1), -1 if i is None else i)
    for r, (_, t) in zip(rows, texts):
        assert r["group_size"] == sizes[t] and r["keep_id"] == largest[t]
    assert Counter(t for r, (_, t) in zip(rows, texts) if r["kept"]) == Counter(set(sizes))


def test_exact_duplicates(docs, prose, no_docs):
    check_exact(exact.exact_duplicates(docs).collect(), prose)
    assert exact.exact_duplicates(no_docs).count() == 0


def test_names_survive_hash_collisions_and_small_blocks(docs, prose):
    """Blocks of 64 bytes give many levels; a hash with three values makes blocks collide."""
    found = exact.exact_duplicates(docs, block_bytes=64, hashed=lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    check_exact(found.collect(), prose)


def test_drop_exact_duplicates_keeps_columns(docs, prose):
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(lowered(r["text"]) for r in kept.collect()) == sorted({lowered(t) for t in prose})
    assert {r["_row"] for r in kept.collect()} <= {-1, None}


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, close):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in close:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates(docs, prose, no_docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    prints = {i: plain_print(t) for i, t in enumerate(prose)}
    close = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 3]
    want = plain_components(list(prints), close)
    for r in rows:
        i = 7 if r["doc_id"] is None else r["doc_id"]
        assert r["fingerprint"] & (2**64 - 1) == prints[i] and r["component_id"] == want[i]
    assert simhash.near_duplicates(no_docs).count() == 0


def test_links_connect_all_close_prints(spark):
    """Also where a group is cut into parts, and where a third of the prints are near one another."""
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 4])):
            base ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(base)
    hub = rng.getrandbits(64)
    prints |= {hub ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8, 16)}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    found = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    want = plain_components(signed, close)
    for rows in (2048, 5):
        links = simhash.links(found, group_rows=rows)
        assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 3 for r in links.collect())
        got = {r["id"]: r["component"] for r in components(links).collect()}
        assert {i: got.get(i, i) for i in signed} == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5)]
    rng.shuffle(edges)
    ids = sorted({i for e in edges for i in e if e[0] != e[1]})
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == plain_components(ids, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_near_duplicates(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert kept.count() == len(groups)
    assert {r["doc_id"] for r in kept.collect()} == groups


@pytest.mark.parametrize("drop", [exact.drop_exact_duplicates, simhash.drop_near_duplicates])
def test_rows_do_not_follow_the_cores(spark, tmp_path, drop):
    """The same rows stay when files are dealt to another number of tasks between planning and running."""
    rows = [(i, f"text {i % 150} of the river and the stone {i % 150}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(20, "doc_id").write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        kept = drop(stored)
        spark.conf.set("spark.sql.files.minPartitionNum", "16")
        got = [r["text"] for r in kept.collect()]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
    if drop is exact.drop_exact_duplicates:
        assert sorted(got) == sorted({t for _, t in rows})
    else:
        assert len(got) == simhash.near_duplicates(stored).select("component_id").distinct().count()
