import hashlib
import zlib

import pandas as pd
import pytest

import corpus_pipeline
from parley.llm.queries import QUERIES
from test_duplicates import plain_components, plain_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    from parley.session import materialize

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        out.append(docs.toPandas())
    return out


def test_stages(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    good, exact, near, clean, encoded = stages
    assert all(list(s.columns) == list(docs.columns) for s in stages[:-1])
    scored = QUERIES["op6_quality"](spark, SF).toPandas()
    assert set(good.doc_id) == set(scored[scored.predicted == 1].doc_id)
    # largest id of equal texts
    lowered = good.assign(low=[t.encode().lower() for t in good.text])
    assert set(exact.doc_id) == set(lowered.groupby("low").doc_id.max())
    # one document of each group of fingerprints at most three bits apart, by all pairs
    prints = {i: plain_print(t) for i, t in zip(exact.doc_id, exact.text)}
    ids = sorted(prints)
    close = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(near.doc_id) == set(plain_components(ids, close).values())
    items = pd.read_parquet(f"{SF}/benchmark.parquet").text
    holds = near.text.map(lambda t: any(i in t for i in items))
    assert not set(near[holds].doc_id) & set(clean.doc_id)
    assert len(encoded) == len(clean)
    want = {hashlib.sha256(t.encode()).hexdigest() for t in clean.text}
    assert set(encoded.decoded_sha256) == want


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = stages[-1].sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("name, modulus, rest", [("op3_toxicity", 5, 0), ("op6_quality", 3, 1), ("op9_language", 4, 2)])
def test_held_out(spark, name, modulus, rest):
    for r in QUERIES[name](spark, SF).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest)
