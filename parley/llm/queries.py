"""The operators' queries over whole tables, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import alignment, bpe, decontaminate, edit_counts, exact, language, license_rules, quality, simhash, token_output, toxicity, vector_copies, whitening
from parley.llm.common import held_out
from parley.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

END_ID = 2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark, sf_dir):
    path = scratch_path(spark, "token_files")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_output.read_tokens(spark, path)


@query
def op2_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op3_toxicity(spark, sf_dir):
    apart = held_out(F.col("doc_id"), 5, 0)
    scored = toxicity.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~apart)
    return scored.select("doc_id", apart.alias("held_out"), "score", "predicted")


@query
def op4_licences(spark, sf_dir):
    found = license_rules.scan_licences(table(spark, sf_dir, "documents"))
    return found.withColumn("sentences", F.concat_ws(",", "sentences"))


@query
def op5_edit_counts(spark, sf_dir):
    """Three edits of every document, at a quarter, half and three quarters of the text that is there by then."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    n = F.length(F.coalesce(F.col("text"), F.lit("")))
    cut = F.least(n - F.floor(n / 4), F.lit(10))

    def edit(begin, end, new):
        return F.struct(begin.cast("int").alias("begin"), end.cast("int").alias("end"), F.lit(new).alias("replacement"))

    left = n - cut
    half, late = F.floor(left / 2), F.floor(left * 3 / 4)
    edits = F.array(
        edit(F.floor(n / 4), F.floor(n / 4) + cut, ""), edit(half, half + 5, "redacted"), edit(late, late, " [removed] ")
    )
    counted = edit_counts.count_tokens(table(spark, sf_dir, "documents"), ranks, keep={"edits": edits})
    return edit_counts.recount(counted, ranks).select(
        "doc_id", "n_tokens_before", "n_tokens", F.length("text").alias("n_chars"), "encoded_chars"
    )


@query
def op6_quality(spark, sf_dir):
    apart = held_out(F.col("doc_id"), 3, 1)
    scored = quality.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~apart)
    return scored.select("doc_id", apart.alias("held_out"), "score", "predicted")


@query
def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.hex_print(F.col("fingerprint")))


@query
def op8_benchmark_leaks(spark, sf_dir):
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_language(spark, sf_dir):
    apart = held_out(F.col("doc_id"), 4, 2)
    found = language.predict(table(spark, sf_dir, "documents"), ~apart)
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score", F.col("languages.lang").alias("languages"))


@query
def op10_block_naming(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


SQL["op10_block_naming"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM d"""


@query
def op11_token_alignment(spark, sf_dir):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query
def op12_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c")
    # a deviation that no long can hold is null
    deviation = F.col("deviation").try_cast("long").alias("deviation")
    return found.select("vec_id", "n", deviation, "identity_error", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


@query
def op13_vector_copies(spark, sf_dir):
    return vector_copies.near_copies(table(spark, sf_dir, "embeddings"))
