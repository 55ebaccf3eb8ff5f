"""Exact duplicates by deterministic block naming; DataFrame operations only.

Each text, with A-Z in lower case, is cut into blocks of fixed size. Equal blocks get one integer name, in the
order of the sorted blocks of a shard. Then names of adjacent pairs are named in the same way, level by level,
until one name of each document is left. Names stand for contents, not for hashes, so two documents share
(number of blocks, name) exactly if their texts are equal.

Whole blocks travel once, to be named, and are first merged within each task, so a block that a third of all
documents have costs a row per task. Documents look their names up by a 64-bit hash of the block. Where two
different blocks share a hash (kept apart when they are named), the block itself decides.

Nulls count as empty texts, which are equal to each other. Of equal texts the row with the largest doc_id
stays, and of repeated rows with that id exactly one; null ids are the smallest. An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import free_name
from parley.session import materialize

BLOCK_BYTES = 4096


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are. Texts of ASCII only take the faster function."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(slow)


def _blocks(text: Column, size: int) -> Column:
    data = F.encode(text, "UTF-8")
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(text) / size).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def name_blocks(blocks: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """(h, block, name) of the different blocks; ``block`` is null unless another block has the same hash."""
    same_hash = blocks.select(hashed(F.col("block")).alias("h"), "block").groupBy("h").agg(F.collect_set("block").alias("same"))
    listed = same_hash.select("h", F.explode("same").alias("block"), (F.size("same") > 1).alias("shared"))
    named = listed.sortWithinPartitions("block").withColumn("name", F.monotonically_increasing_id())
    return materialize(named.select("h", F.when(F.col("shared"), F.col("block")).alias("block"), "name"), "block_names")


def _named_blocks(occurrences: DataFrame, names: DataFrame) -> DataFrame:
    """Occurrences (h, block, ...) with their names, without the block itself."""
    if names.filter(F.col("block").isNotNull()).isEmpty():
        return occurrences.drop("block").join(names.drop("block"), "h").drop("h")
    other = names.select(F.col("h").alias("_h"), F.col("block").alias("_block"), "name")
    same = (F.col("h") == F.col("_h")) & (F.col("_block").isNull() | (F.col("block") == F.col("_block")))
    return occurrences.join(other, same).drop("h", "block", "_h", "_block")


def _next_level(parts: DataFrame) -> DataFrame:
    """Names of adjacent pairs; a last one without a neighbour is paired with -1."""
    pairs = parts.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
        F.max("left_over").alias("before"),
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
        F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("second"),
    )
    pairs = pairs.select("row", "pos", (F.shiftright(F.col("before") + 1, 1)).alias("left_over"), "first", F.coalesce("second", F.lit(-1)).alias("second"))
    pairs = materialize(pairs, "pairs")
    names = pairs.select("first", "second").distinct().sortWithinPartitions("first", "second")
    names = materialize(names.withColumn("name", F.monotonically_increasing_id()), "pair_names")
    return materialize(pairs.join(names, ["first", "second"]).select("row", "pos", "left_over", "name"), "named_pairs")


def identities(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None,
    block_bytes: int = BLOCK_BYTES, hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """row, doc_id, text_sha256 and the identity (n_blocks, name) of every row.

    ``row`` is a number of the row that later stages can join by; without it the rows are numbered here.
    """
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    texts = df.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_col).alias("doc_id"), text.alias("text")
    )
    names = name_blocks(texts.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block")), hashed)
    occurrences = texts.select(
        "row", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode(_blocks(F.col("text"), block_bytes)).alias("pos", "block"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes).cast("int")).alias("n_blocks"),
    )
    first = F.col("pos") == 0
    parts = occurrences.select(
        "row", "pos", "n_blocks", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("text_sha256")).alias("text_sha256"),
        hashed(F.col("block")).alias("h"), "block",
    )
    parts = materialize(_named_blocks(parts, names), "named_blocks")
    meta = parts.filter(first).select("row", "doc_id", "text_sha256", "n_blocks")
    done = [parts.filter("n_blocks = 1").select("row", "name")]
    left = parts.filter("n_blocks > 1").select("row", "pos", F.col("n_blocks").alias("left_over"), "name")
    most = left.agg(F.max("left_over").alias("n")).first()["n"] or 1
    while most > 1:
        level = _next_level(left)
        done.append(level.filter("left_over = 1").select("row", "name"))
        left, most = level.filter("left_over > 1"), (most + 1) // 2
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return meta.join(found, "row")


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None,
    block_bytes: int = BLOCK_BYTES, hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: row, doc_id, keep_id, group_size, kept, text_sha256."""
    every = materialize(identities(df, id_col, text_col, row, block_bytes, hashed), "identities")
    groups = every.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    groups = materialize(groups, "groups")
    return every.join(groups, ["n_blocks", "name"]).select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    The numbered rows are stored: a number made anew in each scan would follow how files are dealt to the cores at hand.
    """
    row = free_name(df.columns, "_row")
    numbered = materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = exact_duplicates(numbered, id_col, text_col, F.col(row))
    dropped = found.filter(~F.col("kept")).select(F.col("row").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*df.columns)
