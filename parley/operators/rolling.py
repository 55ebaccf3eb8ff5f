"""Similar users over a moving window of days: co-occurrences are added and taken away as the window moves.

The stored state is who wrote about which campaign within the window, and the weight of each pair of users. Moving the window changes
the weights of those pairs only of which a user enters or leaves a campaign; all others are not counted again.

Weights are stored as sheets: a sheet has the weights of some users with others, a byte each where they are small, and the names once. They lie in
a table bucketed by pair of blocks of users, so a move reads them where they lie: members are shuffled, no pair is. Rows
(src, dst, weight) are made when the weights are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.pairs import BLOCK, PIECE, block_count, block_pairs, ordered, pair_pieces, pair_tasks, ranks, user_lists
from parley.session import bucketed_table, delete_path, materialize, path_exists, scratch_path
from parley.sources.tables import list_dirs

MEMBERS = "userid string, campaign string"
WEIGHTS = "src string, dst string, weight long"
SHEETS = "pair int, lefts array<string>, rights array<string>, weights binary"
# Users of a block at most: a task holds the weights of two blocks.
MOST_USERS = 4096


def store_days(events: DataFrame, root: str) -> None:
    """Put the (user, campaign) pairs of each day of ``events`` into the day table. A day is replaced, so reruns are harmless."""
    named = events.filter(F.col("userid").isNotNull() & F.col("campaign").isNotNull() & F.col("timestamp").isNotNull())
    pairs = named.select(F.to_date("timestamp").alias("day"), "userid", "campaign").distinct()
    pairs.hint("rebalance", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/days")


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _version(spark: SparkSession, root: str) -> int:
    """The last window that was written to its end, 0 where there is none."""
    written = [d.removeprefix("window-") for d in list_dirs(spark, root) if d.startswith("window-")]
    return max((int(n) for n in written if path_exists(spark, f"{root}/window-{n}/shape/_SUCCESS")), default=0)


def _sheet_table(spark: SparkSession, path: str, buckets: int) -> str:
    return bucketed_table(spark, path, SHEETS, "pair", buckets, "written")


def _list_array(parts: list[pa.Array]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) for p in parts]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([pa.array([], pa.string()), *parts]))


def _sheet_weights(weights: bytes, lefts: int, rights: int) -> np.ndarray:
    size = len(weights) // (lefts * rights)
    return np.frombuffer(weights, f"u{size}").reshape(lefts, rights)


def _sheets(pair: int, matrix: np.ndarray, left: pa.Array, right: pa.Array) -> pa.Table:
    """The weights over 0 of a matrix: some rows whole where many are, else each row's own."""
    lefts, rights, weights = [], [], []

    def add(a: pa.Array, b: pa.Array, w: np.ndarray) -> None:
        kind = np.uint8 if w.max() < 1 << 8 else np.uint16 if w.max() < 1 << 16 else np.uint32
        lefts.append(a)
        rights.append(b)
        weights.append(w.astype(kind).tobytes())

    step = max(1, PIECE // max(1, len(right)))
    for low in range(0, len(left), step):
        part = matrix[low : low + step]
        filled = np.count_nonzero(part, axis=1)
        if filled.sum() * 8 > part.size:
            add(left.slice(low, len(part)), right, part)
        else:
            for row in np.flatnonzero(filled):
                at = np.flatnonzero(part[row])
                add(left.slice(low + row, 1), right.take(pa.array(at)), part[row, at])
    return pa.table({"pair": pa.array([pair] * len(lefts), pa.int32()), "lefts": _list_array(lefts), "rights": _list_array(rights), "weights": pa.array(weights, pa.binary())})


def _moved(blocks: int):
    """Function (pair, its users, its sheets) -> its sheets after the move."""

    def move(key: tuple[pa.Scalar, ...], users: pa.Table, stored: pa.Table) -> pa.Table:
        pair = key[0].as_py()
        lo, hi = divmod(pair, blocks)
        # always in the same order, as only one half of the pairs within a block is kept
        users = users.sort_by("userid")
        homes = users["home"].to_numpy()
        a, b = (users.filter(pa.array(homes == home)) for home in (lo, hi))
        left, right = (t["userid"].combine_chunks() for t in (a, b))
        matrix = np.zeros((len(a), len(b)), np.int32)
        for sheet in stored.select(["lefts", "rights", "weights"]).to_batches(max_chunksize=1):
            x, y = sheet["lefts"].flatten(), sheet["rights"].flatten()
            at, near = (pc.index_in(n, value_set=names).to_numpy(zero_copy_only=False) for n, names in ((x, left), (y, right)))
            matrix[np.ix_(at, near)] = _sheet_weights(sheet["weights"][0].as_py(), len(x), len(y))
        for low, sums, found in pair_pieces(a, b):
            if found is None:
                matrix[low : low + len(sums)] += sums.astype(np.int32)
            else:
                matrix[found[0], found[1]] += found[2].astype(np.int32)
        if lo == hi:
            # each pair once
            matrix = np.triu(matrix, 1)
        here, there = (np.flatnonzero(t["present"].to_numpy(zero_copy_only=False)) for t in (a, b))
        return _sheets(pair, matrix[np.ix_(here, there)], left.take(pa.array(here)), right.take(pa.array(there)))

    return move


def _rows(_: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(src, dst, weight) of the sheets of a pair of blocks."""
    for batch in batches:
        for i in range(len(batch)):
            left, right = (batch[c].slice(i, 1).flatten() for c in ("lefts", "rights"))
            matrix = _sheet_weights(batch["weights"][i].as_py(), len(left), len(right))
            at, near = np.nonzero(matrix)
            names = pa.concat_arrays([left, right])
            yield ordered(names, at, near + len(left), matrix[at, near].astype(np.int64), ranks(names))


def move_window(spark: SparkSession, root: str, first: date, last: date, block: int = BLOCK) -> DataFrame:
    """SIMILAR_TO (src, dst, weight) over the days from ``first`` to ``last``, from the state of the window before.

    The new state is written beside the old one, which goes once the new one is complete. Where the users have become many more than the blocks were
    made for, all pairs are counted anew.
    """
    version = _version(spark, root)
    old, new = f"{root}/window-{version}", f"{root}/window-{version + 1}"
    # what a move that was cut off has left
    delete_path(spark, new)
    days = spark.read.parquet(f"{root}/days")
    inside: Column = (F.col("day") >= F.lit(first)) & (F.col("day") <= F.lit(last))
    now = days.filter(inside).select("userid", "campaign").distinct().withColumn("now", F.lit(True))
    before = _state(spark, f"{old}/members", MEMBERS).withColumn("before", F.lit(True))
    both = now.join(before, ["userid", "campaign"], "full_outer")
    both = materialize(both.select("userid", "campaign", F.coalesce("now", F.lit(False)).alias("now"), F.coalesce("before", F.lit(False)).alias("before")), "both")
    n = both.select("userid").distinct().count()
    wanted = max(block_count(n, block), math.ceil(n / MOST_USERS))
    shape = spark.read.parquet(f"{old}/shape").first() if version else None
    if shape and wanted <= 2 * shape["blocks"]:
        blocks, buckets, path, counted = shape["blocks"], shape["buckets"], f"{old}/weights", both
    else:
        # no table of weights lies there
        blocks, buckets, path = wanted, pair_tasks(spark, wanted), scratch_path(spark, "no_weights")
        counted = both.filter("now").withColumn("before", F.lit(False))
    stored = spark.table(_sheet_table(spark, path, buckets)).drop("written")
    users = block_pairs(user_lists(counted), blocks).repartition(buckets, "pair")
    moved = users.groupBy("pair").cogroup(stored.groupBy("pair")).applyInArrow(_moved(blocks), SHEETS)
    fresh = _sheet_table(spark, f"{new}/weights", buckets)
    _insert(spark, fresh, moved)
    both.filter("now").select("userid", "campaign").write.mode("overwrite").parquet(f"{new}/members")
    # its being there commits the window
    spark.createDataFrame([(blocks, buckets)], "blocks int, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{new}/shape")
    if version:
        delete_path(spark, old)
    return spark.table(fresh).drop("written").groupBy("pair").applyInArrow(_rows, WEIGHTS)


def _insert(spark: SparkSession, table: str, sheets: DataFrame) -> None:
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (written = 1) SELECT * FROM {{sheets}}", sheets=sheets)
