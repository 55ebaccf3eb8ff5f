"""Helpers of the operators in this folder: text batches, worker caches, ragged arrays, held-out rows."""

from __future__ import annotations

import ctypes
import sys
import types
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
CACHED_PIECES = 500_000
# Bits of a filter of keys: for each key, and at most.
KEY_BITS = 16
FILTER_BITS = 1 << 27


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Batches of text reach Python by bytes, not by rows, so that long texts don't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text counts as empty. Only these columns are read."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it; Spark does not tell capitals apart."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has the given remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps for its later tasks.

    The package travels by value, so its own globals begin anew in each task.
    """
    store = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def take_ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i] : starts[i] + lengths[i]]``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i] : bounds[i + 1]]``; an empty range gives 0."""
    sums = np.concatenate([np.zeros(1, dtype=np.result_type(values, np.int64)), np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


class _Generation:
    """Pieces with their ids; ``at`` is a piece's place in ``starts`` and ``lengths``."""

    def __init__(self) -> None:
        self.at: dict = {}
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("i")

    def add(self, pieces: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.at.update(zip(pieces, range(len(self.starts), len(self.starts) + len(pieces))))
        self.starts.frombytes((len(self.ids) + np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        self.lengths.frombytes(lengths.astype(np.int32).tobytes())
        self.ids.frombytes(flat.astype(np.uint32).tobytes())

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # copies: a view would forbid the arrays to grow
        return np.array(self.ids, np.uint32), np.array(self.starts, np.int64), np.array(self.lengths, np.int64)


class PieceCache:
    """Ids of text pieces, encoded once per worker while they are in use.

    Two generations hold some ``most`` pieces: once the younger has half of them, it becomes the older one, whose
    pieces are kept only if they are asked for again. So frequent pieces stay and rare ones go.
    ``encode`` gives the flat ids of a list of pieces and the number of ids of each.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = CACHED_PIECES):
        self.encode, self.most = encode, most
        self.young, self.old = _Generation(), _Generation()

    def lookup(self, pieces: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, start of each piece, length of each piece)."""
        if len(self.young.at) >= self.most // 2:
            self.young, self.old = _Generation(), self.young
        known, before = self.young.at, self.old.at
        missing = [p for p in dict.fromkeys(pieces) if p not in known]
        again = [p for p in missing if p in before]
        if again:
            flat, starts, lengths = self.old.arrays()
            places = np.fromiter(map(before.__getitem__, again), np.int64, len(again))
            self.young.add(again, take_ragged(flat, starts[places], lengths[places]), lengths[places])
        new = [p for p in missing if p not in before] if again else missing
        if new:
            self.young.add(new, *self.encode(new))
        index = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        flat, starts, lengths = self.young.arrays()
        return flat, starts[index], lengths[index]


def piece_cache(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the worker until a cache of another name is asked for.

    A worker runs the tasks of all operators of a session, one after the other; their caches would add up.
    """
    kept = worker_state("pieces", dict)
    if name not in kept:
        kept.clear()
        release_memory()
        kept[name] = make()
    return kept[name]


def release_memory() -> None:
    """Give back to the system what the last batch left free in the pools of Arrow and of the C library."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def maybe_among(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``df`` without most of the rows whose ``column`` is not in ``keys``, and with all whose is; a join by it then shuffles less.

    Each key sets a bit, KEY_BITS for each key and FILTER_BITS at most, so the driver sees 16 MB at most.
    """
    n = keys.count()
    size = min(FILTER_BITS, KEY_BITS * max(n, 1))
    place = F.pmod(F.xxhash64(column), F.lit(size))
    marked = keys.filter(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("bucket"))
    rows = marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bitmap = np.zeros((size // 32768 + 2, 4096), np.uint8)
    for r in rows:
        bitmap[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)

    @F.arrow_udf("boolean")
    def marks(places: pa.Array, buckets: pa.Array) -> pa.Array:
        at, row = places.to_numpy(zero_copy_only=False), buckets.to_numpy(zero_copy_only=False)
        return pa.array((bitmap[row, at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return df.filter(F.col(column).isNotNull() & marks(F.bitmap_bit_position(place), F.bitmap_bucket_number(place)))


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, size: int = BATCH_BYTES
) -> DataFrame:
    bounded_batches(df.sparkSession, size)
    return df.mapInArrow(fn, schema)
