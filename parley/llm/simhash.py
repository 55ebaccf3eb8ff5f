"""Near duplicates by SimHash fingerprints.

A fingerprint's bit is set if it is set in over half of the hashes of a text's word shingles. To find all pairs of
fingerprints at ``distance`` or fewer bits, the 64 bits are cut into blocks. At most ``distance`` blocks of a close
pair differ, so the pair agrees on some choice of ``blocks - distance`` blocks: fingerprints are grouped by each
choice, and compared within a group by their true Hamming distance.

Only different fingerprints are compared, so exact copies cost nothing. A group yields links that connect its close
fingerprints, at most one less than it has members, not all its pairs. A group beyond ``group_rows`` is cut into
parts by hash, and each pair of parts is compared in a task of its own.

Nulls and texts without words have fingerprint zero and are linked like any other. Repeated rows are linked to each
other. An empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import free_name, map_batches, texts_of
from parley.llm.components import components
from parley.session import materialize

# Shingle length and hash seed of the fingerprints.
SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6
GROUP_ROWS = 2048
_SHINGLES = 1 << 16


def shingle_hashes(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    # bytes.lower and bytes.split know ASCII only: A-Z, and the six white characters
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.append(0, ends[:-1] + 1)
    k = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    count = len(parts) - k + 1
    spans = zip(begins[:count].tolist(), ends[k - 1 :].tolist())
    return np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    sums = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _SHINGLES):
        part = hashes[lo : lo + _SHINGLES].astype("<u8").view(np.uint8).reshape(-1, 8)
        sums += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(shingle_hashes(t, words, seed)) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    schema = f"doc_id {df.schema[id_col].dataType.simpleString()}, fingerprint long"
    return map_batches(texts_of(df, id_col, text_col), run, schema)


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Signed 64-bit masks of every choice of the blocks on which a close pair may agree."""
    if not distance < blocks <= 64:
        raise ValueError("blocks must exceed the distance")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [int(np.uint64(sum(c)).view(np.int64)) for c in combinations(parts, blocks - distance)]


def linking_edges(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints of one group that are close, directly or by others."""
    left, right = [], []
    open_ = np.sort(prints)
    while len(open_) > 1:
        front, open_ = [open_[0]], open_[1:]
        while front and len(open_):
            at = front.pop()
            near = np.bitwise_count(open_ ^ at) <= distance
            if near.any():
                found = open_[near]
                left.append(np.full(len(found), at))
                right.append(found)
                front.extend(found)
                open_ = open_[~near]
    if not left:
        return prints[:0], prints[:0]
    return np.concatenate(left), np.concatenate(right)


def _group_edges(keys: list[np.ndarray], prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys; pairs at once, larger groups one by one."""
    new = np.zeros(len(prints), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(prints)))
    two = starts[sizes == 2]
    close = np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance
    left, right = [prints[two][close]], [prints[two + 1][close]]
    for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
        a, b = linking_edges(prints[s : s + n], distance)
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) among different fingerprints (column ``fingerprint``, stored) that connect all close ones."""
    masks = block_masks(blocks, distance)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]))
    keyed = prints.select("fingerprint", choice.alias("c")).select("c.choice", "c.key", "fingerprint")
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = materialize(sizes.withColumn("parts", F.ceil(F.col("n") / group_rows).cast("int")), "group_sizes")
    grouped = keyed.join(sizes.select("choice", "key", "parts"), ["choice", "key"])
    home = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    copies = grouped.select("*", home.alias("home")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    cells = copies.select(
        "choice", "key", F.least("home", "other").alias("lo"), F.greatest("home", "other").alias("hi"), "fingerprint"
    )
    names = ["choice", "key", "lo", "hi"]
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a group may reach over batches, so the last one of each waits for the next
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            columns = [rows[c].to_numpy() for c in names]
            same = np.ones(rows.num_rows, bool)
            for c in columns:
                same &= c == c[-1]
            cut = rows.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = rows.slice(cut)
            if cut:
                yield emit(rows.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield emit(rest)

    def emit(rows: pa.Table) -> pa.RecordBatch:
        found = rows["fingerprint"].to_numpy().view(np.uint64)
        a, b = _group_edges([rows[c].to_numpy() for c in names], found, distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = cells.repartition(n, *names).sortWithinPartitions(*names)
    return map_batches(dealt, run, "a long, b long")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
    distance: int = DISTANCE, blocks: int = BLOCKS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id that links reach, of every row."""
    docs = materialize(fingerprints(df, id_col, text_col, words), "fingerprints")
    prints = materialize(docs.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "prints")
    found = components(links(prints.select("fingerprint"), distance, blocks, group_rows))
    linked = prints.join(found.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
    linked = linked.select("fingerprint", "low", F.coalesce("component", "fingerprint").alias("component"))
    lows = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    reached = materialize(linked.join(lows, "component").select("fingerprint", "component_id"), "reached")
    return docs.join(reached, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_print(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, distance: int = DISTANCE
) -> DataFrame:
    """One row of each component, the first by doc_id, with all its columns.

    Rows are numbered, as ids may repeat or be null, and stored with their numbers: a number made anew in each scan
    would follow how files are dealt to the cores at hand.
    """
    row = free_name(df.columns, "_row")
    numbered = materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    # null ids come last
    key = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    keyed = numbered.select(key.alias("key"), F.col(text_col).alias("text"))
    found = near_duplicates(keyed, "key", "text", words, distance)
    dropped = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.row").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*df.columns)
