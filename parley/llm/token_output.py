"""Token ids as binary files of patched frame-of-reference blocks.

A file holds the ids of many documents, in ascending order of their ids, cut into blocks of 4,096. A block
stores its minimum, the differences to it packed at the width that a percentile of them needs, and a list of
exceptions (position, high bits) for the wider ones. An index of block starts and of documents, and a footer,
follow. So one block can be read alone, and a document is found without reading the others.

Spark writes the files (one record a line, by its text writer, so that only finished tasks leave files and any
store will do) and reads them back with its binary reader. No file depends on another: the place of a document
in the whole sequence comes from the files' sums.

Nulls count as empty texts; every document has at least its end id. Repeated ids stay apart and are ordered by
a hash of their text; rows that are equal in both may lie in several files. A null id comes first. An empty table gives no files with content. Other columns are not read.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm.common import PieceCache, group_sums, map_batches, piece_cache, release_memory, take_ragged, texts_of
from parley.session import materialize

BLOCK_IDS = 4096
PERCENTILE = 90
FILE_TEXT_BYTES = 16 << 20
ENCODED_TOGETHER = 4096
CACHED_WORDS = 240_000
BATCH_BYTES = 6 << 20
# Fixed values of the file format: block header (ids, minimum, exceptions, width), footer (documents, blocks, ids,
# place of the index, shard), mark at the end. Every record is followed by a line feed.
HEADER = "<IIHB"
FOOTER = "<QQQQQ8s"
MARK = b"TOKPFOR1"
# Letters that the tokenizer's normaliser leaves as they are, and those that it only puts in lower case.
PLAIN = re.compile(r"[a-z\xDF-\xF6\xF8-\xFF]+")
LATIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
# Signs that end a word without joining it (the apostrophe begins contractions), where they follow a digit or one of the
# Latin letters that no normalisation turns into a letter and a mark, which would join the signs after it.
STABLE = r"[0-9A-Za-z\x{C0}-\x{12F}\x{131}-\x{24F}]"
TRAILING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def pack_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """A block of at most 65,535 ids. The width is that of the given percentile of the differences to the minimum."""
    low = int(ids.min())
    gaps = (ids - low).astype(np.uint32)
    rank = min(len(gaps) - 1, math.ceil(len(gaps) * percentile / 100) - 1)
    width = int(np.partition(gaps, rank)[rank]).bit_length()
    outliers = np.flatnonzero(gaps >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(gaps.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return b"".join(
        (
            struct.pack(HEADER, len(ids), low, len(outliers), width),
            np.packbits(bits.ravel(), bitorder="little").tobytes(),
            outliers.astype("<u2").tobytes(),
            (gaps[outliers] >> np.uint32(width)).astype("<u4").tobytes(),
        )
    )


def unpack_block(data: memoryview | bytes, at: int = 0) -> np.ndarray:
    n, low, n_outliers, width = struct.unpack_from(HEADER, data, at)
    at += struct.calcsize(HEADER)
    size = (n * width + 7) // 8
    # eight spare bytes, so that each value can be read as part of one 64-bit word
    packed = np.frombuffer(bytes(data[at : at + size]) + bytes(8), np.uint8)
    words = np.ndarray((size + 1,), "<u8", packed, 0, (1,))
    begin = np.arange(n, dtype=np.int64) * width
    gaps = (words[begin >> 3] >> (begin & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)
    at += size
    where = np.frombuffer(data, "<u2", n_outliers, at)
    gaps[where] |= np.frombuffer(data, "<u4", n_outliers, at + 2 * n_outliers).astype(np.uint64) << np.uint64(width)
    return (gaps + np.uint64(low)).astype(np.uint32)


class FileBuilder:
    """Records of one file, as ids arrive."""

    def __init__(self, shard: int, block_ids: int = BLOCK_IDS):
        self.shard, self.block_ids, self.size, self.total = shard, block_ids, 0, 0
        self.rest, self.starts = np.zeros(0, np.uint32), []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def _record(self, data: bytes) -> bytes:
        self.size += len(data) + 1
        return data

    def add(self, doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        self.doc_ids.extend(doc_ids)
        self.counts.extend(counts.tolist())
        self.rest = np.concatenate([self.rest, ids])
        full = len(self.rest) // self.block_ids * self.block_ids
        yield from self._blocks(self.rest[:full])
        self.rest = self.rest[full:]

    def _blocks(self, ids: np.ndarray) -> Iterator[bytes]:
        for lo in range(0, len(ids), self.block_ids):
            self.starts.append(self.size)
            self.total += len(ids[lo : lo + self.block_ids])
            yield self._record(pack_block(ids[lo : lo + self.block_ids]))

    def finish(self) -> Iterator[bytes]:
        yield from self._blocks(self.rest)
        place = self.size
        yield self._record(
            b"".join(
                (
                    np.array(self.starts, "<u8").tobytes(),
                    np.array([d is not None for d in self.doc_ids], "u1").tobytes(),
                    np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
                    np.array(self.counts, "<u8").tobytes(),
                    struct.pack(FOOTER, len(self.doc_ids), len(self.starts), self.total, place, self.shard, MARK),
                )
            )
        )


def read_index(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shard, block starts, whether the document id is known, document ids, counts) of one file."""
    n_docs, n_blocks, _, at, shard, mark = struct.unpack_from(FOOTER, data, len(data) - struct.calcsize(FOOTER) - 1)
    if mark != MARK:
        raise ValueError("not a token file")
    starts = np.frombuffer(data, "<u8", n_blocks, at)
    known = np.frombuffer(data, "u1", n_docs, at := at + 8 * n_blocks)
    doc_ids = np.frombuffer(data, "<i8", n_docs, at := at + n_docs)
    return shard, starts, known.astype(bool), doc_ids, np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)


def word_parts(words: pa.Array) -> list[pa.Array]:
    """Words without the signs at their ends, and those signs; the tokenizer would part them as well.

    Words of ASCII or of Latin letters are put in lower case, as the tokenizer does. A word whose signs follow something else than a Latin
    letter or a digit stays whole, and so does one with a special token's brackets, as those are looked for before anything else.
    """
    heads = pc.utf8_rtrim(words, TRAILING)
    ends = pc.utf8_slice_codeunits(heads, -1, None)
    parted = pc.and_(pc.utf8_is_alnum(ends), pc.match_substring_regex(ends, STABLE))
    parted = pc.and_not(parted, pc.match_substring(words, "<|"))
    # the signs are the word without the head in front of it; they are ASCII, so bytes may be cut
    whole, kept = pc.binary_length(words).to_numpy(), pc.binary_length(heads).to_numpy()
    sizes = np.where(parted.to_numpy(zero_copy_only=False), whole - kept, 0)
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    signs = take_ragged(data, offsets[1:] - sizes, sizes)
    bounds = np.append(0, np.cumsum(sizes)).astype(np.int32)
    tails = pa.StringArray.from_buffers(len(words), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(signs)))
    heads = pc.if_else(parted, heads, words)
    plain = pc.and_not(pc.string_is_ascii(heads), pc.match_substring(words, "<|"))
    heads = pc.if_else(plain, pc.ascii_lower(heads), heads)
    return [pc.if_else(pc.match_substring_regex(heads, LATIN), pc.utf8_lower(heads), heads), tails]


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is visible, else one from 256 on."""
    shown = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def piece_encoder(tokenizer: Tokenizer) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Flat ids of a list of pieces and the number of ids of each.

    A piece of lower-case Latin letters is one word to the library, which its normaliser leaves as it is, so its merges
    are asked at once. All others take the whole way.
    """
    merges, letters = tokenizer.model, byte_letters()

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[list[int]] = [[]] * len(pieces)
        others: list[int] = []
        for i, piece in enumerate(pieces):
            if PLAIN.fullmatch(piece):
                known = piece if piece.isascii() else piece.encode().decode("latin-1").translate(letters)
                ids[i] = [t.id for t in merges.tokenize(known)]
            elif piece:
                others.append(i)
        # a few at a time, as the library's encodings are far larger than the ids
        for lo in range(0, len(others), ENCODED_TOGETHER):
            part = others[lo : lo + ENCODED_TOGETHER]
            for i, e in zip(part, tokenizer.encode_batch_fast([pieces[i] for i in part], add_special_tokens=False)):
                ids[i] = e.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    return encode


def _encoder(tokenizer_path: str) -> PieceCache:
    def make() -> PieceCache:
        # a task has one core; the library's threads would only get in each other's way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return PieceCache(piece_encoder(Tokenizer.from_file(tokenizer_path)), CACHED_WORDS)

    return piece_cache(f"words:{tokenizer_path}", make)


def encode_words(texts: pa.Array, tokenizer_path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts, each with the end id, and the number of ids of each.

    The tokenizer drops white space and never joins across it, so each different word of a batch is encoded once.
    """
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    # two places for each different word: its head, and the signs after it
    both = pa.concat_arrays(word_parts(words.dictionary)).dictionary_encode()
    flat, starts, lengths = _encoder(tokenizer_path).lookup(both.dictionary.to_pylist())
    index = words.indices.to_numpy(zero_copy_only=False)
    parts = both.indices.to_numpy(zero_copy_only=False).reshape(2, -1)
    per_word = lengths[parts].sum(axis=0)
    word_ids = take_ragged(flat, starts[parts.T.ravel()], lengths[parts.T.ravel()])
    word_starts = np.cumsum(per_word) - per_word
    bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
    counts = group_sums(per_word[index], bounds) + 1
    out = np.full(int(counts.sum()), end_id, np.uint32)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts) - 1] = False
    out[inside] = take_ragged(word_ids, word_starts[index], per_word[index])
    return out, counts


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    file_text_bytes: int = FILE_TEXT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text and write the files to ``path``; a file takes some ``file_text_bytes`` of text."""
    docs = texts_of(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"]
    files = max(1, math.ceil((size or 0) / file_text_bytes))
    # rows that are equal in all may be many: a number from the scan parts them
    docs = docs.withColumn("nth", F.monotonically_increasing_id())
    order = ["doc_id", F.xxhash64("text"), "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = FileBuilder(TaskContext.get().partitionId())
        for batch in batches:
            ids, counts = encode_words(batch.column(1), tokenizer_path, end_id)
            yield _records(builder.add(batch.column(0).to_pylist(), ids, counts))
            del ids, counts
            release_memory()
        if builder.doc_ids:
            yield _records(builder.finish())

    ordered = docs.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    records = map_batches(ordered, run, "record binary", BATCH_BYTES)
    records.select(F.col("record").cast("string").alias("value")).write.mode("error").text(path)


def _records(records: Iterator[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(records), pa.binary())], ["record"])


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32; with ``ids`` also the ids themselves.

    The sums behind ``start`` are one row per file.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer().to_pybytes()
                shard, starts, known, doc_ids, counts = read_index(data)
                flat = np.concatenate([unpack_block(data, int(s)) for s in starts]).astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(begins, ends)]
                columns = [
                    pa.array(np.full(len(counts), shard, np.int64)), pa.array(doc_ids, mask=~known), pa.array(begins),
                    pa.array(counts), pa.array(crcs, pa.int64()),
                ]
                if ids:
                    columns.append(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["shard", "doc_id", "before", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    schema = "shard long, doc_id long, before long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    docs = materialize(map_batches(files, run, schema), "token_index")
    shards = docs.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return docs.join(shards, "shard").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), *names[3:]
    )
