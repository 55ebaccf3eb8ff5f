"""How the tokens of two tokenizers lie on each other, and how many documents hold each linked pair of tokens.

Both tokenizers cut the same bytes, a space and the text. An A token and a B token are linked where their bytes overlap;
the offsets where tokens of both end cut a document into groups.

1. Documents are encoded once, and their ids stored.
2. First pass: documents are aligned, and each batch stores its different pairs with the number of documents that hold
   them.
3. A minimal perfect hash of all different pairs is built shard by shard, so that a pair has a slot in the dense count
   vector of its shard. Tasks fill such vectors, which are summed by a tree of additions of 16 at a time.
4. Second pass: documents are aligned again, and each link looks its count up by its pair's slot; the key in the slot is
   compared with the pair.

Pairs, vectors and hashes grow with the corpus and stay distributed. Tasks get them in tables of some ``TABLE_PAIRS`` pairs
(17 bytes each), one pass for each; sums of partial results are exact. The one thing kept whole is the highest count of
each A id, a number for each entry of its vocabulary.

Both libraries encode each different piece once while a worker keeps it. Pieces are what A's pre-tokeniser makes, cut by
the scan of ``bpe``. B takes the same pieces, joined wherever a piece of B's vocabulary holds the two characters at the
border, so that no merge of B can reach across one.

Texts that are null or empty, or that the joined tokens do not give back, have no tokens: zeros and an empty digest.
Repeated rows and null ids count as documents each. An empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm.bpe import cut_pieces, safe_parts
from parley.llm.common import PieceCache, group_sums, map_batches, piece_cache, take_ragged, texts_of, worker_state
from parley.llm.token_output import byte_letters
from parley.llm.vectors import PerfectHash, mixed, perfect_levels, tree_sum
from parley.session import materialize

BATCH_BYTES = 4 << 20
CHUNK_CHARS = 1_000_000
SHARD_PAIRS = 4096
TABLE_PAIRS = 2 << 20
CACHED_PIECES = 240_000
# The mark of a space in B's pieces, and the id that stands for a piece that is not given back.
MARK = "▁"
LOST = 0xFFFFFFFF
SHA_ROWS = 400_000


class ByteTokenizer:
    """A: byte-level BPE of the tokenizers library. It never merges across the pieces of its pre-tokeniser."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.letters = self.tokenizer.model, byte_letters()

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [[t.id for t in self.merges.tokenize(p.decode("latin-1").translate(self.letters))] for p in pieces]
        return _flat(ids)

    def token_bytes(self) -> list[bytes]:
        back = {c: b for b, c in self.letters.items()}
        known = json.loads(self.tokenizer.to_str())["model"]["vocab"]
        out = [b""] * (max(known.values(), default=-1) + 1)
        for token, i in known.items():
            out[i] = bytes(back[c] for c in token)
        return out


class PieceTokenizer:
    """B: a sentencepiece model. A space begins a piece, or lies in a run of spaces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.space = self.model.piece_to_id(MARK)
        self.table = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i)
            else b"" if self.model.is_control(i) or self.model.is_unknown(i) else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        shown = [name.replace(MARK, " ") for i, name in enumerate(names) if not self.model.is_byte(i)]
        if any(" " in name.lstrip(" ") for name in shown):
            raise ValueError("a piece of the model holds a space after something else")
        self.borders = np.array(sorted({ord(x) << 21 | ord(y) for name in shown for x, y in zip(name, name[1:])}), np.int64)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # the model puts a space in front. A piece that begins otherwise comes after a line feed, which nothing merges with
        texts = [p.decode() for p in pieces]
        asked = [t[1:] if t[0] == " " else "\n" + t for t in texts]
        out = self.model.encode(asked, num_threads=1)
        ids = []
        for piece, text, got in zip(pieces, texts, out):
            got = [self.space] if text == " " else got if text[0] == " " else got[2:]
            ids.append(got if b"".join([self.table[i] for i in got]) == piece else [LOST])
        return _flat(ids)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


class _Pair:
    """Both tokenizers of a worker, with their caches."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.cache_a, self.cache_b = PieceCache(self.a.encode, CACHED_PIECES), PieceCache(self.b.encode, CACHED_PIECES)


def _pair_of(path_a: str, path_b: str) -> _Pair:
    return piece_cache(f"pair:{path_a}:{path_b}", lambda: _Pair(path_a, path_b))


def byte_lengths(path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    return worker_state(
        f"lengths:{path_a}:{path_b}",
        lambda: tuple(np.array(list(map(len, t)), np.int64) for t in (ByteTokenizer(path_a).token_bytes(), PieceTokenizer(path_b).table)),
    )


def _looked_up(cache: PieceCache, pieces: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all pieces, and the number of ids of each text; ``bounds`` are pieces by text."""
    known = pieces.dictionary_encode()
    flat, starts, lengths = cache.lookup(known.dictionary.to_pylist())
    index = known.indices.to_numpy(zero_copy_only=False)
    sizes = lengths[index]
    return take_ragged(flat, starts[index], sizes), group_sums(sizes, bounds)


def encode_both(texts: list[str], path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of A, number by text, ids of B, number by text) of texts that begin with a space."""
    both = _pair_of(path_a, path_b)
    pieces, bounds, chars = cut_pieces(texts)
    ids_a, n_a = _looked_up(both.cache_a, pieces, bounds)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = np.cumsum(chars) - chars
    first = np.zeros(len(pieces), bool)
    first[bounds[:-1]] = True
    joins = np.isin(code[at - 1] << 21 | code[at], both.b.borders) & ~first
    # the pieces lie one after the other in one buffer, so a longer one is a wider pair of offsets
    offsets = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, pieces.offset * 4)
    wide = np.append(offsets[:-1][~joins], offsets[-1:])
    longer = pa.Array.from_buffers(pa.binary(), len(wide) - 1, [None, pa.py_buffer(wide), pieces.buffers()[2]])
    kept = np.append(0, np.cumsum(~joins))
    ids_b, n_b = _looked_up(both.cache_b, longer, kept[bounds])
    return ids_a, n_a, ids_b, n_b


def _chunks(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of texts with the places of their texts, some ``CHUNK_CHARS`` characters together.

    A long text is cut before white space that follows something else, where pieces of both tokenizers end.
    """
    places, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in safe_parts(" " + text, CHUNK_CHARS, blanks_only=True) if text else ():
            if size and size + len(part) > CHUNK_CHARS:
                yield places, parts
                places, parts, size = [], [], 0
            places.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield places, parts


def encode_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, and the ids ``a`` and ``b`` of every row, stored; both are empty where a text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, flats = np.zeros((2, batch.num_rows), np.int64), [[np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]]
            lost = np.zeros(batch.num_rows, bool)
            for places, parts in _chunks(batch.column(2).to_pylist()):
                ids_a, n_a, ids_b, n_b = encode_both(parts, path_a, path_b)
                np.add.at(counts, (0, places), n_a)
                np.add.at(counts, (1, places), n_b)
                np.logical_or.at(lost, places, group_sums(ids_b == LOST, np.append(0, np.cumsum(n_b))) > 0)
                flats[0].append(ids_a)
                flats[1].append(ids_b)
            columns = []
            for n, parts in zip(counts, flats):
                flat = np.concatenate(parts)[~np.repeat(lost, n)].astype(np.int32)
                bounds = np.append(0, np.cumsum(np.where(lost, 0, n))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["row", "doc_id", "a", "b"])

    docs = texts_of(df, id_col, text_col)
    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = f"row long, doc_id {df.schema[id_col].dataType.simpleString()}, a array<int>, b array<int>"
    return materialize(map_batches(docs, run, schema, BATCH_BYTES), "both_ids")


class Alignment:
    """Links and groups of a batch of documents, whose bytes lie one after the other.

    A link is a stretch of bytes between two neighbouring ends of tokens of either side.
    """

    def __init__(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, lengths: tuple[np.ndarray, np.ndarray]):
        self.a, self.n_a, self.b, self.n_b = a, n_a, b, n_b
        end_a, end_b = np.cumsum(lengths[0][a]), np.cumsum(lengths[1][b])
        size = int(end_a[-1]) + 1 if len(end_a) else 1
        in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
        in_a[end_a], in_b[end_b] = True, True
        cuts = np.flatnonzero(in_a | in_b)
        self.ends_a, self.ends_b = in_a[cuts], in_b[cuts]
        self.shared = self.ends_a & self.ends_b
        self.pairs = a[np.cumsum(self.ends_a) - self.ends_a].astype(np.uint64) << np.uint64(32)
        self.pairs |= b[np.cumsum(self.ends_b) - self.ends_b].astype(np.uint64)
        # links by document: the cuts up to the end of its last token
        last = np.append(0, end_a)[np.cumsum(n_a)]
        self.bounds = np.append(0, np.searchsorted(cuts, last, side="right"))
        self.bounds[1:][last == 0] = 0

    def document_of_links(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_a)), np.diff(self.bounds))

    def pair_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The different pairs, and how many documents of the batch hold each."""
        pairs, which = np.unique(self.pairs, return_inverse=True)
        held = self.document_of_links() * len(pairs) + which
        held.sort()
        new = np.ones(len(held), bool)
        new[1:] = held[1:] != held[:-1]
        return pairs, np.bincount(held[new] % max(len(pairs), 1), minlength=len(pairs))

    def digests(self, table: pa.Array) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` by document; ``table`` has the three endings of id i from place 3 * i on."""
        group = np.cumsum(self.shared) - self.shared
        group_a, group_b = group[self.ends_a], group[self.ends_b]
        n = int(self.shared.sum())
        before_b = np.append(0, np.cumsum(np.bincount(group_b, minlength=n)))
        through_a = np.cumsum(np.bincount(group_a, minlength=n))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + before_b[group_a]] = 3 * self.a.astype(np.int64) + self.shared[self.ends_a]
        code[np.arange(len(self.b)) + through_a[group_b]] = 3 * self.b.astype(np.int64) + 2 * self.shared[self.ends_b]
        bounds = np.append(0, np.cumsum(self.n_a + self.n_b))
        out: list[str] = []
        begin = 0
        while begin < len(self.n_a):
            # some SHA_ROWS tokens at a time, and one document at least
            stop = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SHA_ROWS, side="right")) - 1)
            texts = table.take(pa.array(code[bounds[begin] : bounds[stop]]))
            at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1) if len(texts) else np.zeros(1, np.int64)
            data = memoryview(texts.buffers()[2]) if len(texts) else memoryview(b"")
            for i in range(begin, stop):
                lo, hi = at[bounds[i] - bounds[begin]], at[bounds[i + 1] - bounds[begin]]
                out.append(hashlib.sha256(data[lo : hi - 1]).hexdigest() if hi > lo else "")
            begin = stop
        return out


def _ending_table(ids: int) -> pa.Array:
    # in the order of the codes: within a group, after the A tokens, after the group
    return worker_state(f"endings:{ids}", lambda: pa.array([f"{i}{c}" for i in range(ids) for c in ",|;"], pa.large_string()))


def _aligned(batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]) -> Alignment:
    sides = []
    for name in ("a", "b"):
        column = batch.column(name)
        sides += [column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)]
    return Alignment(*sides, lengths)


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(pairs, 0) % np.uint64(shards)).astype(np.int64)


def batch_pairs(encoded: DataFrame, lengths_of: Callable[[], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(pair, n): the different pairs of each batch with the number of its documents that hold them, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = lengths_of()
        for batch in batches:
            pairs, n = _aligned(batch, lengths).pair_documents()
            yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n)], ["pair", "n"])

    return materialize(map_batches(encoded.select("a", "b"), run, "pair long, n long", BATCH_BYTES), "batch_pairs")


def hash_shards(pairs: DataFrame, shard_pairs: int) -> tuple[DataFrame, int]:
    """The minimal perfect hash of all different pairs: (shard, n, sizes, words, keys) by shard, stored; and the shards."""
    different = materialize(pairs.select("pair").distinct(), "pairs")
    shards = max(1, math.ceil(different.count() / shard_pairs))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys, shards).astype(np.int32)), batch.column(0)], ["shard", "pair"])

    def build(rows: pa.Table) -> pa.Table:
        sizes, words, keys = perfect_levels(rows["pair"].to_numpy().view(np.uint64))
        found = [[rows["shard"][0].as_py()], [len(keys)], [sizes.tobytes()], [words.tobytes()], [keys.tobytes()]]
        return pa.table([pa.array(v, t) for v, t in zip(found, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=names)

    names = ["shard", "n", "sizes", "words", "keys"]
    numbered = map_batches(different, number, "shard int, pair long", BATCH_BYTES)
    built = numbered.groupBy("shard").applyInArrow(build, "shard int, n long, sizes binary, words binary, keys binary")
    return materialize(built, "hash_shards"), shards


def _part(table: DataFrame, lo: int, hi: int) -> DataFrame:
    return table.filter((F.col("shard") >= lo) & (F.col("shard") < hi))


def _hash_of(table: DataFrame, lo: int, hi: int) -> list[list[np.ndarray]]:
    """What PerfectHash takes for the shards in [lo, hi); one pass sends it to its tasks as plain arrays."""
    rows = {r["shard"]: r for r in _part(table, lo, hi).select("shard", "sizes", "words", "keys").toLocalIterator()}
    found = [[np.frombuffer(rows[s][c] if s in rows else b"", t) for s in range(lo, hi)] for c, t in (("sizes", "<i8"), ("words", "<u8"), ("keys", "<u8"))]
    return found


def dense_counts(pairs: DataFrame, known: Broadcast, shards: int, lo: int, hi: int) -> DataFrame:
    """(segment, values): the count vector (int64) of each shard in [lo, hi), summed by a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PerfectHash(*known.value)
        counts = np.zeros(len(table.keys), np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            shard = shard_of(keys, shards)
            inside = np.flatnonzero((shard >= lo) & (shard < hi))
            slots = table.slots(keys[inside], shard[inside] - lo)
            if len(slots) and slots.min() < 0:
                raise ValueError("a pair has no slot")
            # pairs of one batch of documents differ, but a batch here may hold those of several
            counts += np.bincount(slots, batch.column(1).to_numpy()[inside], len(counts)).astype(np.int64)
        # a slot of a shard is a bit that is set in its words
        ends = np.append(table.rank, len(table.keys))[np.append(table.begin[:, 0], len(table.words))] if len(table.keys) else np.zeros(hi - lo + 1, np.int64)
        part = TaskContext.get().partitionId()
        for i in range(hi - lo):
            vector = counts[ends[i] : ends[i + 1]]
            if vector.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lo + i], pa.int32()), pa.array([part], pa.int64()), pa.array([vector.tobytes()], pa.binary())],
                    ["segment", "part", "values"],
                )

    parts = materialize(map_batches(pairs, run, "segment int, part long, values binary", BATCH_BYTES), "count_parts")
    return materialize(tree_sum(parts, "<i8"), "counts")


def highest_counts(shards: DataFrame, counts: DataFrame, ids: int) -> np.ndarray:
    """The highest count of each A id, over all pairs: one number for each entry of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.zeros(ids, np.int64)
            for keys, values in zip(batch.column(0), batch.column(1)):
                a = (np.frombuffer(keys.as_buffer(), "<u8") >> np.uint64(32)).astype(np.int64)
                np.maximum.at(best, a, np.frombuffer(values.as_buffer(), "<i8"))
            used = np.flatnonzero(best)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(best[used])], ["a", "n"])

    joined = shards.join(counts, shards["shard"] == counts["segment"]).select("keys", "values")
    best = map_batches(joined, run, "a int, n long", BATCH_BYTES).groupBy("a").agg(F.max("n").alias("n"))
    out = np.zeros(ids, np.int64)
    for row in best.toLocalIterator():
        out[row["a"]] = row["n"]
    return out


def _second_pass(
    encoded: DataFrame, known: Broadcast, lengths_of: Callable[[], tuple[np.ndarray, np.ndarray]], shards: int, lo: int, hi: int, first: bool
) -> DataFrame:
    """row, n_best and count_sum of the links whose pairs lie in the shards [lo, hi); the first pass has all other columns too."""
    doc_type = encoded.schema["doc_id"].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = lengths_of()
        arrays, counts, best = known.value
        table = PerfectHash(*arrays)
        for batch in batches:
            found = _aligned(batch, lengths)
            pairs, which = np.unique(found.pairs, return_inverse=True)
            shard = shard_of(pairs, shards)
            inside = np.flatnonzero((shard >= lo) & (shard < hi))
            slots = table.slots(pairs[inside], shard[inside] - lo)
            if len(slots) and slots.min() < 0:
                raise ValueError("a pair has no slot")
            n, top = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            n[inside] = counts[slots]
            top[inside] = counts[slots] == best[(pairs[inside] >> np.uint64(32)).astype(np.int64)]
            sums = [group_sums(top[which], found.bounds), group_sums(n[which], found.bounds)]
            columns = [batch.column("row")]
            if first:
                groups = group_sums(found.shared, found.bounds)
                sums = [found.n_a, found.n_b, groups, np.diff(found.bounds), *sums]
                columns.append(batch.column("doc_id"))
            columns += [pa.array(s.astype(np.int64)) for s in sums]
            if first:
                columns.append(pa.array(found.digests(_ending_table(max(map(len, lengths)))), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", *(["doc_id"] if first else []), *(numbers if first else numbers[-2:]), *(["groups_sha256"] if first else [])]
    types = {"doc_id": doc_type, "groups_sha256": "string"}
    return map_batches(encoded, run, ", ".join(f"{c} {types.get(c, 'long')}" for c in names), BATCH_BYTES)


def align(
    df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", shard_pairs: int = SHARD_PAIRS,
    table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts links whose pair is held by as many documents as any pair of its A id; count_sum adds up the
    documents of each link's pair.
    """
    spark = df.sparkSession
    encoded = encode_documents(df, path_a, path_b, id_col, text_col)

    def lengths_of() -> tuple[np.ndarray, np.ndarray]:
        return byte_lengths(path_a, path_b)

    pairs = batch_pairs(encoded, lengths_of)
    hashes, shards = hash_shards(pairs, shard_pairs)
    step = max(1, table_pairs // shard_pairs)
    tables = [(lo, min(shards, lo + step)) for lo in range(0, shards, step)]
    counts: DataFrame | None = None
    for lo, hi in tables:
        found = dense_counts(pairs, spark.sparkContext.broadcast(_hash_of(hashes, lo, hi)), shards, lo, hi)
        counts = found if counts is None else counts.unionByName(found)
    best = highest_counts(hashes, counts, len(lengths_of()[0]))
    out: DataFrame | None = None
    for lo, hi in tables:
        rows = counts.filter((F.col("segment") >= lo) & (F.col("segment") < hi)).toLocalIterator()
        dense = {r["segment"]: np.frombuffer(r["values"], "<i8") for r in rows}
        values = np.concatenate([np.zeros(0, np.int64), *[dense[s] for s in sorted(dense)]])
        known = spark.sparkContext.broadcast((_hash_of(hashes, lo, hi), values, best))
        found = _second_pass(encoded, known, lengths_of, shards, lo, hi, out is None)
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    if len(tables) > 1:
        others = [c for c in out.columns if c not in ("row", "n_best", "count_sum")]
        sums = [F.sum(c).alias(c) for c in ("n_best", "count_sum")]
        out = out.groupBy("row").agg(*[F.max(c).alias(c) for c in others], *sums)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
