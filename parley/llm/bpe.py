"""Byte-level BPE: texts to ids and back, equal to what the tiktoken library gives.

The pre-tokeniser uses no regular expression. Each character gets a symbol: its class, and what the next
one to three characters decide (a contraction, the last blank before a word). A symbol is then a function
from the state before it to the state after it. Such functions compose associatively, so the states of a
whole batch come from a blocked prefix scan, and with them the places where a piece begins. Pieces are cut
out of the UTF-8 bytes by these offsets; equal pieces are merged once and kept by the worker.

Nulls count as empty texts, which have no ids. Repeated rows are encoded each. Only the id and the text are
read; other columns stay as they are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import PieceCache, group_sums, map_batches, piece_cache, take_ragged, texts_of, worker_state

# Character classes, and Unicode's white space.
LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)
WHITE_SPACE = [
    *range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Symbols. SHORT and LONG are an apostrophe before a contraction of one and of two letters; LAST_SPACE and LAST_BLANK
# come right before a character that is not white; MIDDLE is any other white character; RESET is between two texts.
S_LETTER, S_NUMBER, S_OTHER, SHORT, LONG, LAST_SPACE, LAST_BLANK, MIDDLE, RESET = range(9)
# States: what the piece that is open now may still take. CLOSED: nothing; ONE, TWO: letters of a contraction.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE, TWO, AFTER_SPACE, IN_WHITE = range(8)
STATES, SYMBOLS = 8, 9
BLOCK = 512
CHUNK_CHARS = 2_000_000
LONG_PIECE = 100
NO_RANK = 1 << 31


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins, by symbol * STATES + state."""
    then, begins = np.zeros((SYMBOLS, STATES), np.uint8), np.ones((SYMBOLS, STATES), np.uint8)
    for symbol, run in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHER)):
        then[symbol] = run
        begins[symbol, [run, AFTER_SPACE]] = 0
    for symbol, state in ((SHORT, ONE), (LONG, TWO)):
        then[symbol] = state
        # no contraction where the apostrophe goes on with other signs or belongs to a space
        then[symbol, [IN_OTHER, AFTER_SPACE]] = IN_OTHER
        begins[symbol, [IN_OTHER, AFTER_SPACE]] = 0
    then[LAST_SPACE], then[LAST_BLANK], then[MIDDLE], then[RESET] = AFTER_SPACE, CLOSED, IN_WHITE, CLOSED
    begins[MIDDLE, IN_WHITE] = 0
    then[S_LETTER, TWO], then[S_LETTER, ONE] = ONE, CLOSED
    begins[S_LETTER, [ONE, TWO]] = 0
    return then.ravel(), begins.ravel()


THEN, BEGINS = _transitions()


def _library_classes(points: list[int]) -> list[int]:
    """Classes as tiktoken's own Unicode data has them: a piece joins a character to a letter, number or sign before it."""
    ranks = {bytes([i]): i for i in range(256)}
    for first in (b"a", b"1", b"!"):
        for lead in range(256):
            ranks[first + bytes([lead])] = len(ranks)
    # fixed value: the alternatives for letters, numbers and other signs
    pattern = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"
    probe = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = []
    for c in points:
        alone = len(chr(c).encode()) + 1
        joins = [len(probe.encode_ordinary(first + chr(c))) < alone for first in "a1!"]
        out.append(joins.index(True) if any(joins) else BLANK)
    return out


def character_classes() -> np.ndarray:
    """Class of every code point. Where two Unicode versions disagree, tiktoken itself is asked."""
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    newer, classes = np.full(0x110000, OTHER, np.uint8), np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, every))
    for kind, name in ((LETTER, "L"), (NUMBER, "N")):
        found = "".join(regex.findall(rf"\p{{{name}}}+", text))
        newer[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    classes[every] = [{"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in text]
    unsure = np.flatnonzero(newer != classes)
    classes[unsure] = _library_classes(unsure.tolist())
    classes[WHITE_SPACE] = BLANK
    classes[32] = SPACE
    return classes


def _symbols(code: np.ndarray, resets: np.ndarray) -> np.ndarray:
    classes = worker_state("character_classes", character_classes)[code]
    ahead = np.concatenate([code[1:], np.zeros(2, code.dtype)])
    first, second = ahead[:-1], ahead[1:]
    white = classes >= SPACE
    white[resets] = True  # white at the end of a text is not followed by a word
    solid_next = np.append(~white[1:], False)
    symbol = classes.astype(np.uint8)
    symbol[white] = MIDDLE
    symbol[white & solid_next] = LAST_BLANK
    symbol[(classes == SPACE) & solid_next] = LAST_SPACE
    at = np.flatnonzero(code == ord("'"))
    a, b = first[at], second[at]
    symbol[at[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
    pairs = np.zeros(len(at), bool)
    for x, y in ("re", "ve", "ll"):
        pairs |= (a == ord(x)) & (b == ord(y))
    symbol[at[pairs]] = LONG
    symbol[resets] = RESET
    return symbol


def piece_starts(symbol: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Positions where a piece begins, by a scan over the symbols' transition functions."""
    n = len(symbol)
    rows = -(-n // block)
    padded = np.full(rows * block, RESET, np.uint8)
    padded[:n] = symbol
    steps = np.ascontiguousarray(padded.reshape(rows, block).T).astype(np.int16) * STATES
    # the function of each block: its end state for every state before it
    ends = np.repeat(np.arange(STATES, dtype=np.int16)[:, None], rows, axis=1)
    for step in steps:
        ends = THEN[step + ends].astype(np.int16)
    # prefix compositions by doubling; composition is associative
    reach = 1
    while reach < rows:
        later = np.take_along_axis(ends[:, reach:], ends[:, :-reach], axis=0)
        ends = np.concatenate([ends[:, :reach], later], axis=1)
        reach *= 2
    state = np.concatenate([[CLOSED], ends[CLOSED, :-1]]).astype(np.int16)
    begins = np.empty((block, rows), np.uint8)
    for j, step in enumerate(steps):
        move = step + state
        begins[j] = BEGINS[move]
        state = THEN[move].astype(np.int16)
    return np.flatnonzero(begins.T.ravel()[:n])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Merges:
    """The ranks, and all pairs of ids that merge: every split of a ranked piece into two ranked pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks.get(bytes([i]), 0) for i in range(256)], np.int64)
        pairs = sorted(
            (a << 32 | b, rank)
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if (a := ranks.get(piece[:cut])) is not None and (b := ranks.get(piece[cut:])) is not None
        )
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.values = np.array([v for _, v in pairs] or [NO_RANK], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NO_RANK)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        short: list[int] = []
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = np.array([whole], np.int64)
            elif len(piece) > LONG_PIECE:
                out[i] = np.array(_merge_long(piece, self.ranks), np.int64)
            else:
                short.append(i)
        for i, ids in zip(short, self._merge([pieces[i] for i in short])):
            out[i] = ids
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), lengths

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """All pieces at once. In a round each merges its pair of lowest rank, the leftmost first; those without one leave."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        which = np.arange(len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.rank(ids, np.append(ids[1:], 0))
        rank[np.cumsum(lengths) - 1] = NO_RANK
        while len(which):
            starts = np.cumsum(lengths) - lengths
            low = np.minimum.reduceat(rank, starts)
            going = low < NO_RANK
            if not going.all():
                for i in np.flatnonzero(~going):
                    out[which[i]] = ids[starts[i] : starts[i] + lengths[i]].copy()
                keep = np.repeat(going, lengths)
                ids, rank, which, lengths, low = ids[keep], rank[keep], which[going], lengths[going], low[going]
                if not len(which):
                    break
                starts = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(which)), lengths)
            at = np.flatnonzero(rank == low[owner])
            at = at[np.diff(owner[at], prepend=-1) != 0]
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, rank = ids[keep], rank[keep]
            at = at - np.arange(len(at))
            lengths = lengths - 1
            first = np.cumsum(lengths) - lengths
            last = first + lengths - 1
            rank[at] = np.where(at < last, self.rank(ids[at], ids[np.minimum(at + 1, len(ids) - 1)]), NO_RANK)
            left = at[at > first]
            rank[left - 1] = self.rank(ids[left - 1], ids[left])
        return out


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by a heap of pairs, for pieces where a search through all pairs would be quadratic."""
    end = len(piece)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    heap: list[tuple[int, int, int]] = []

    def propose(i: int) -> None:
        if i >= 0 and (j := after[i]) < end and (rank := ranks.get(piece[i : after[j]])) is not None:
            heapq.heappush(heap, (rank, i, after[j]))

    for i in range(end - 1):
        propose(i)
    gone = bytearray(end + 1)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or (j := after[i]) >= end or after[j] != stop:
            continue
        gone[j] = 1
        after[i] = stop
        if stop < end:
            before[stop] = i
        propose(i)
        propose(before[i])
    out, i = [], 0
    while i < end:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


# Places where a piece always begins: white space after anything else; a sign or a digit after a letter.
_WHITE = "".join(map(chr, WHITE_SPACE)).replace("-", "\\-")
_AT_BLANK = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_AT_SIGN = re.compile("(?<=[A-Za-z])(?=[!-@\\[-`{-~])|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])(?=[!-@\u3001\u3002\uff01\uff0c\uff1f])")


def safe_parts(text: str, most: int = CHUNK_CHARS, blanks_only: bool = False) -> Iterator[str]:
    """A long text cut where a piece always begins: before white characters that follow others, and where none come for
    ``most`` characters, at a sign after a letter (unless ``blanks_only``)."""
    begin = 0
    while len(text) - begin > most:
        found = _AT_BLANK.search(text, begin + most, min(len(text), begin + 2 * most) if not blanks_only else len(text))
        if not found and not blanks_only:
            found = _AT_SIGN.search(text, begin + most) or _AT_BLANK.search(text, begin + most)
        if not found or found.start() >= len(text):
            break
        yield text[begin : found.start()]
        begin = found.start()
    if begin < len(text) or not text:
        yield text[begin:]


class Encoded:
    """A chunk of texts as ids: ``ids`` flat with ``bounds`` by text. The pieces' bytes, characters and ids keep the offsets."""

    __slots__ = ("ids", "bounds", "piece_bytes", "piece_tokens", "piece_bounds", "piece_chars")

    def __init__(self, ids, bounds, piece_bytes, piece_tokens, piece_bounds, piece_chars):
        self.ids, self.bounds, self.piece_chars = ids, bounds, piece_chars
        self.piece_bytes, self.piece_tokens, self.piece_bounds = piece_bytes, piece_tokens, piece_bounds


def _cache_of(path: str) -> PieceCache:
    return piece_cache(f"bpe:{path}", lambda: PieceCache(Merges(read_ranks(path)).encode))


def cut_pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of all texts as one binary array over their joined bytes, where each text's pieces begin, and the
    pieces' lengths in characters."""
    joined = "\x00".join([*texts, ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    resets = np.cumsum(sizes + 1) - 1
    starts = piece_starts(_symbols(code, resets))
    width = np.ones(len(code), np.int64)
    for limit in (0x80, 0x800, 0x10000):
        width += code >= limit
    at = np.append(np.cumsum(width) - width, width.sum())
    data = joined.encode("utf-8", "surrogatepass")
    offsets = np.append(at[starts], len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    # the mark between two texts is a piece of its own
    marks = np.searchsorted(starts, resets)
    keep = np.ones(len(starts), bool)
    keep[marks] = False
    bounds = np.concatenate([[0], np.cumsum(np.diff(np.concatenate([[-1], marks])) - 1)])
    return pieces.filter(pa.array(keep)), bounds, np.diff(np.append(starts, len(code)))[keep]


def encode_texts(texts: list[str], path: str) -> Encoded:
    pieces, bounds, chars = cut_pieces(texts)
    known = pieces.dictionary_encode()
    flat, starts, lengths = _cache_of(path).lookup(known.dictionary.to_pylist())
    index = known.indices.to_numpy()
    tokens = lengths[index]
    ids = take_ragged(flat, starts[index], tokens)
    sizes = np.diff(np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, pieces.offset * 4)).astype(np.int64)
    ends = np.append(0, np.cumsum(tokens))
    return Encoded(ids, ends[bounds], sizes, tokens, bounds, chars)


def _vocabulary(path: str) -> pa.Array:
    def make() -> pa.Array:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            table[rank] = piece
        return pa.array(table, pa.binary())

    return worker_state(f"vocabulary:{path}", make)


def decode_ids(ids: np.ndarray, bounds: np.ndarray, path: str) -> list[bytes]:
    """The bytes behind each run of ids: one gather of the vocabulary, cut at the texts' bounds."""
    out: list[bytes] = []
    vocabulary = _vocabulary(path)
    pieces = vocabulary.take(pa.array(ids))
    offsets = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1) if len(pieces) else np.zeros(1, np.int32)
    data = pieces.buffers()[2] if len(pieces) else pa.py_buffer(b"")
    for a, b in zip(offsets[bounds[:-1]], offsets[bounds[1:]]):
        out.append(memoryview(data)[a:b].tobytes())
    return out


def _groups(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts, some ``most`` characters together; a long text comes alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def encode_each(texts: list[str], path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its ids, and of its pieces the bytes and the number of ids."""
    for _, group in _groups(texts):
        parts = [list(safe_parts(t)) for t in group]
        if len(group) == 1 and len(parts[0]) > 1:
            done = [encode_texts([p], path) for p in parts[0]]
            yield tuple(np.concatenate([getattr(e, k) for e in done]) for k in ("ids", "piece_bytes", "piece_tokens"))
            continue
        e = encode_texts(group, path)
        for i in range(len(group)):
            p, q = e.piece_bounds[i], e.piece_bounds[i + 1]
            yield e.ids[e.bounds[i] : e.bounds[i + 1]], e.piece_bytes[p:q], e.piece_tokens[p:q]


def encode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, and by piece ``piece_bytes`` and ``piece_tokens``: lengths from which any range can be decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(encode_each(batch.column(1).to_pylist(), ranks_path))
            columns = [pa.array([r[k].astype(np.int32) for r in rows], pa.list_(pa.int32())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "ids", "piece_bytes", "piece_tokens"])

    schema = f"doc_id {df.schema[id_col].dataType.simpleString()}, ids array<int>, piece_bytes array<int>, piece_tokens array<int>"
    return map_batches(texts_of(df, id_col, text_col), run, schema)


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and ``decoded``, the bytes behind the ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            decoded = decode_ids(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), bounds, ranks_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    ids = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return map_batches(ids, run, f"doc_id {df.schema[id_col].dataType.simpleString()}, decoded binary")


def round_trip(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode, in one pass: doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids, _, _ in encode_each(batch.column(1).to_pylist(), ranks_path):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                back = decode_ids(ids, np.array([0, len(ids)]), ranks_path)[0]
                of_bytes.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {df.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(texts_of(df, id_col, text_col), run, schema)
