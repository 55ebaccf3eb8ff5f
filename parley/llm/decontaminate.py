"""Benchmark passages in documents, whole or with few edits, by the q-gram lemma.

A copy of an item of m characters with at most k edits shares m - q + 1 - kq q-grams with it, and all of them lie on
k + 1 neighbouring diagonals. Texts are normalised (letters and digits in lower case, anything else one blank). For
each group of items of similar length a bit table marks the q-grams that occur in any; stretches of a document with too
few marks for a whole copy are left out. For the rest, shared q-grams are counted per document, item and band of
diagonals. Bands overlap by half, so that each copy lies in one. Bands that meet the bound are aligned, all bands of an
item at once, within their diagonals; the edit distance decides. No step loses a copy within the budget.

The budget k is ``edit_rate`` of the item's length, lowered for short items so that at least LEAST_SHARED q-grams stay.
Items with fewer than ``least_chars`` normalised characters, for which edits would leave too little, match exactly and at word
bounds (in scripts without blanks, anywhere). The items are the query set: they reach the tasks in blocks of at most
``block_chars`` characters, each block in one pass over the documents.

Null and empty texts and items match nothing. Equal items are each reported. Of several copies of an item in a document
the one with the fewest edits is reported, then the first. Repeated rows are searched each. An empty benchmark, or no
documents, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bounded_batches, map_batches, texts_of, worker_state

Q = 12
EDIT_RATE = 0.05
LEAST_SHARED = 8
LEAST_CHARS = 24
BLOCK_CHARS = 4_000_000
CHUNK_CHARS = 1 << 20
MARK_BITS = 22
ALIGNED = 512
_BASE = 0x9E3779B97F4A7C15
_BETWEEN = 0x110000
# Code points from here on are of scripts that mostly write no blanks.
_UNSPACED = 0x2E80


def _normal_table() -> np.ndarray:
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not (x := chr(c)).isalnum():
            continue
        low = x.lower()
        table[c] = ord(low) if len(low) == 1 else c
    return table


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points and the position in the text that each comes from."""
    code = worker_state("normal_characters", _normal_table)[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = code == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    code = code[at]
    # no blank at either end
    lo, hi = int(len(code) > 0 and code[0] == 32), len(code) - int(len(code) > 1 and code[-1] == 32)
    return code[lo:hi], at[lo:hi]


def qgram_hashes(code: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q characters from each position on; equal q-grams have equal hashes."""
    n = len(code) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # powers of two are put together, as in exponentiation
    part, size = code.astype(np.uint64), 1
    out, done = None, 0
    while True:
        if q & size:
            piece = part[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(pow(_BASE, size, 1 << 64)) + piece
            done += size
        if 2 * size > q:
            return out
        part = part[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2


def _marks(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


@dataclass
class Group:
    """Items of similar length with their q-grams, sorted by hash."""

    items: np.ndarray
    bit: int
    grams: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    window: int
    least: int


class Benchmark:
    """The items of one block, normalised, with their edit budgets and thresholds."""

    def __init__(self, texts: list[str], q: int = Q, edit_rate: float = EDIT_RATE, least_chars: int = LEAST_CHARS):
        self.q = q
        self.codes = [normalise(t)[0] for t in texts]
        self.size = np.fromiter(map(len, self.codes), np.int64, len(texts))
        room = (self.size - q + 1 - LEAST_SHARED) // q
        self.edits = np.maximum(0, np.minimum((self.size * edit_rate).astype(np.int64), room))
        self.shared = self.size - q + 1 - self.edits * q
        searched = np.flatnonzero(self.size >= max(least_chars, q))
        # lengths double from group to group, so there are few; each has a bit in the table of marks
        self.marks = np.zeros(1 << MARK_BITS, np.uint32)
        powers = np.floor(np.log2(np.maximum(self.size, 1)))[searched]
        self.short = self._short(max(least_chars, q))
        self.groups = [self._group(searched[powers == p], 1 << bit) for bit, p in enumerate(np.unique(powers))]

    def _short(self, limit: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, hashes in order, their items) of the items below ``limit``, by length."""
        out = []
        for n in np.unique(self.size[(self.size > 0) & (self.size < limit)]):
            items = np.flatnonzero(self.size == n)
            hashes = np.concatenate([qgram_hashes(self.codes[i], int(n)) for i in items])
            order = np.argsort(hashes, kind="stable")
            out.append((int(n), hashes[order], items[order]))
        return out

    def _group(self, items: np.ndarray, bit: int) -> Group:
        hashes = [qgram_hashes(self.codes[i], self.q) for i in items]
        grams = np.concatenate(hashes)
        owner = np.repeat(items, [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        order = np.argsort(grams, kind="stable")
        self.marks[_marks(np.unique(grams))] |= np.uint32(bit)
        window = int((self.size[items] + self.edits[items]).max())
        return Group(items, bit, grams[order], owner[order], place[order], window, int(self.shared[items].min()))


def _kept_positions(group: Group, marked: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Of the positions with a marked q-gram, those in stretches where a window has as many as any item of the group needs."""
    at = marked[marks & np.uint32(group.bit) != 0]
    if len(at) < group.least:
        return at[:0]
    # runs of ``least`` marks within a window; each covers its marks
    near = at[group.least - 1 :] - at[: len(at) - group.least + 1] < group.window
    cover = np.zeros(len(at) + 1, np.int64)
    starts = np.flatnonzero(near)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + group.least, -1)
    return at[np.cumsum(cover[:-1]) > 0]


def band_candidates(bench: Benchmark, hashes: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    """Rows (item, first diagonal, document) of the bands that share enough q-grams with an item."""
    found = []
    marks = bench.marks[_marks(hashes)]
    marked = np.flatnonzero(marks)
    marks = marks[marked]
    for group in bench.groups:
        kept = _kept_positions(group, marked, marks)
        lo, hi = np.searchsorted(group.grams, hashes[kept]), np.searchsorted(group.grams, hashes[kept], side="right")
        times = hi - lo
        hit = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())
        at, item = np.repeat(kept, times), group.owner[hit]
        step = bench.edits[item] + 1
        # shifted, so that diagonals before the first character stay positive
        diagonal = at - group.place[hit] + (1 << 32)
        # a diagonal lies in the band that begins at or before it and in the one before that
        bands = np.concatenate([diagonal // step, diagonal // step - 1]) * np.tile(step, 2)
        keys = np.stack([np.tile(item, 2), bands, np.tile(doc_of[at], 2)])
        keys = keys[:, np.lexsort(keys)]
        new = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        first = np.flatnonzero(np.append(True, new)[: keys.shape[1]])
        counts = np.diff(np.append(first, keys.shape[1]))
        keys = keys[:, first]
        found.append(keys[:, counts >= bench.shared[keys[0]]])
    out = np.unique(np.concatenate(found, axis=1).T, axis=0) if found else np.zeros((0, 3), np.int64)
    out[:, 1] -= 1 << 32
    return out


def align(item: np.ndarray, windows: np.ndarray, edits: int, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, begin, end) of the best copy of ``item`` in each window, whose first ``slack`` places may begin it.

    Dynamic programming over the diagonals -edits .. slack + edits for all windows at once. A cell holds
    edits * 4096 + begin, so that the smallest has the fewest edits and then the first place.
    """
    n, width, unit = len(windows), slack + 2 * edits + 1, 1 << 20
    far = (len(item) + width + 1) * unit
    shift = np.arange(width) * unit
    best = np.full((n, width), far, np.int64)
    best[:, edits : edits + slack + 1] = np.arange(slack + 1)
    padded = np.full((n, edits + len(item) + slack + edits + 1), -1, np.int64)
    padded[:, edits : edits + windows.shape[1]] = windows
    for i, c in enumerate(item):
        cells = best + unit * (padded[:, i : i + width] != c)
        cells[:, :-1] = np.minimum(cells[:, :-1], best[:, 1:] + unit)
        best = np.minimum.accumulate(cells - shift, axis=1) + shift
    end = best.argmin(axis=1)
    value = best[np.arange(n), end]
    return value // unit, value % unit, len(item) + end - edits


def _whole_words(code: np.ndarray, begin: int, end: int) -> bool:
    """Whether a run of characters begins and ends at word bounds; letters of scripts without blanks need none."""

    def bound(left: int, right: int) -> bool:
        return not (0 < left < _UNSPACED and 0 < right < _UNSPACED and left != 32 and right != 32)

    first = begin == 0 or bound(int(code[begin - 1]), int(code[begin]))
    return first and (end == len(code) or bound(int(code[end - 1]), int(code[end])))


def _short_hits(bench: Benchmark, code: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, begin, end) of the first exact place of each short item in a text's normalised characters."""
    for n, hashes, items in bench.short:
        found = qgram_hashes(code, n)
        lo, hi = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
        seen: set[int] = set()
        for at in np.flatnonzero(hi > lo):
            for item in items[lo[at] : hi[at]]:
                if item not in seen and (code[at : at + n] == bench.codes[item]).all() and _whole_words(code, int(at), int(at) + n):
                    seen.add(item)
                    yield int(item), int(at), int(at) + n


def search(bench: Benchmark, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, begin, end, edits) of each item found in each text; begin and end are places in the text."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) <= CHUNK_CHARS):
            size += len(texts[stop])
            stop += 1
        _search_chunk(bench, texts[begin:stop], begin, out)
        begin = stop
    return [(text, item, *rest) for (text, item), rest in sorted(out.items())]


def _search_chunk(bench: Benchmark, texts: list[str], base: int, out: dict) -> None:
    normal = [normalise(t) for t in texts]
    gap = np.array([_BETWEEN], np.uint32)
    code = np.concatenate([x for c, _ in normal for x in (c, gap)])
    sizes = np.fromiter((len(c) for c, _ in normal), np.int64, len(normal))
    starts = np.cumsum(sizes + 1) - sizes - 1
    hashes = qgram_hashes(code, bench.q)
    doc_of = np.repeat(np.arange(len(texts)), sizes + 1)[: len(hashes)]
    rows = band_candidates(bench, hashes, doc_of)
    for d, (own, origin) in enumerate(normal if bench.short else []):
        for item, b, e in _short_hits(bench, own):
            out[base + d, item] = (int(origin[b]), int(origin[e - 1]) + 1, 0)
    bounds = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else []
    for lo, hi in zip(bounds, [*bounds[1:], len(rows)]):
        item = int(rows[lo, 0])
        edits, length = int(bench.edits[item]), int(bench.size[item])
        slack = 2 * (edits + 1)
        for a in range(lo, hi, ALIGNED):
            part = rows[a : min(hi, a + ALIGNED)]
            first, doc = part[:, 1], part[:, 2]
            places = first[:, None] + np.arange(length + slack + edits)[None, :]
            inside = (places >= starts[doc][:, None]) & (places < (starts + sizes)[doc][:, None])
            windows = np.where(inside, code[np.clip(places, 0, len(code) - 1)].astype(np.int64), -1)
            cost, b, e = align(bench.codes[item].astype(np.int64), windows, edits, slack)
            for d, f, n, x, y in zip(doc, first, cost, b, e):
                if n <= edits:
                    origin = normal[d][1]
                    # a copy may begin or end with deletions at the text's own ends
                    x = min(max(int(f + x - starts[d]), 0), len(origin) - 1)
                    y = min(max(int(f + y - starts[d]), x + 1), len(origin))
                    hit = (int(n), int(origin[x]), int(origin[y - 1]) + 1)
                    key = (base + int(d), item)
                    if key not in out or (hit[0], hit[1]) < (out[key][2], out[key][0]):
                        out[key] = (hit[1], hit[2], hit[0])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """The items, in blocks by hash of some ``block_chars`` characters."""
    items = texts_of(benchmark, id_col, text_col).filter("text <> ''")
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    parts = math.ceil(size / block_chars)
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == part).toArrow()
        yield rows["doc_id"].combine_chunks(), rows["text"].to_pylist()


def find_passages(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", edit_rate: float = EDIT_RATE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, begin, end (places in the text), edits, item_chars."""
    docs = texts_of(df, id_col, text_col)
    schema = (
        f"doc_id {df.schema[id_col].dataType.simpleString()}, item_id {benchmark.schema[item_col].dataType.simpleString()}, "
        "begin int, end int, edits int, item_chars int"
    )
    found = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark, item_col, item_text_col, block_chars):
        found = found.unionByName(map_batches(docs, _finder(ids, texts, edit_rate, least_chars), schema))
    return found


def _finder(ids: pa.Array, texts: list[str], edit_rate: float, least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(texts, edit_rate=edit_rate, least_chars=least_chars)
        for batch in batches:
            rows = search(bench, batch.column(1).to_pylist())
            at = [np.array(c, np.int32) for c in zip(*rows)] or [np.zeros(0, np.int32)] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at[0])), ids.take(pa.array(at[1])), *map(pa.array, at[2:]),
                    pa.array(bench.size[at[1]].astype(np.int32)),
                ],
                ["doc_id", "item_id", "begin", "end", "edits", "item_chars"],
            )

    return run


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", edit_rate: float = EDIT_RATE,
    least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``df``, with all columns, in whose text no item is found. Nothing is shuffled."""
    bounded_batches(df.sparkSession)
    kept = df
    place = df.columns.index(text_col)
    items = benchmark.select(F.lit(0).alias("item"), F.col(item_text_col).alias("text"))
    for _, texts in _blocks(items, "item", "text", block_chars):
        kept = kept.mapInArrow(_filter(texts, place, edit_rate, least_chars), df.schema)
    return kept


def _filter(texts: list[str], place: int, edit_rate: float, least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(texts, edit_rate=edit_rate, least_chars=least_chars)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[row[0] for row in search(bench, [t or "" for t in batch.column(place).to_pylist()])]] = False
            yield batch.filter(pa.array(keep))

    return run
