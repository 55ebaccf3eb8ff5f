"""Token counts that follow edits, without encoding a document again.

Of each document a tree is kept: its leaves are runs of some LEAF_PIECES pre-tokens with their characters and byte-BPE
ids, its inner nodes the sums of the leaves below. An edit replaces a range of characters. Only the leaves it touches
are encoded again, with context: to the left so much that the first boundary cannot see the edit, to the right leaf by
leaf until a pre-token begins where an old leaf begins, from where on nothing changes. The new pre-tokens are dealt out
over the touched leaves, and the sums above them are updated. A leaf that has grown too much makes the document's tree
anew from its known leaves' texts.

``begin`` and ``end`` of an edit are characters of the text that the edits before it left; they are clipped to it, and
a null edit or replacement counts as none and as empty. Null texts count as empty. Edits of one document apply in the
order of its list. Rows are independent, so repeated ids are counted each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.bpe import CHUNK_CHARS, encode_texts, safe_parts
from parley.llm.common import group_sums, map_batches

LEAF_PIECES = 64
MOST_PIECES = 8 * LEAF_PIECES
# the furthest character that decides on a boundary: two letters of a contraction, and one to spare
CONTEXT_CHARS = 4


class Tree:
    """Leaves (characters, pieces, ids) and the sums of ids above them, as a heap: node i has children 2i and 2i + 1."""

    __slots__ = ("chars", "pieces", "sums")

    def __init__(self, chars: np.ndarray, pieces: np.ndarray, tokens: np.ndarray | None = None, sums: np.ndarray | None = None):
        self.chars, self.pieces = chars, pieces
        if sums is None:
            size = self.width
            sums = np.zeros(2 * size, np.int64)
            sums[size : size + len(tokens)] = tokens
            for i in range(size - 1, 0, -1):
                sums[i] = sums[2 * i] + sums[2 * i + 1]
        self.sums = sums

    @property
    def width(self) -> int:
        return 1 << max(0, (len(self.chars) - 1).bit_length())

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def update(self, first: int, chars: np.ndarray, pieces: np.ndarray, tokens: np.ndarray) -> None:
        """New values of some leaves; only the sums above them change."""
        last = first + len(chars)
        self.chars[first:last], self.pieces[first:last] = chars, pieces
        lo, hi = self.width + first, self.width + last - 1
        self.sums[lo : hi + 1] = tokens
        while lo > 1:
            lo, hi = lo >> 1, hi >> 1
            self.sums[lo : hi + 1] = self.sums[2 * lo : 2 * hi + 2 : 2] + self.sums[2 * lo + 1 : 2 * hi + 2 : 2]


def _runs(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return group_sums(values, cuts)


def build_trees(texts: list[str], ranks_path: str) -> Iterator[Tree]:
    """A tree of each text."""
    for piece_chars, piece_tokens in _encoded(texts, ranks_path):
        cuts = np.arange(0, max(len(piece_chars), 1) + LEAF_PIECES, LEAF_PIECES).clip(max=len(piece_chars))
        cuts = np.unique(cuts) if len(piece_chars) else np.zeros(2, np.int64)
        yield Tree(_runs(piece_chars, cuts), np.diff(cuts), _runs(piece_tokens, cuts))


def _encoded(texts: list[str], ranks_path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Characters and ids of the pieces of each text; texts are encoded together, up to a bound."""
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) <= CHUNK_CHARS):
            size += len(texts[stop])
            stop += 1
        if size > CHUNK_CHARS:
            done = [encode_texts([part], ranks_path) for part in safe_parts(texts[begin])]
            yield np.concatenate([e.piece_chars for e in done]), np.concatenate([e.piece_tokens for e in done])
        else:
            e = encode_texts(texts[begin:stop], ranks_path)
            for a, b in zip(e.piece_bounds, e.piece_bounds[1:]):
                yield e.piece_chars[a:b], e.piece_tokens[a:b]
        begin = stop


class _Region:
    """What one edit makes of one document: leaves first .. stop to be encoded anew, with context behind them."""

    def __init__(self, tree: Tree, text: str, begin: int, end: int, new: str):
        self.tree, self.ends = tree, np.cumsum(tree.chars)
        self.shift = len(new) - (end - begin)
        self.text = text[:begin] + new + text[end:]
        self.first = int(np.searchsorted(self.ends, begin, side="right")) if len(tree.chars) else 0
        self.first = min(self.first, len(tree.chars) - 1)
        while self.first and begin - self._start(self.first) < CONTEXT_CHARS:
            self.first -= 1
        self.stop = min(int(np.searchsorted(self.ends, end, side="left")) + 1, len(tree.chars))

    def _start(self, leaf: int) -> int:
        return int(self.ends[leaf - 1]) if leaf else 0

    @property
    def size(self) -> int:
        """Characters of the region in the edited text."""
        return int(self.ends[self.stop - 1]) + self.shift - self._start(self.first)

    def snippet(self) -> str:
        begin = self._start(self.first)
        # enough of what follows to decide on the last boundary; the text's end decides it as well
        return self.text[begin : begin + self.size + CONTEXT_CHARS] if self.stop < len(self.tree.chars) else self.text[begin:]

    def settle(self, chars: np.ndarray, tokens: np.ndarray) -> bool:
        """Take the pieces over, if one begins where the leaf after the region began; else take that leaf in as well."""
        starts = np.append(0, np.cumsum(chars))
        n = int(np.searchsorted(starts, self.size))
        if self.stop < len(self.tree.chars) and (n == len(starts) or starts[n] != self.size):
            self.stop += 1
            return False
        leaves = self.stop - self.first
        cuts = np.arange(leaves + 1) * n // leaves
        self.tree.update(self.first, _runs(chars[:n], cuts), np.diff(cuts), _runs(tokens[:n], cuts))
        return True


def apply_edits(texts: list[str], trees: list[Tree], edits: list[list[tuple[int, int, str]]], ranks_path: str) -> tuple[list[str], np.ndarray]:
    """The edited texts and how many characters were encoded for each; the trees are changed in place.

    The n-th edits of all documents are encoded together.
    """
    texts, encoded = list(texts), np.zeros(len(texts), np.int64)
    for turn in range(max(map(len, edits), default=0)):
        regions: dict[int, _Region] = {}
        for i, own in enumerate(edits):
            if turn < len(own) and own[turn] is not None:
                begin, end, new = own[turn]
                begin = min(max(begin or 0, 0), len(texts[i]))
                regions[i] = _Region(trees[i], texts[i], begin, min(max(end or 0, begin), len(texts[i])), new or "")
        waiting = list(regions)
        while waiting:
            snippets = [regions[i].snippet() for i in waiting]
            later = []
            for i, snippet, (chars, tokens) in zip(waiting, snippets, _encoded(snippets, ranks_path)):
                encoded[i] += len(snippet)
                if not regions[i].settle(chars, tokens):
                    later.append(i)
            waiting = later
        for i, region in regions.items():
            texts[i] = region.text
        grown = [i for i, r in regions.items() if r.tree.pieces[r.first : r.stop].max(initial=0) > MOST_PIECES]
        for i, tree in zip(grown, build_trees([texts[i] for i in grown], ranks_path)):
            encoded[i] += len(texts[i])
            trees[i].chars, trees[i].pieces, trees[i].sums = tree.chars, tree.pieces, tree.sums
    return texts, encoded


_TREE = "leaf_chars array<int>, leaf_pieces array<int>, sums array<long>"
_TREE_NAMES = ["leaf_chars", "leaf_pieces", "sums"]


def _tree_columns(trees: list[Tree]) -> list[pa.Array]:
    return [
        pa.array([t.chars.astype(np.int32) for t in trees], pa.list_(pa.int32())),
        pa.array([t.pieces.astype(np.int32) for t in trees], pa.list_(pa.int32())),
        pa.array([t.sums for t in trees], pa.list_(pa.int64())),
    ]


def count_tokens(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, text, n_tokens and the tree of every row; ``keep`` are further columns to carry along."""
    keep = keep or {}
    source = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[c.alias(n) for n, c in keep.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = list(build_trees(batch.column(1).to_pylist(), ranks_path))
            totals = pa.array([t.total for t in trees], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, totals, *_tree_columns(trees)], [*names, "n_tokens", *_TREE_NAMES])

    names = source.columns
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return map_batches(source, run, f"{carried}, n_tokens long, {_TREE}")


def recount(counted: DataFrame, ranks_path: str, edits_col: str = "edits") -> DataFrame:
    """Rows of ``count_tokens`` with a column of edits (begin, end, replacement): the edited text, its tree and count.

    ``n_tokens_before`` is the old count, ``encoded_chars`` the characters that were encoded for the new one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, pieces, sums = (batch.column(k).to_pylist() for k in (3, 4, 5))
            trees = [Tree(np.array(c, np.int64), np.array(p, np.int64), sums=np.array(s, np.int64)) for c, p, s in zip(chars, pieces, sums)]
            edits = [[e and (e["begin"], e["end"], e["replacement"]) for e in own or []] for own in batch.column(6).to_pylist()]
            texts, encoded = apply_edits(batch.column(1).to_pylist(), trees, edits, ranks_path)
            totals = pa.array([t.total for t in trees], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), batch.column(2), totals, *_tree_columns(trees), pa.array(encoded)], names
            )

    names = ["doc_id", "text", "n_tokens_before", "n_tokens", *_TREE_NAMES, "encoded_chars"]
    source = counted.select("doc_id", "text", "n_tokens", *_TREE_NAMES, F.col(edits_col).cast("array<struct<begin:int,end:int,replacement:string>>"))
    id_type = counted.schema["doc_id"].dataType.simpleString()
    return map_batches(source, run, f"doc_id {id_type}, text string, n_tokens_before long, n_tokens long, {_TREE}, encoded_chars long")
