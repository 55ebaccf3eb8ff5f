"""Quality scores: random-indexing word vectors pooled per document, and a small network on them.

Words become features: the letters of a word, the signs around it, and its shape. Every feature has a bucket by hash,
every bucket a sparse random index vector. The context vector of a bucket is the sum of the index vectors around all its
occurrences, over all documents; the word vector is both, side by side. A document is the mean of its features' vectors.
The network (one hidden layer, then the output) is trained in numpy on at most about ``train_rows`` labelled rows, and
its probabilities are calibrated by a temperature fitted on rows that it was not trained on.

Per task the sums are one table of buckets, so neither memory nor the rows that are shuffled depend on the vocabulary.
The driver sees that table and the training vectors, both of bounded size.

Nulls and empty texts have the zero vector and get a score like any other. Labels of 0 and 1 are learned from; null
labels and unlabelled rows are not. A document with several labels counts with each, and a label that is given n times
weighs n times. Of several documents with one id, one is learned from, see taught_rows. Repeated rows are scored each.
Without any label of both kinds the score is the share of label 1, or 0.5. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import PieceCache, group_sums, map_batches, piece_cache, take_ragged, texts_of
from parley.session import materialize

BUCKETS = 1 << 13
DIM = 64
NONZERO = 6
WINDOW = 2
EXTRA = 3
CONTEXT_STEP = 50_000
SLICE = 100_000
TRAIN_ROWS = 20_000
HIDDEN = 32
CACHED_WORDS = 500_000


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, nonzero: int = NONZERO, seed: int = 11) -> np.ndarray:
    """Ternary vectors with ``nonzero`` places of +1 or -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((buckets, dim), np.float32)
    places = np.argsort(rng.random((buckets, dim)), axis=1)[:, :nonzero]
    np.put_along_axis(out, places, rng.choice([-1.0, 1.0], (buckets, nonzero)).astype(np.float32), axis=1)
    return out


_CORE = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def word_features(word: str) -> list[str]:
    """Letters in lower case, the signs without them, and the shape: case, digits, length class."""
    core = _CORE.search(word)
    if core is None:
        return ["sign:" + word]
    letters = core.group()
    case = "upper" if len(letters) > 1 and letters.isupper() else "title" if letters[0].isupper() else "lower"
    if letters.isalpha():
        kind = case
    else:
        kind = "digit" if letters.isdigit() else "mixed" if any(c.isdigit() for c in letters) else case
    out = ["word:" + letters.lower(), f"shape:{kind}:{min(len(letters) // 4, 4)}"]
    if len(letters) < len(word):
        out.append("sign:" + word[: core.start()] + word[core.end() :])
    return out


def _bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def _features_of(buckets: int) -> PieceCache:
    few: dict[str, int] = {}

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, lengths = array("I"), array("q")
        for word in words:
            first, *others = word_features(word)
            out.append(_bucket(first, buckets))
            for feature in others:
                # shapes are some thirty, and most signs come again and again
                if (known := few.get(feature)) is None:
                    known = _bucket(feature, buckets)
                    if len(few) < 10_000:
                        few[feature] = known
                out.append(known)
            lengths.append(1 + len(others))
        return np.array(out, np.int64), np.array(lengths, np.int64)

    return piece_cache(f"quality:{buckets}", lambda: PieceCache(encode, CACHED_WORDS))


def feature_runs(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features in text order, and the bounds of each text."""
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    words = lists.flatten().dictionary_encode()
    flat, starts, lengths = _features_of(buckets).lookup(words.dictionary.to_pylist())
    index = words.indices.to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    counts = group_sums(lengths[index], np.append(0, np.cumsum(sizes)))
    return take_ragged(flat, starts[index], lengths[index]).astype(np.int64), np.append(0, np.cumsum(counts))


def _slices(bounds: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with some ``most`` features; a longer text comes alone."""
    begin = 0
    for i in range(1, len(bounds)):
        if i == len(bounds) - 1 or bounds[i + 1] - bounds[begin] > most:
            yield begin, i
            begin = i


def feature_table(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id and ``features``, the buckets of a text's features in order. Made once, read by all later steps."""
    if buckets > 1 << 15:
        raise ValueError("buckets are stored as short integers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bounds = feature_runs(batch.column(1), buckets)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int16)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "features"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, features array<short>"
    return materialize(map_batches(docs, run, schema), "features")


def _runs_of(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The feature runs of a batch, from texts or from a stored table of features."""
    if not pa.types.is_list(column.type):
        return feature_runs(column, buckets)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes))


def context_vectors(docs: DataFrame, buckets: int = BUCKETS, dim: int = DIM, window: int = WINDOW, nonzero: int = NONZERO) -> np.ndarray:
    """Sums of the index vectors around each bucket's occurrences, over all documents (doc_id, and text or features)."""
    # one more vector, of zeros, for the gap between two texts
    around = np.vstack([index_vectors(buckets, dim, nonzero), np.zeros((1, dim))]).astype(np.int8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((buckets + 1, dim), np.int64)
        for batch in batches:
            ids, bounds = _runs_of(batch.column(1), buckets)
            ids = np.insert(ids, np.repeat(bounds, window), buckets)
            for lo in range(window, len(ids) - window, CONTEXT_STEP):
                # with a margin on both sides, so that the cut changes nothing
                hi = min(len(ids) - window, lo + CONTEXT_STEP)
                vectors = around[ids[lo - window : hi + window]]
                near = np.zeros((hi - lo, dim), np.int8)
                for gap in range(1, window + 1):
                    near += vectors[window - gap : window - gap + hi - lo]
                    near += vectors[window + gap : window + gap + hi - lo]
                part = ids[lo:hi]
                order = np.argsort(part, kind="stable")
                first = np.flatnonzero(np.diff(part[order], prepend=-1))
                sums[part[order][first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int64)
        sums = sums[:-1]
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        columns = [pa.array(used.astype(np.int32)), *[pa.array(sums[used, k].astype(np.float64)) for k in range(dim)]]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = ["bucket", *[f"v{k}" for k in range(dim)]]
    parts = map_batches(docs, run, "bucket int, " + ", ".join(f"{n} double" for n in names[1:]))
    total = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names[1:]])
    out = np.zeros((buckets, dim), np.float32)
    # at most one row per bucket
    for row in total.toLocalIterator():
        out[row[0]] = row[1:]
    return out


def word_vectors(contexts: np.ndarray, nonzero: int = NONZERO) -> np.ndarray:
    """Context and index vectors side by side, each of length 1."""
    norm = np.linalg.norm(contexts, axis=1, keepdims=True)
    own = index_vectors(*contexts.shape, nonzero)
    return np.hstack([contexts / np.maximum(norm, 1e-9), own / np.sqrt(nonzero)]).astype(np.float32)


def pooled_vectors(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text or feature run: the mean of its features' vectors, the share of different features, the log of their number, and the
    share of features that come again one to three places later."""
    buckets, dim = vectors.shape
    ids, bounds = _runs_of(texts, buckets)
    out = np.zeros((len(texts), dim + EXTRA), np.float32)
    for a, b in _slices(bounds):
        part = ids[bounds[a] : bounds[b]]
        sizes = np.diff(bounds[a : b + 1])
        text = np.repeat(np.arange(b - a), sizes)
        # each different feature of a text once, with its count
        pairs, n = np.unique(text * buckets + part, return_counts=True)
        owner = pairs // buckets
        weighted = vectors[pairs % buckets] * n[:, None]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(first):
            out[a + owner[first], :dim] = np.add.reduceat(weighted, first, axis=0)
        again = np.zeros(len(part), bool)
        for gap in (1, 2, 3):
            again[gap:] |= (part[gap:] == part[:-gap]) & (text[gap:] == text[:-gap])
        out[a:b, dim] = np.bincount(owner, minlength=b - a)
        out[a:b, dim + 2] = np.bincount(text[again], minlength=b - a)
        out[a:b] /= np.maximum(sizes, 1)[:, None]
        out[a:b, dim + 1] = np.log1p(sizes)
    return out


def pool(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """doc_id and ``pooled``, see pooled_vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pooled_vectors(batch.column(1), vectors)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), out.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "pooled"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, pooled array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Network:
    """Inputs, one hidden layer of tanh units, one output; a temperature divides the output before the logistic function."""

    def __init__(self, dim: int, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(dim), np.ones(dim)
        self.w = [rng.normal(0, dim**-0.5, (dim, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.temperature, self.constant = 1.0, None
        self.rng = rng

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.w
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x) / self.temperature)

    def fit(
        self, x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, epochs: int = 40, batch: int = 256,
        rate: float = 3e-3, decay: float = 1e-3,
    ) -> Network:
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        weights = np.ones(len(y)) if weights is None else weights / weights.mean()
        order = self.rng.permutation(len(y))
        kept, aside = (order[len(y) // 6 :], order[: len(y) // 6]) if len(y) >= 60 else (order, order)
        self.mean, self.scale = x[kept].mean(axis=0), x[kept].std(axis=0) + 1e-6
        z, t, heavy = (x[kept] - self.mean) / self.scale, y[kept], weights[kept]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.w]
        best, step = (np.inf, [w.copy() for w in self.w]), 0
        for _ in range(epochs):
            shuffled = self.rng.permutation(len(t))
            for lo in range(0, len(t), batch):
                rows = shuffled[lo : lo + batch]
                w1, b1, w2, b2 = self.w
                h = np.tanh(z[rows] @ w1 + b1)
                error = (_sigmoid(h @ w2 + b2[0]) - t[rows]) * heavy[rows] / len(rows)
                back = error[:, None] * w2 * (1 - h * h)
                grads = [z[rows].T @ back + decay * w1, back.sum(axis=0), h.T @ error + decay * w2, error.sum(keepdims=True)]
                step += 1
                for w, g, (m, v) in zip(self.w, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            loss = self._loss(self.logits(x[aside]), y[aside], weights[aside])
            if loss < best[0]:
                best = loss, [w.copy() for w in self.w]
        self.w = best[1]
        raw = self.logits(x[aside])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        self.temperature = float(min(grid, key=lambda t: self._loss(raw / t, y[aside], weights[aside])))
        return self

    @staticmethod
    def _loss(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
        return float(np.average(np.logaddexp(0, logits) - y * logits, weights=weights))


def usable_labels(labels: DataFrame, id_col: str, label_col: str, learn_from: Column) -> DataFrame:
    """(doc_id, label, n) of the labels to learn from; equal rows are one, n times."""
    usable = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from)
    return usable.groupBy("doc_id", "label").agg(F.count("*").alias("n"))


def sampled_labels(labels: DataFrame, train_rows: int, id_col: str, label_col: str, learn_from: Column) -> DataFrame:
    """Rows of usable_labels, some ``train_rows`` at most, chosen by a hash of the id."""
    usable = materialize(usable_labels(labels, id_col, label_col, learn_from), "usable_labels")
    share = min(1.0, train_rows / max(usable.count(), 1))
    return usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def taught_rows(docs: DataFrame, chosen: DataFrame, value: str) -> DataFrame:
    """(doc_id, label, n, ``value``): one row for each of ``chosen`` that has a document.

    Of several documents with one id, the one whose value has the smallest hash is learned from, so there are never more
    rows than chosen labels.
    """
    joined = docs.join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id", "label").agg(F.max("n").alias("n"), F.min_by(value, F.xxhash64(value)).alias(value))


def fit(pooled: DataFrame, chosen: DataFrame, dim: int) -> Network:
    """The network, trained on the pooled vectors of the labelled rows in ``chosen``, see sampled_labels."""
    taught = taught_rows(pooled, chosen, "pooled").select("pooled", "label", "n", "doc_id").toArrow()
    # the order of rows that Spark returns is not fixed
    taught = taught.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    y = taught["label"].to_numpy().astype(np.float64)
    x = taught["pooled"].combine_chunks().flatten().to_numpy().reshape(len(y), dim).astype(np.float64)
    return Network(dim).fit(x, y, taught["n"].to_numpy().astype(np.float64))


def train_and_score(
    df: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """doc_id, score and predicted of every row of ``df``; ``learn_from`` says by doc_id which labels may be used.

    ``df`` is read once; its features are stored, some 1.5 bytes each.
    """
    docs = feature_table(texts_of(df, id_col, text_col))
    vectors = word_vectors(context_vectors(docs))
    network = _taught_network(docs, vectors, sampled_labels(labels, train_rows, id_col, label_col, learn_from))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = network.probability(pooled_vectors(batch.column(1), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def _taught_network(docs: DataFrame, vectors: np.ndarray, chosen: DataFrame) -> Network:
    """The network, fitted on the documents that ``chosen`` has labels of; only those are pooled here."""
    taught = docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    return fit(pool(taught, vectors), chosen, vectors.shape[1] + EXTRA)


def drop_poor(
    df: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The rows of ``df``, with all columns, whose score is 0.5 or more. Nothing but sums and training rows is shuffled."""
    docs = texts_of(df, id_col, text_col)
    vectors = word_vectors(context_vectors(docs))
    network = _taught_network(docs, vectors, sampled_labels(labels, train_rows, id_col, label_col, learn_from))
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled_vectors(batch.column(place).fill_null(""), vectors).astype(np.float64)
            yield batch.filter(pa.array(network.probability(x) >= 0.5))

    return df.mapInArrow(run, df.schema)
