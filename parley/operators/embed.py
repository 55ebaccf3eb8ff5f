"""Text to vector."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default vector length; token separators.
EMBEDDING_DIM = 384
SEPARATORS = r"[^\p{L}\p{N}]+"
# Bytes of text whose tokens are looked at together.
SLICE_BYTES = 1 << 20

Encoder = Callable[[list[str]], np.ndarray]


def list_array(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column, without a Python object per row."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix, dtype=np.float32).ravel()))


def _code(token: str, dim: int) -> int:
    """Signed feature position of a token, 1-based: +p or -p for position p - 1."""
    h = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16)
    return (h % dim + 1) * (1 if h // dim % 2 == 0 else -1)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of some SLICE_BYTES of text, or of one text that is longer."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
        yield texts.slice(begin, end - begin)
        begin = end


def hashed_features(texts: pa.Array, dim: int) -> np.ndarray:
    """Feature-hashed token counts of a batch of texts, scaled to unit length.

    A batch has very many tokens if its texts are long, so it is worked off in parts of bounded size, as each row is on its own.
    """
    return np.concatenate([np.zeros((0, dim)), *[_features(part, dim) for part in _slices(texts)]])


def _features(texts: pa.Array, dim: int) -> np.ndarray:
    """Splitting and finding the different tokens are Arrow kernels; Python sees each different token once."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), SEPARATORS)
    words = lists.flatten().dictionary_encode()
    codes = np.array([_code(t, dim) if t else 0 for t in words.dictionary.to_pylist()], dtype=np.int64)
    code = codes[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.array([], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
    filled = code != 0
    cell = row[filled] * dim + np.abs(code[filled]) - 1
    signs = np.sign(code[filled]).astype(np.float64)
    sums = np.bincount(cell, weights=signs, minlength=len(texts) * dim).astype(np.float64).reshape(len(texts), dim)
    norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)


def _hash_with(dim: int):
    @F.arrow_udf("array<float>")
    def encode(texts: pa.Array) -> pa.Array:
        return list_array(hashed_features(texts, dim))

    return encode


def _encode_with(factory: Callable[[], Encoder], dim: int):
    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for batch in batches:
            texts = batch.to_pylist()
            filled = [i for i, t in enumerate(texts) if t and t.strip()]
            out = np.zeros((len(texts), dim), dtype=np.float32)
            if filled:
                out[filled] = encoder([texts[i] for i in filled])
            yield list_array(out)

    return encode


def embed(
    df: DataFrame,
    text_col: str = "message",
    encoder: Callable[[], Encoder] | None = None,
    dim: int = EMBEDDING_DIM,
    output: str = "embedding",
) -> DataFrame:
    """Add an embedding of ``text_col``; blank and NULL texts become the zero vector.

    ``encoder`` is a factory that a Python worker calls once per task to load a model; it gets texts
    in Arrow batches. By default texts are feature-hashed with a sign and scaled to unit length.
    """
    encode = _encode_with(encoder, dim) if encoder else _hash_with(dim)
    # so that no optimizer rule copies the costly call, as it would for a filter on the result
    return df.withColumn(output, encode.asNondeterministic()(F.col(text_col)))
