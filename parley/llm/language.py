"""Language identification as a mixture: which languages a text is made of, and in what proportions.

Each language has a distribution over hashed character n-grams, counted over all training texts. For a text,
expectation-maximisation finds the proportions under which its n-grams are most likely. Then languages are left out,
the weakest first, as long as the penalised likelihood (BIC) does not fall; the rest is the language set. The
prediction is its largest member.

N-grams run over the letters of a text in lower case; a run of anything else is one blank. A null text, or one without
letters, is ``und`` with score 0. Training rows need a language; without any, every text is ``und``. Equal proportions
go to the language that comes first in the alphabet. Repeated rows are predicted each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import map_batches, worker_state

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
SMOOTHING = 0.5
# Steps of expectation-maximisation at most. Proportions move by less than TOLERANCE long before on nearly all texts.
ROUNDS = 200
TOLERANCE = 1e-3
PIECE_CHARS = 1 << 20
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    """Lower case of every letter's code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not (x := chr(c)).isalpha():
            continue
        low = x.lower()
        table[c] = ord(low) if len(low) == 1 else c
    return table


def ngrams(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Buckets of all n-grams of a text, in no set order, and the number of its letters."""
    out, letters = [], 0
    table = worker_state("letters", _letter_table)
    for lo in range(0, len(text), PIECE_CHARS):
        # pieces overlap by the longest n-gram less one
        piece = text[max(0, lo - max(ORDERS) + 1) : lo + PIECE_CHARS]
        code = table[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        letters += int(np.count_nonzero(code[-min(len(piece), len(text) - lo) :]))
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
        code = np.concatenate([[0], code[keep], [0]]).astype(np.uint64)
        mixed = code.copy()
        for n in range(2, max(ORDERS) + 1):
            mixed = mixed[:-1] * np.uint64(1_000_003) + code[n - 1 :]
            if n in ORDERS:
                out.append(((mixed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) >> np.uint64(40)).astype(np.int64) % buckets)
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), letters


def profiles(taught: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """The languages in order and log P(n-gram | language), from training texts (text, lang).

    A task counts into one table per language it meets; the driver gets at most ``buckets`` rows per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, letters = ngrams(text, buckets)
                if letters:
                    counts.setdefault(lang, np.zeros(buckets, np.int64))
                    counts[lang] += np.bincount(found, minlength=buckets)
        for lang, n in counts.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(n[used])], ["lang", "bucket", "n"]
            )

    parts = map_batches(taught, run, "lang string, bucket int, n long")
    total = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(total["lang"].to_pylist()))
    counts = np.full((len(names), buckets), SMOOTHING)
    place = {name: i for i, name in enumerate(names)}
    rows = np.array([place[x] for x in total["lang"].to_pylist()], np.int64)
    np.add.at(counts, (rows, total["bucket"].to_numpy()), total["n"].to_numpy())
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32) if names else np.zeros((buckets, 0), np.float32)


def _likelihood(chances: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> float:
    return float(counts @ np.log(chances @ weights))


def proportions(chances: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by expectation-maximisation, from the n-grams' scaled likelihoods and their counts."""
    weights = np.full(chances.shape[1], 1.0 / chances.shape[1])
    for _ in range(rounds):
        joint = chances * weights
        share = counts @ (joint / joint.sum(axis=1, keepdims=True))
        new = share / share.sum()
        if np.abs(new - weights).max() < TOLERANCE:
            return new
        weights = new
    return weights


def language_set(logs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chosen languages, their proportions) of one text: BIC decides how many stay."""
    chances = np.exp(logs - logs.max(axis=1, keepdims=True)).astype(np.float64)
    chosen = np.arange(logs.shape[1])
    weights = proportions(chances, counts)
    best = _likelihood(chances, counts, weights)
    penalty = 0.5 * np.log(max(counts.sum(), 2.0))
    while len(chosen) > 1:
        # the weakest leaves; of equals the one that comes last
        weakest = len(weights) - 1 - int(np.argmin(weights[::-1]))
        fewer = np.delete(chosen, weakest)
        again = proportions(chances[:, fewer], counts) if len(fewer) > 1 else np.ones(1)
        value = _likelihood(chances[:, fewer], counts, again)
        if value < best - penalty:
            break
        chosen, weights, best = fewer, again, value
    return chosen, weights


def predict(
    df: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, lang_pred, score (its proportion), and ``languages``, the chosen set with proportions.

    ``learn_from`` says by doc_id which rows teach. ``df`` is read twice, so pass a stored table.
    """
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    names, logs = profiles(source.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & learn_from).select("text", "lang"), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, scores, sets = [], [], []
            for text in batch.column(1).to_pylist():
                found, letters = ngrams(text or "", buckets)
                if not letters or not names:
                    best.append(UNKNOWN)
                    scores.append(0.0)
                    sets.append([])
                    continue
                counts = np.bincount(found, minlength=buckets)
                used = np.flatnonzero(counts)
                chosen, weights = language_set(logs[used], counts[used].astype(np.float64))
                top = int(np.argmax(weights))
                best.append(names[chosen[top]])
                scores.append(float(weights[top]))
                sets.append([{"lang": names[c], "share": float(w)} for c, w in zip(chosen, weights)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(
        source.select("doc_id", "text"), run,
        f"doc_id {id_type}, lang_pred string, score double, languages array<struct<lang:string,share:double>>",
    )
