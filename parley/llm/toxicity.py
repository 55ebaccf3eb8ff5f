"""Toxicity: boosted trees over a few dense features, with isotonic calibration.

Features of a text: shares of words in a stated and in a learned lexicon, how many of those stand near a word of the
second person, shares of capitals, punctuation and obfuscated words, and sizes. The learned lexicon holds at most
``LEXICON_WORDS`` words that are clearly more frequent in toxic than in other texts, counted over all labelled texts that
may be learned from. Trees and calibration are fitted on at most about ``train_rows`` labelled rows; the trees on two
thirds of them, the calibration on the rest. Each different word of a batch is looked at once.

Nulls and empty texts have features of zero and get a score like any other. Rows whose label is null or neither 0 nor
1 teach nothing; a document with several labels counts with each, and a label given n times weighs n times in trees and
calibration. Of several documents with one id, one trains them. Repeated rows are scored each. Without labels of both
kinds the score is the share of label 1, or 0.5. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import map_batches, maybe_among, texts_of, worker_state
from parley.llm.quality import sampled_labels, taught_rows, usable_labels
from parley.session import materialize

TRAIN_ROWS = 20_000
LEXICON_WORDS = 400
LEAST_TEXTS = 5
LEAST_SURPLUS = 3.0
NEAR_WORDS = 5
CACHED_WORDS = 200_000
TREES, DEPTH, RATE = 30, 4, 0.2

# A short list of insults, and words of the second person, in the languages at hand.
INSULTS = """idiot idiots stupid moron morons dumb fool loser losers pathetic worthless disgusting scum trash garbage clown
jerk crap hate ugly filth filthy vermin imbecile cretin dimwit useless bastard shut idiota estúpido imbécil basura inútil
asqueroso tonto payaso idiote stupide imbécile crétin ordure débile nul salaud minable dummkopf idioten blöd trottel
abschaum müll wertlos widerlich erbärmlich arschloch depp""".split()
SECOND_PERSON = """you your yours yourself yourselves u ur tu te ti usted ustedes vosotros vos tus toi vous votre vos tes ton
du dich dir dein deine deinen ihr euch euer""".split()

_LETTERS = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"[^\W_][*@#$!|0134579+._-]+[^\W_]")
_PLAIN = str.maketrans("013457@$!|", "oieastasil")
# Bits of a word's flags.
STATED, LEARNED, SECOND, SHOUTED, HIDDEN, DECODED = (1 << i for i in range(6))
FEATURES = (
    "stated learned hits near second shouted hidden decoded capitals punctuation exclamations digits words length "
    "densest"
).split()


def word_flags(word: str, stated: frozenset[str], learned: frozenset[str]) -> int:
    """What a word is: in a lexicon, of the second person, all capitals, obfuscated, in a lexicon once decoded."""
    found = _LETTERS.findall(word)
    letters = max(found, key=len).lower() if found else ""
    flags = STATED * (letters in stated) | LEARNED * (letters in learned) | SECOND * (letters in _SECOND)
    if len(letters) > 2 and letters.upper() in word:
        flags |= SHOUTED
    if _HIDDEN.search(word):
        flags |= HIDDEN
        plain = "".join(c for c in word.lower().translate(_PLAIN) if c.isalpha())
        if plain != letters and (plain in stated or plain in learned):
            flags |= DECODED
    return flags


_SECOND = frozenset(SECOND_PERSON)


def _flag_cache(learned: tuple[str, ...]) -> dict[str, int]:
    """Flags of words seen so far; begins anew with another lexicon, or when it holds CACHED_WORDS."""
    state = worker_state("toxicity", dict)
    if state.get("lexicon") != learned or len(state["flags"]) > CACHED_WORDS:
        state["lexicon"], state["flags"] = learned, {}
    return state["flags"]


def dense_features(texts: pa.Array, learned: tuple[str, ...]) -> np.ndarray:
    """One row of FEATURES per text."""
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    words = lists.flatten().dictionary_encode()
    different = words.dictionary.to_pylist()
    cache, stated, own = _flag_cache(learned), frozenset(INSULTS), frozenset(learned)
    for w in different:
        if w not in cache:
            cache[w] = word_flags(w, stated, own)
    index = words.indices.to_numpy(zero_copy_only=False)
    flags = np.fromiter(map(cache.__getitem__, different), np.int64, len(different))[index]
    lengths = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False)[index]
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    n, bounds = len(texts), np.append(0, np.cumsum(sizes))
    text = np.repeat(np.arange(n), sizes)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(text[mask], minlength=n) / np.maximum(sizes, 1)

    hit = flags & (STATED | LEARNED | DECODED) != 0
    hits, seconds = np.flatnonzero(hit), np.flatnonzero(flags & SECOND)
    # a hit is near if a word of the second person of the same text is at most NEAR_WORDS away
    near = np.zeros(len(hits), bool)
    if len(seconds):
        for side in (np.searchsorted(seconds, hits), np.searchsorted(seconds, hits) - 1):
            other = seconds[np.clip(side, 0, len(seconds) - 1)]
            near |= (np.abs(other - hits) <= NEAR_WORDS) & (text[other] == text[hits])
    # hits in the densest stretch of 50 words, so that a long text does not hide a short passage
    stretch, counts = np.unique(text[hits] << 32 | (hits - bounds[text[hits]]) // 50, return_counts=True)
    densest = np.zeros(n)
    np.maximum.at(densest, stretch >> 32, counts)
    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)

    def counted(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False) / chars

    return np.column_stack(
        [
            share(flags & STATED != 0), share(flags & LEARNED != 0), np.log1p(np.bincount(text[hits], minlength=n)),
            np.bincount(text[hits[near]], minlength=n) / np.maximum(sizes, 1), share(flags & SECOND != 0),
            share(flags & SHOUTED != 0), share(flags & HIDDEN != 0), share(flags & DECODED != 0), counted(r"\p{Lu}"),
            counted(r"[!-/:-@\[-`{-~]"), counted("!"), counted("[0-9]"), np.log1p(sizes),
            np.bincount(text, weights=lengths, minlength=n) / np.maximum(sizes, 1), densest,
        ]
    ).astype(np.float64)


def features(docs: DataFrame, learned: tuple[str, ...]) -> DataFrame:
    """doc_id and ``features`` of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense_features(batch.column(1), learned)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "features"])

    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, features array<double>")


def learned_lexicon(docs: DataFrame, usable: DataFrame, words: int = LEXICON_WORDS) -> tuple[str, ...]:
    """The words most typical of label 1, counted in all documents (doc_id, text) that have a label in ``usable``.

    They are ranked by how surely the log odds of the texts that hold a word differ from 0. Documents with one id count
    each; a label that is given several times counts once.
    """
    # of the texts that have no label only a few move
    listed = maybe_among(docs, usable, "doc_id").join(usable.select("doc_id", "label"), "doc_id")
    kinds = {r["label"]: r["n"] for r in listed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = kinds.get(1, 0), kinds.get(0, 0)
    listed = listed.select("label", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    counts = listed.filter("word <> ''").groupBy("word").agg(F.sum("label").alias("a"), F.count("*").alias("n"))
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    odds = F.log(a / (toxic + 1 - a)) - F.log(b / (other + 1 - b))
    typical = counts.filter(F.col("a") >= LEAST_TEXTS).withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / a + 1 / b))
    typical = typical.filter((F.col("z") >= LEAST_SURPLUS) & (F.col("odds") >= 1)).orderBy(F.desc("z"), "word").limit(words)
    return tuple(r["word"] for r in typical.select("word").collect())


class Calibration:
    """Isotonic: the increasing step function nearest to the labels, by pooling adjacent violators."""

    def __init__(self, scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None):
        order = np.argsort(scores, kind="stable")
        at, first = np.unique(scores[order], return_index=True)
        heavy = np.ones(len(order)) if weights is None else weights[order].astype(float)
        weights = np.add.reduceat(heavy, first) if len(first) else np.zeros(0)
        means = np.add.reduceat(labels[order] * heavy, first) / weights if len(first) else np.zeros(0)
        pools: list[list[float]] = []
        for mean, weight, count in zip(means, weights, np.ones(len(means), int)):
            pools.append([mean, weight, count])
            while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
                m, w, c = pools.pop()
                p = pools[-1]
                pools[-1] = [(p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, p[2] + c]
        self.at = at
        self.value = np.repeat([p[0] for p in pools], [int(p[2]) for p in pools]) if pools else np.zeros(0)

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        """Between two known scores the value is interpolated, outside it is that of the nearest."""
        return np.clip(np.interp(scores, self.at, self.value), 0.0, 1.0)


def train_and_score(
    df: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """doc_id, score and predicted of every row of ``df``; ``learn_from`` says by doc_id which labels may be used.

    ``df`` is read three times, so pass a stored table. Labels that are no small table make the labelled texts move
    once, for the lexicon.
    """
    docs = texts_of(df, id_col, text_col)
    chosen = sampled_labels(labels, train_rows, id_col, label_col, learn_from)
    # some train_rows short rows, see sampled_labels
    texts = materialize(taught_rows(docs, chosen, "text"), "taught")
    learned = learned_lexicon(docs, usable_labels(labels, id_col, label_col, learn_from))
    taught = materialize(
        features(texts.select(F.struct("doc_id", "label", "n").alias("doc_id"), "text"), learned).select(
            F.col("doc_id.label").cast("double").alias("label"), F.col("doc_id.n").cast("double").alias("n"),
            (F.pmod(F.xxhash64(F.col("doc_id.doc_id"), F.lit("calibration")), F.lit(3)) == 0).alias("aside"),
            array_to_vector("features").alias("features"),
        ),
        "toxic_features",
    )
    kinds = {bool(r["aside"]): (r["n"], r["p"] or 0) for r in taught.groupBy("aside").agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()}
    rows, positive = map(sum, zip(*kinds.values())) if kinds else (0, 0)
    every = features(docs, learned)
    fit_n, fit_p = kinds.get(False, (0, 0))
    if not 0 < fit_p < fit_n:
        score = F.lit(float(positive / rows) if rows else 0.5)
        return every.select("doc_id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, minInstancesPerNode=5, seed=3, labelCol="label", weightCol="n")
    model = trees.fit(taught.filter(~F.col("aside")).coalesce(6))
    shown = _raw_scores(model, taught.filter(F.col("aside")).select("label", "n", "features")).toArrow()
    if shown.num_rows < 20:
        shown = _raw_scores(model, taught.select("label", "n", "features")).toArrow()
    calibrated = Calibration(shown["raw"].to_numpy(), shown["label"].to_numpy(), shown["n"].to_numpy())

    @F.arrow_udf("double")
    def probability(raw: pa.Array) -> pa.Array:
        margin = raw.to_numpy(zero_copy_only=False)
        # the calibration has steps; a hundredth of the score still tells margins apart within one
        return pa.array(0.99 * calibrated(margin) + 0.01 / (1.0 + np.exp(-2.0 * margin)))

    scored = _raw_scores(model, every.select("doc_id", array_to_vector("features").alias("features")))
    scored = scored.select("doc_id", probability.asNondeterministic()("raw").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _raw_scores(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    """The margin of label 1 as ``raw``, beside the other columns."""
    others = [c for c in df.columns if c != "features"]
    return model.transform(df).select(*others, vector_to_array("rawPrediction")[1].alias("raw"))
