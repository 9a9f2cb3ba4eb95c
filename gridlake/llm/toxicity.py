"""Toxicity: bags of subwords as embeddings, averaged into a linear softmax.

A word is the bag of its character n-grams, hashed into buckets; its vector is their mean, so an unseen
misspelling shares most of its vector with the word it stands for.  A stretch of a few words is the mean of its words,
and a softmax layer scores it.  Embeddings and layer are trained together, in numpy, on a bounded sample of labelled
rows: first every stretch carries the label of its document, then only the most toxic stretches of each.  The score of
a document is calibrated from its highest stretches.

Edge cases: a null text is an empty one; texts without letters get the score of no evidence; equal texts get equal
scores; repeated rows are scored as often as they occur; an empty table gives no rows; without usable labels every score
is 0; all columns of the documents are kept, and a clashing name is replaced by the score.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches
from gridlake.llm.labels import fit_labelled, fit_logistic, remainder

FOLDS, HELD_OUT = 3, 1
REJECT = 0.7
#: Labelled rows of either class that are used at most.
PER_CLASS = 2000
BUCKETS, DIMS, SIZES, STRETCH, SEED = 1 << 18, 8, (3, 4, 5, 6), 3, 11
WORD = re.compile(r"[^\W\d_]+")
#: Words remembered with their scores; beyond it the memory starts anew, which changes the time only.
KNOWN_WORDS = 300_000
#: Words whose n-grams are taken at once, which bounds memory.
WORDS_AT_ONCE = 20_000
#: Longer words are cut into parts, so that one endless word is not one mean.
LONGEST = 40
NO_EVIDENCE = -20.0


def words_of(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    if any(len(w) > LONGEST for w in found):
        found = [w[i:i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bucket of every n-gram of every word, ends marked."""
    lengths = np.array([len(w) + 2 for w in words])
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the end of the word
    owners, buckets, rolled = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        rolled = rolled * np.uint64(0x100000001B3)
        rolled[:len(codes) - n + 1] += codes[n - 1:]
        if n in SIZES:
            fits = left >= n
            mixed = rolled[fits] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            owners.append(owner[fits])
            buckets.append(((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(7)) % np.uint64(BUCKETS))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int32)


@dataclass
class Model:
    """What is left of embeddings and layer for scoring: a value per bucket, a bias, and the calibration."""

    values: np.ndarray
    bias: float
    calibration: tuple[float, float, float]

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at:at + WORDS_AT_ONCE]
            owner, bucket = subwords(part)
            counts = np.bincount(owner, minlength=len(part))
            out.append(np.bincount(owner, self.values[bucket], minlength=len(part)) / np.maximum(counts, 1))
        return np.concatenate(out)

    def score(self, stretches: np.ndarray) -> float:
        """Calibrated score of a document from the logits of its stretches."""
        a, b, c = self.calibration
        first, second = evidence(stretches)
        return float(1 / (1 + np.exp(-np.clip(a * first + b * second + c, -30, 30))))


def stretch_means(scores: np.ndarray) -> np.ndarray:
    """Means over every `STRETCH` neighbouring words; a shorter text is one stretch."""
    if len(scores) <= STRETCH:
        return scores.mean(keepdims=True) if len(scores) else scores
    sums = np.cumsum(np.concatenate([[0.0], scores]))
    return (sums[STRETCH:] - sums[:-STRETCH]) / STRETCH


def evidence(logits: np.ndarray) -> tuple[float, float]:
    """The highest logit, and the highest one of a stretch that shares no word with it."""
    if not len(logits):
        return NO_EVIDENCE, NO_EVIDENCE
    at = int(logits.argmax())
    apart = np.concatenate([logits[:max(0, at - STRETCH + 1)], logits[at + STRETCH:]])
    return float(logits[at]), float(apart.max()) if len(apart) else float(logits.min())


class _Net:
    """Embeddings and softmax layer, trained by AdaGrad on stretches of words."""

    def __init__(self, words: list[str]):
        self.rng = np.random.default_rng(SEED)
        buckets, counts = [], []
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at:at + WORDS_AT_ONCE]
            owner, bucket = subwords(part)
            buckets.append(bucket[np.argsort(owner, kind="stable")])
            counts.append(np.bincount(owner, minlength=len(part)))
        self.bucket = np.concatenate(buckets)
        self.start = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        self.table = (self.rng.standard_normal((BUCKETS, DIMS)) * 0.05).astype("float32")
        self.layer = (self.rng.standard_normal((DIMS, 2)) * 0.5).astype("float32")
        self.bias = np.zeros(2, "float32")
        self.seen = np.full((BUCKETS, DIMS), 1e-6, "float32")
        self.seen_layer = np.full((DIMS, 2), 1e-6, "float32")

    def fit(self, stretches: np.ndarray, labels: np.ndarray, rounds: int, steps: int, rate: float = 0.1,
            size: int = 512) -> None:
        """So many rounds over the stretches, or more, until there were so many steps."""
        rounds = max(rounds, -(-steps * size // len(labels)))
        weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        for _ in range(rounds):
            for part in np.array_split(self.rng.permutation(len(labels)), max(1, len(labels) // size)):
                self._step(stretches[part], labels[part], weight[part].astype("float32"), rate)

    def _step(self, stretches, labels, weight, rate) -> None:
        words, place = np.unique(stretches, return_inverse=True)
        place = place.reshape(stretches.shape)
        counts = self.start[words + 1] - self.start[words]
        first = np.cumsum(counts) - counts
        grams = self.bucket[np.arange(counts.sum()) + np.repeat(self.start[words] - first, counts)]
        vectors = np.add.reduceat(self.table[grams], first) / counts[:, None]
        means = vectors[place].mean(axis=1)
        logits = means @ self.layer + self.bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(labels)), labels] -= 1
        slope = chance * weight[:, None] / len(labels)
        to_layer, to_means = means.T @ slope, slope @ self.layer.T
        to_words = np.zeros_like(vectors)
        np.add.at(to_words, place.ravel(), np.repeat(to_means / stretches.shape[1], stretches.shape[1], axis=0))
        used, back = np.unique(grams, return_inverse=True)
        to_grams = np.zeros((len(used), DIMS), "float32")
        np.add.at(to_grams, back, np.repeat(to_words / counts[:, None], counts, axis=0))
        self.seen[used] += to_grams ** 2
        self.table[used] -= rate * to_grams / np.sqrt(self.seen[used])
        self.seen_layer += to_layer ** 2
        self.layer -= rate * to_layer / np.sqrt(self.seen_layer)
        self.bias -= rate * 0.1 * slope.sum(axis=0)

    def values(self) -> tuple[np.ndarray, float]:
        difference = self.layer[:, 1] - self.layer[:, 0]
        return (self.table @ difference).astype("float32"), float(self.bias[1] - self.bias[0])


def train(sample: list[tuple[str, int]]) -> Model | None:
    """A model from texts and labels; None if either label is missing."""
    bags = [(words_of(t), y) for t, y in sample]
    bags = [(w, y) for w, y in bags if w]
    if len({y for _, y in bags}) < 2:
        return None
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in bag]) for bag, _ in bags]
    labels = np.array([y for _, y in bags])
    parts = np.arange(len(docs)) % 5  # every fifth document calibrates
    net = _Net(list(known))

    def cut(doc):
        doc = np.resize(doc, max(len(doc), STRETCH)) if len(doc) < STRETCH else doc
        return np.lib.stride_tricks.sliding_window_view(doc, STRETCH)

    views = [cut(d) for d in docs]
    fitted = [i for i in range(len(docs)) if parts[i] != 4 or len(docs) < 50]
    every = [net.rng.permutation(views[i])[:60] for i in fitted]  # of a document's stretches, for the first round
    net.fit(np.concatenate(every), np.repeat(labels[fitted], [len(v) for v in every]), rounds=1, steps=300)
    for _ in range(4):
        values, bias = net.values()
        scores = Model(values, bias, (0, 0, 0)).word_scores(list(known))
        chosen, truth = [], []
        for i in fitted:
            logits = scores[views[i]].mean(axis=1)
            top = np.argsort(-logits)[:2 if labels[i] else 6]
            more = net.rng.integers(0, len(views[i]), 0 if labels[i] else 4)
            chosen.append(views[i][np.concatenate([top, more])])
            truth += [labels[i]] * len(chosen[-1])
        net.fit(np.concatenate(chosen), np.array(truth), rounds=3, steps=80)
    values, bias = net.values()
    scores = Model(values, bias, (0, 0, 0)).word_scores(list(known))
    held = [i for i in range(len(docs)) if i not in set(fitted)] or fitted
    features = np.array([evidence(stretch_means(scores[docs[i]]) + bias) for i in held])
    if len(set(labels[held])) < 2:
        features, held = np.array([evidence(stretch_means(scores[d]) + bias) for d in docs]), range(len(docs))
    return Model(values, bias, tuple(fit_logistic(features, labels[list(held)])))


def score_column(model: Model | None, text: Column) -> Column:
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for batch in batches:
            bags = [words_of(t) for t in batch]
            new = list(set().union(*bags).difference(known))
            if len(known) + len(new) > KNOWN_WORDS:
                known.clear()
                new = list(set().union(*bags))
            known.update(zip(new, model.word_scores(new).tolist()))
            yield pd.Series([
                model.score(stretch_means(np.array(list(map(known.__getitem__, bag)))) + model.bias) for bag in bags])

    return score(text)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    return fit_labelled(docs, labels, "toxic", FOLDS, HELD_OUT, per_class, train)


def with_toxicity(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The documents with a column of scores between 0 and 1."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, score_column(model, F.col("text")))


def op3_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    scored = with_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"))
