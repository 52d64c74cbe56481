"""Quality classifier on supervised subword embeddings.

A document is the mean of learned vectors: one for each word and one for each of
the word's character n-grams (UTF-8 bytes, with word ends), all found by hashing
into one table. A softmax layer turns the mean into class odds. Vectors and layer
are trained together by stochastic gradient descent in numpy, on a bounded sample
of labelled documents with whole texts.

Scoring needs only each vector's product with the layer. A word's products are the
same wherever it occurs, so workers keep them in a bounded cache.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import fit_in_task, held_out, labelled_sample, set_aside, table, with_fields

# Labelled documents of each class that the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 1_200
BUCKETS = 1 << 16
DIM = 8
NGRAMS = (3, 4)
EPOCHS = 6
# A small sample is gone through more often.
MIN_STEPS = 600
BATCH = 24
# A vector gets a share of a document's gradient only, so it takes larger steps.
VECTOR_RATE = 100.0
# Words whose features are worked out at once.
PIECE = 4096
# Words whose products a worker keeps; it starts anew when full.
CACHE_WORDS = 400_000


def word_features(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after the other, and how many each has."""
    if not words:
        return np.empty(0, "int64"), np.empty(0, "int64")
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), "int64", len(marked))
    data = np.frombuffer(b"".join(marked), "uint8").astype("uint64")
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def finish(h: np.ndarray, salt: int) -> np.ndarray:
        h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return ((h >> np.uint64(32)) % np.uint64(buckets)).astype("int64")

    # A whole word: its bytes weighted by powers of an odd number.
    place = np.arange(len(data)) - starts[owner]
    powers = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, "uint64"))
    found = [finish(np.add.reduceat((data + np.uint64(1)) * powers[place], starts), 1)]
    owners = [np.arange(len(words))]
    for n in NGRAMS:
        if len(data) < n:
            continue
        h = np.zeros(len(data) - n + 1, "uint64")
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + data[k : len(data) - n + 1 + k] + np.uint64(1)
        inside = owner[: len(h)] == owner[n - 1 :]
        found.append(finish(h[inside], n * 7919))
        owners.append(owner[: len(h)][inside])
    owners_ = np.concatenate(owners)
    order = np.argsort(owners_, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners_, minlength=len(words))


def features_in_pieces(
    words: list[bytes], buckets: int = BUCKETS, piece: int = PIECE
) -> tuple[np.ndarray, np.ndarray]:
    """``word_features``, with working memory for ``piece`` words only."""
    parts = [
        word_features(words[start : start + piece], buckets)
        for start in range(0, max(len(words), 1), piece)
    ]
    features = np.concatenate([part.astype("int32") for part, _ in parts])
    return features, np.concatenate([counts for _, counts in parts])


@dataclass
class Model:
    """``products[f]`` is feature f's vector times the layer, for each class."""

    products: np.ndarray
    bias: np.ndarray

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """For each word the summed products of its features, and their number."""
        features, counts = word_features(words, len(self.products))
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("int64")
        sums = np.add.reduceat(self.products[features], starts, axis=0)
        return np.column_stack([sums, counts])


class Scorer:
    """Scores texts with one model, keeping the sums of words seen before."""

    def __init__(self, model: Model, cache_words: int = CACHE_WORDS):
        self.model, self.cache_words = model, cache_words
        self.places: dict[bytes, int] = {}
        self.sums = np.empty((1024, len(model.bias) + 1))

    def _learn(self, words: list[bytes]) -> None:
        if len(self.places) + len(words) > self.cache_words:
            self.places.clear()
        first = len(self.places)
        while len(self.sums) < first + len(words):
            self.sums = np.concatenate([self.sums, np.empty_like(self.sums)])
        for start in range(0, len(words), PIECE):
            piece = words[start : start + PIECE]
            at = first + start
            self.sums[at : at + len(piece)] = self.model.word_sums(piece)
        self.places.update(zip(words, range(first, first + len(words)), strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1; without words the layer's bias decides."""
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = (text or "").encode().split()
            new = list({w for w in words if w not in self.places})
            if new:
                self._learn(new)
                if len(new) < len(words) and any(w not in self.places for w in words):
                    self._learn(list({w for w in words if w not in self.places}))
            total = np.zeros(self.sums.shape[1])
            if words:
                at = np.fromiter(map(self.places.__getitem__, words), "int64", len(words))
                total = self.sums[at].sum(axis=0)
            odds = self.model.bias + total[:-1] / max(total[-1], 1.0)
            odds = np.exp(odds - odds.max())
            out[i] = odds[1] / odds.sum()
        return out


def train(
    frame: pd.DataFrame,
    buckets: int = BUCKETS,
    dim: int = DIM,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = 2.0,
    seed: int = 0,
) -> Model:
    """Vectors and layer from columns text and label (0 or 1), in two classes."""
    random = np.random.default_rng(seed)
    labels = frame["label"].to_numpy("int64")
    vocabulary: dict[bytes, int] = {}
    bags = []
    # One text's words at a time, and a piece of the vocabulary: the task's memory
    # holds distinct words and features, not all words at once.
    for text in frame["text"]:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in (text or "").encode().split()]
        bags.append(np.unique(np.array(ids, "int64"), return_counts=True))
    features, counts = features_in_pieces(list(vocabulary), buckets)
    del vocabulary
    ends = np.concatenate([[0], np.cumsum(counts)]).astype("int64")
    vectors = (random.random((buckets, dim)) - 0.5) / dim
    layer, bias = np.zeros((dim, 2)), np.zeros(2)
    # Vectors start with a little difference between the classes to climb from.
    layer[:, 1] = random.standard_normal(dim) * 0.1
    per_epoch = math.ceil(max(len(bags), 1) / batch)
    epochs = max(epochs, math.ceil(MIN_STEPS / per_epoch))
    steps = epochs * per_epoch
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(bags))
        for start in range(0, len(order), batch):
            now = rate * (1 - step / steps)
            step += 1
            chosen = [i for i in order[start : start + batch] if len(bags[i][0])]
            if not chosen:
                continue
            words, word_doc, word_n = [], [], []
            for k, i in enumerate(chosen):
                ids, times = bags[i]
                words.append(ids)
                word_doc.append(np.full(len(ids), k))
                word_n.append(times / (times * counts[ids]).sum())
            ids = np.concatenate(words)
            doc_of, share = np.concatenate(word_doc), np.concatenate(word_n)
            # One sum of feature vectors for each distinct word of the batch.
            own, place = np.unique(ids, return_inverse=True)
            sizes = counts[own]
            flat = np.repeat(ends[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            flat = features[flat + np.arange(sizes.sum())]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype("int64")
            sums = np.add.reduceat(vectors[flat], starts, axis=0)
            weights = np.zeros((len(own), len(chosen)))
            np.add.at(weights, (place, doc_of), share)
            means = weights.T @ sums
            odds = means @ layer + bias
            odds = np.exp(odds - odds.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error /= len(chosen)
            change = weights @ (error @ layer.T)
            layer -= now * (means.T @ error)
            bias -= now * error.sum(axis=0)
            for d in range(dim):
                vectors[:, d] -= now * VECTOR_RATE * np.bincount(
                    flat, np.repeat(change[:, d], sizes), minlength=buckets
                )
    return Model((vectors @ layer).astype("float32"), bias)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_per_class: int = SAMPLE_PER_CLASS,
    **how,
) -> Model:
    """A model from the labels of documents outside the held-out fold.

    Classes are drawn evenly; the bias is then moved to the odds of all labels.
    With labels of one class, or none, every score is the smoothed share of 1.
    """
    sample, counts = labelled_sample(docs, labels, label, sample_per_class)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        prior = math.log((n1 + 1) / (n0 + 1))
        return Model(np.zeros((1, 2), "float32"), np.array([0.0, prior]))
    model = fit_in_task(sample, lambda frame: train(frame, **how))
    m0, m1 = min(n0, sample_per_class), min(n1, sample_per_class)
    model.bias = model.bias + np.array([0.0, math.log(n1 / n0) - math.log(m1 / m0)])
    return model


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (int).

    A score depends on the text alone. Null and empty texts get the score of no
    words. Older columns of these names are replaced, all others kept.
    """
    docs = docs.drop("score", "predicted")
    names = [*docs.columns, "score", "predicted"]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                scores = scorer.score(batch.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(scores, pa.float64()),
                        pa.array((scores >= 0.5).astype("int32"), pa.int32()),
                    ],
                    names,
                )

    return docs.mapInArrow(run, with_fields(docs, score="double", predicted="int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the model predicts to be of class 1, columns as they were."""
    docs, back = set_aside(docs, ["score", "predicted"])
    return score_quality(docs, model, text_col).filter("predicted = 1").select(*back)


def op10_subword_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )
