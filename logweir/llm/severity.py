"""Toxicity severity by cumulative-link (proportional odds) ordinal regression.

With sparse text features x and grades 0..K-1,

    P(grade <= k | x) = sigmoid(threshold_k - weight . x),

one weight vector for all ordered thresholds. Features are a text's words and the
beginnings of its words, so that a stem with many endings is one feature; a value is
the log of the count per hundred words. The loss is the weighted negative log
likelihood of the grades with an L1 penalty on the weights, minimised by accelerated
proximal gradient steps in numpy; most weights end at zero, so only a small model is
broadcast. The result is the expected severity, the sum over k of P(grade > k).

Labels say toxic or not. A toxic document's grade is its third among the toxic ones by
the signal of a model that was fitted without it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import fit_in_task, labelled_sample, table, with_fields

# Labelled documents of each kind that the model is fitted on, at most.
SAMPLE_PER_CLASS = 2_000
# Characters of a word's beginnings.
PREFIXES = (3, 4, 5, 6)
# A feature is used if it is in so many documents of one kind, and if the difference of
# its shares in the two kinds is so many standard errors. That is a test of each feature
# on its own: a language with few labels keeps its features too.
MIN_DOCS, MIN_ERRORS = 3, 4.0
PENALTY = 0.0003
STEPS = 300
FOLDS = 3
# Grades of toxic documents, from 1 on.
GRADES = 3
FLAG_AT = 0.5
# Distinct words whose features a worker remembers; it starts anew when full.
CACHE_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def word_features(word: str) -> list[str]:
    """The word itself, marked by its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)]


def value(count: float, words: int) -> float:
    """Log count per hundred words; short texts are not blown up."""
    return math.log1p(100 * count / max(words, 100))


@dataclass
class Severity:
    weights: dict[str, float]
    thresholds: np.ndarray
    cache: dict[str, tuple] = field(default_factory=dict, repr=False, compare=False)

    def signal(self, text: str | None) -> float:
        """weight . x"""
        if not text or not self.weights:
            return 0.0
        counts = word_counts(text)
        if len(self.cache) + len(counts) > CACHE_WORDS:
            self.cache.clear()
        total: Counter = Counter()
        for word, n in counts.items():
            own = self.cache.get(word)
            if own is None:
                own = tuple(f for f in word_features(word) if f in self.weights)
                self.cache[word] = own
            for name in own:
                total[name] += n
        words = counts.total()
        return sum(self.weights[f] * value(n, words) for f, n in sorted(total.items()))

    def above(self, signals: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - signals[:, None], -60, 60)))


def telling_features(
    texts: list, toxic: np.ndarray, min_docs: int = MIN_DOCS, min_errors: float = MIN_ERRORS
) -> list[str]:
    """Features whose shares in the two kinds of documents differ for sure."""
    kinds = [Counter(), Counter()]
    for text, label in zip(texts, toxic, strict=True):
        kinds[int(label > 0)].update({f for w in word_counts(text) for f in word_features(w)})
    n0, n1 = max(int((toxic <= 0).sum()), 1), max(int((toxic > 0).sum()), 1)
    found = []
    for name in kinds[0].keys() | kinds[1].keys():
        a, b = kinds[0][name], kinds[1][name]
        if max(a, b) < min_docs:
            continue
        share = (a + b + 1) / (n0 + n1 + 2)
        error = math.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
        if abs((a + 0.5) / (n0 + 1) - (b + 0.5) / (n1 + 1)) > min_errors * error:
            found.append(name)
    return sorted(found)


@dataclass
class Matrix:
    """Sparse values of ``names`` in a number of documents."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    documents: int
    names: list[str]

    def signals(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.columns], minlength=self.documents)

    def only(self, kept: np.ndarray) -> Matrix:
        number = np.cumsum(kept) - 1
        own = kept[self.rows]
        rows = number[self.rows[own]]
        return Matrix(rows, self.columns[own], self.values[own], int(kept.sum()), self.names)


def matrix(texts: list, names: list[str]) -> Matrix:
    number = {name: i for i, name in enumerate(names)}
    rows, columns, values = [], [], []
    for i, text in enumerate(texts):
        counts, total = word_counts(text), Counter()
        for word, n in counts.items():
            for name in word_features(word):
                if name in number:
                    total[name] += n
        words = counts.total()
        for name, n in sorted(total.items()):
            rows.append(i)
            columns.append(number[name])
            values.append(value(n, words))
    return Matrix(
        np.array(rows, "int64"), np.array(columns, "int64"), np.array(values, "float64"), len(texts), names
    )


def fit_ordinal(
    x: Matrix,
    grade: np.ndarray,
    weight: np.ndarray,
    penalty: float = PENALTY,
    steps: int = STEPS,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from features, grades and document weights."""
    rows, columns, values = x.rows, x.columns, x.values
    n, top = len(grade), int(grade.max())
    words = x.names
    weight = weight / weight.sum()
    share = np.array([weight[grade <= k].sum() for k in range(top)])
    share = np.clip(share, 1e-6, 1 - 1e-6)
    theta = np.log(share / (1 - share))
    w = np.zeros(len(words))

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    def loss_and_slopes(w: np.ndarray, theta: np.ndarray):
        eta = x.signals(w)
        bounds = np.concatenate([[-np.inf], theta, [np.inf]])
        up, low = bounds[grade + 1], bounds[grade]
        f_up = np.where(np.isinf(up), 1.0, sigmoid(up - eta))
        f_low = np.where(np.isinf(low), 0.0, sigmoid(low - eta))
        p = np.maximum(f_up - f_low, 1e-12)
        d_up, d_low = f_up * (1 - f_up) / p, f_low * (1 - f_low) / p
        d_eta = weight * (d_up - d_low)
        slope_w = np.bincount(columns, values * d_eta[rows], minlength=len(words))
        slope_theta = np.zeros(top)
        for k in range(top):
            slope_theta[k] = -(weight * d_up)[grade == k].sum()
            slope_theta[k] += (weight * d_low)[grade == k + 1].sum()
        return -(weight * np.log(p)).sum(), slope_w, slope_theta

    ahead_w, ahead_theta, t, rate = w, theta, 1.0, 8.0
    for _ in range(steps):
        loss, slope_w, slope_theta = loss_and_slopes(ahead_w, ahead_theta)
        while True:
            new_w = ahead_w - rate * slope_w
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - rate * penalty, 0)
            # Thresholds stay in order.
            new_theta = np.maximum.accumulate(ahead_theta - rate * slope_theta)
            new_theta = new_theta + 1e-6 * np.arange(top)
            moved_w, moved_t = new_w - ahead_w, new_theta - ahead_theta
            bound = (
                loss
                + slope_w @ moved_w
                + slope_theta @ moved_t
                + (moved_w @ moved_w + moved_t @ moved_t) / (2 * rate)
            )
            if loss_and_slopes(new_w, new_theta)[0] <= bound + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        push = (t - 1) / t_next
        ahead_w = new_w + push * (new_w - w)
        ahead_theta = np.maximum.accumulate(new_theta + push * (new_theta - theta))
        ahead_theta = ahead_theta + 1e-6 * np.arange(top)
        w, theta, t = new_w, new_theta, t_next
    return w, theta


def grades(x: Matrix, toxic: np.ndarray, weight: np.ndarray, **how) -> np.ndarray:
    """0 for documents not toxic; toxic ones in equal parts by their out-of-fold signal."""
    signal = np.zeros(len(toxic))
    fold = np.arange(len(toxic)) % FOLDS
    for part in range(FOLDS):
        out = fold == part
        if toxic[out].any() and 0 < toxic[~out].sum() < (~out).sum():
            w, _ = fit_ordinal(x.only(~out), toxic[~out], weight[~out], **how)
            signal[out] = x.only(out).signals(w)
    severe = np.flatnonzero(toxic > 0)
    severe = severe[np.argsort(signal[severe], kind="stable")]
    out = np.zeros(len(toxic), "int64")
    out[severe] = 1 + np.arange(len(severe)) * GRADES // max(len(severe), 1)
    return out


def fit_texts(texts: list, toxic: np.ndarray, weight: np.ndarray, **how) -> Severity:
    """The whole fit: features, grades, weights."""
    x = matrix(texts, telling_features(texts, toxic))
    w, theta = fit_ordinal(x, grades(x, toxic, weight, **how), weight, **how)
    return Severity({x.names[i]: float(w[i]) for i in np.flatnonzero(w)}, theta)


def fit_severity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_per_class: int = SAMPLE_PER_CLASS,
    **how,
) -> Severity:
    """A model from toxicity labels of documents outside the held-out fold.

    The labels say toxic or not; the grade of a toxic document of the sample is 1, 2 or
    3. Both kinds are drawn evenly and weighted back to their numbers, so that a score
    of 0.5 is even odds. Without labels of both kinds there is one threshold at the
    smoothed share.
    """
    sample, counts = labelled_sample(docs, labels, label, sample_per_class)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        return Severity({}, np.array([math.log((n0 + 1) / (n1 + 1))]))

    def fit(frame: pd.DataFrame) -> Severity:
        # Copies of one text would make its rare words telling.
        frame = frame.drop_duplicates(["text", "label"])
        toxic = frame["label"].to_numpy("int64")
        each = np.where(toxic > 0, n1 / max(toxic.sum(), 1), n0 / max((1 - toxic).sum(), 1))
        return fit_texts(list(frame["text"]), toxic, each, **how)

    return fit_in_task(sample, fit)


def score_severity(
    docs: DataFrame, model: Severity, text_col: str = "text", flag_at: float = FLAG_AT
) -> DataFrame:
    """``docs`` with ``score``, ``expected_severity``, ``severity`` and ``toxic``.

    score is P(grade > 0), severity the most likely grade, toxic says that score is
    at least ``flag_at``. Null and empty texts have no features. Older columns of these
    names are replaced, all others kept.
    """
    made = ["score", "expected_severity", "severity", "toxic"]
    docs = docs.drop(*made)
    names = [*docs.columns, *made]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            texts = (text.as_py() for text in batch.column(text_col))
            signals = np.fromiter((own.signal(t) for t in texts), "float64", batch.num_rows)
            above = own.above(signals)
            full = np.column_stack([np.ones(len(above)), above, np.zeros(len(above))])
            likely = np.argmax(full[:, :-1] - full[:, 1:], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(above[:, 0]),
                    pa.array(above.sum(axis=1)),
                    pa.array(likely.astype("int32")),
                    pa.array(above[:, 0] >= flag_at),
                ],
                names,
            )

    types = {"score": "double", "expected_severity": "double", "severity": "int"}
    return docs.mapInArrow(run, with_fields(docs, **types, toxic="boolean"))


def op4_ordinal_severity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_severity(docs, table(spark, sf_dir, "labels"))
    return score_severity(docs, model).drop("text")
