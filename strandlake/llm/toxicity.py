"""Toxicity by a linear classifier on character n-grams scaled by log-count ratios (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import Chars, fit_logistic, is_held_out, label_counts, labelled_sample, logistic, slices, whole_texts

LENGTHS = (4, 5, 6)
BITS = 20
#: the classifier is fitted on at most so many labelled texts of each label
SAMPLE_PER_LABEL = 2000
MAX_FEATURES = 2048
LEAST_Z = 3.5
THRESHOLD = 0.3


@dataclass
class ToxicModel:
    """Bins that carry a weight, sorted, with weight times log-count ratio, and the bias."""

    bins: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0


def _present(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(text number, feature) once for each text that holds the feature; table: feature by bin, or -1."""
    chars = Chars(column)
    pairs = []
    width = int(table.max()) + 1 if len(table) else 0
    for n in LENGTHS:
        at, h = chars.grams(n, BITS)
        f = table[h]
        hit = f >= 0
        pairs.append(np.unique(np.searchsorted(chars.ends, at[hit], side="right") * width + f[hit]))
    both = np.unique(np.concatenate(pairs)) if width else np.zeros(0, np.int64)
    return both // max(width, 1), both % max(width, 1), chars.count


def fit(sample: pa.Table, totals: dict[int, int]) -> ToxicModel:
    """Naive Bayes log-count ratios of presence, then logistic weights on presence times ratio.

    ``totals`` are the counts of all labelled rows; they weigh the sample back to the
    true share of either label. With one label only, the model is that share.
    """
    y = sample.column("label").to_numpy()
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    share = (totals.get(1, 0) + 0.5) / (totals.get(0, 0) + totals.get(1, 0) + 1.0)
    prior = float(np.log(share / (1 - share)))
    if not n0 or not n1:
        return ToxicModel(bias=prior)
    size = 1 << BITS
    counts = np.zeros((2, size))
    texts = sample.column("text").combine_chunks()
    for i in range(len(texts)):
        seen = np.zeros(size, bool)
        chars = Chars(texts.slice(i, 1))
        for n in LENGTHS:
            seen[chars.grams(n, BITS)[1]] = True
        counts[int(y[i])][np.flatnonzero(seen)] += 1
    rate = (counts[0] + counts[1]) / (n0 + n1)
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n0 + 1 / n1))
    z = np.abs(counts[1] / n1 - counts[0] / n0) / spread
    z[(counts.sum(axis=0) < 2) | (z < LEAST_Z)] = 0
    bins = np.sort(np.argsort(-z, kind="stable")[: min(MAX_FEATURES, int((z > 0).sum()))])
    if not len(bins):
        return ToxicModel(bias=prior)
    p, q = 1.0 + counts[1], 1.0 + counts[0]
    ratio = (np.log(p / (n1 + 2.0)) - np.log(q / (n0 + 2.0)))[bins]
    table = np.full(size, -1, np.int32)
    table[bins] = np.arange(len(bins))
    x = np.zeros((len(y), len(bins)))
    for i in range(len(texts)):
        _, f, _ = _present(texts.slice(i, 1), table)
        x[i, f] = ratio[f]
    weight = np.where(y == 1, totals.get(1, n1) / n1, totals.get(0, n0) / n0)
    beta, bias = fit_logistic(x, y, weight, l2=2e-3)
    return ToxicModel(bins, beta * ratio, bias)


def _odds(part: pa.RecordBatch, model: ToxicModel, table: np.ndarray, column: str = "text") -> np.ndarray:
    doc, f, n = _present(part.column(column), table)
    return logistic(np.bincount(doc, weights=model.weights[f] if len(f) else None, minlength=n) + model.bias)


def _features(model: ToxicModel) -> np.ndarray:
    table = np.full(1 << BITS, -1, np.int32)
    table[model.bins] = np.arange(len(model.bins))
    return table


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row of ``docs`` by its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _features(model)
        for batch in batches:
            for part in slices(batch):
                p = _odds(part, model, table)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "score": p,
                                       "predicted": (p >= threshold).astype(np.int32)})

    return whole_texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL,
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    The text alone is scored: presence of character n-grams of 4 to 6 code points (lower
    case, blanks alike), each times its naive Bayes log-count ratio. Ratios and weights
    come from at most ``sample_per_label`` labelled texts of either label outside the
    held-out rows; n-grams count whose presence differs between labels by ``LEAST_Z``
    standard errors. The model is a few thousand numbers however large the corpus.

    Null and empty texts get the score of a text without any such n-gram. Repeated rows
    are scored alike. Without labels (or with one label only) every score is the
    smoothed share of label 1. Rows with a null id are scored and never learned from.
    Empty table: no rows.
    """
    totals = label_counts(labels, "toxic")
    model = fit(labelled_sample(docs, labels, "toxic", sample_per_label, totals).toArrow(), totals)
    return score(docs, model, threshold).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL,
               threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; each row is judged where it lies."""
    totals = label_counts(labels, "toxic")
    model = fit(labelled_sample(docs, labels, "toxic", sample_per_label, totals).toArrow(), totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _features(model)
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(_odds(part, model, table) < threshold))

    return docs.mapInArrow(run, docs.schema)
