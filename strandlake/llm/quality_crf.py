"""Document quality from a linear-chain conditional random field over lines (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import (IS_LEAD, IS_SPACE, SpanHash, Texts, fit_logistic, is_held_out, label_counts, labelled_sample,
                      logistic, slices, whole_texts)

#: the field is fitted on at most so many labelled texts of each label, in chains of at most so many lines
SAMPLE_PER_LABEL = 1500
CHAIN = 64
STEPS = 150
#: squares of the weights count so much, those of a line's features and those of its transitions
UNARY_PENALTY, STEP_PENALTY = 1e-4, 1e-2
THRESHOLD = 0.7

_ASCII = [chr(b) if b < 128 else "" for b in range(256)]


def _bytes_in(test) -> np.ndarray:
    return np.array([bool(c) and test(c) for c in _ASCII])


#: share of a line's code points of each class is one feature
CLASSES = [
    _bytes_in(str.isupper), _bytes_in(str.islower), _bytes_in(str.isdigit), _bytes_in(lambda c: c in ".,;:?"),
    _bytes_in(lambda c: c == "!"), _bytes_in(lambda c: c == "|"), _bytes_in(lambda c: c in "#*$%&<>"),
    _bytes_in(lambda c: c in "/\\_=+~^@{}[]()\"'`-"), _bytes_in(str.isspace) & IS_SPACE,
]
OWN = len(CLASSES) + 13  # and the thirteen below
WIDTH = 3 * OWN + 1


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, length in code points and text number of each line, in order."""
    s, e, doc = texts.lines()
    n = len(s)

    def total(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(texts.data) + 1, np.int32)
        np.cumsum(mask[texts.data], out=c[1:])
        return (c[e] - c[s]).astype(np.float64)

    length = total(IS_LEAD)
    size = np.maximum(length, 1)
    cols = [total(c) / size for c in CLASSES]
    cols.append((length - total(np.arange(256) < 128)) / size)
    ws, we, _ = texts.words()
    spans = SpanHash(texts.data)
    line_of = np.searchsorted(s, ws, side="right") - 1 if n else ws
    words = np.bincount(line_of, minlength=n).astype(np.float64)
    wh = spans.of(ws, we)
    order = np.lexsort((wh, line_of))
    first = np.ones(len(order), bool)
    first[1:] = (wh[order][1:] != wh[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    kinds = np.bincount(line_of[order][first], minlength=n).astype(np.float64)
    lh = spans.of(s, e)
    order = np.lexsort((np.arange(n), lh, doc))
    again = np.zeros(n, bool)
    again[order[1:]] = (lh[order][1:] == lh[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    blank = words == 0
    last = texts.data[np.maximum(e - 1, 0)] if len(texts.data) else np.zeros(n, np.uint8)
    head = texts.data[np.minimum(s, max(len(texts.data) - 1, 0))] if len(texts.data) else np.zeros(n, np.uint8)
    doc_words = np.bincount(doc, weights=words, minlength=texts.count)
    doc_lines = np.bincount(doc, minlength=texts.count)
    doc_again = np.bincount(doc, weights=again & ~blank, minlength=texts.count) / np.maximum(doc_lines, 1)
    # words of the whole text: how many kinds among them
    wdoc = np.searchsorted(texts.ends, ws, side="right")
    order = np.lexsort((wh, wdoc))
    first = np.ones(len(order), bool)
    first[1:] = (wh[order][1:] != wh[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
    doc_kinds = np.bincount(wdoc[order][first], minlength=texts.count)
    cols += [
        np.log1p(length) / 5, np.log1p(words) / 4, length / np.maximum(words, 1) / 10, 1 - kinds / np.maximum(words, 1),
        blank, again & ~blank, (length > 0) & np.isin(last, list(b".!?")), (length > 0) & CLASSES[0][head],
        (np.log1p(doc_words) / 8)[doc], (np.log1p(doc_lines) / 4)[doc], doc_again[doc],
        (1 - doc_kinds / np.maximum(doc_words, 1))[doc],
    ]
    return np.stack([np.asarray(c, np.float64) for c in cols], axis=1), length, doc


def with_neighbours(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros at a text's ends), and a one."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = doc[1:] == doc[:-1]
    before[1:][same] = x[:-1][same]
    after[:-1][same] = x[1:][same]
    return np.concatenate([x, before, after, np.ones((len(x), 1))], axis=1)


def marginals(odds: np.ndarray, chain: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the summed pair marginals of neighbours."""
    return forward_backward(odds, chain, step, np.ones(len(odds)))[:2]


def forward_backward(odds: np.ndarray, chain: np.ndarray, step: np.ndarray,
                     weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, the summed pair marginals of neighbours and the summed logarithm
    of the chains' normalisers (all labellings together).

    odds: log-odds of good from the line's features; chain: number of the chain it is in,
    rising; step: the 2 x 2 transition weights (from, to), 0 bad, 1 good. The two sums count
    each chain by the ``weight`` of its lines, which is the same for all of them.
    """
    n = len(odds)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    size = np.bincount(chain)
    size = size[size > 0]
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")  # chains with more than t lines
    p = logistic(odds)
    emit = np.stack([1 - p, p], axis=1) + 1e-12
    fwd, back = np.zeros((n, 2)), np.ones((n, 2))
    scale = np.ones(n)
    scale[start] = emit[start].sum(axis=1)
    fwd[start] = emit[start] / scale[start][:, None]
    for t in range(1, len(active)):
        at = start[: active[t]] + t
        a = (fwd[at - 1] @ step) * emit[at]
        scale[at] = a.sum(axis=1)
        fwd[at] = a / scale[at][:, None]
    pairs = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = start[: active[t]] + t
        ahead = emit[at] * back[at]
        b = ahead @ step.T
        both = fwd[at - 1][:, :, None] * step[None] * ahead[:, None, :]
        pairs += (both * (weight[at] / both.sum(axis=(1, 2)))[:, None, None]).sum(axis=0)
        back[at - 1] = b / b.sum(axis=1, keepdims=True)
    m = fwd * back
    # log(1 + exp(odds)) was taken out of each line's two weights
    return m[:, 1] / m.sum(axis=1), pairs, float(weight @ (np.log(scale) + np.logaddexp(0, odds)))


def objective(theta: np.ndarray, x: np.ndarray, good: np.ndarray, part: np.ndarray,
              weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of the labels (``good`` by line) with its penalty, and its gradient.

    theta: a weight for each column of x, then the four logarithms of the transition weights.
    """
    odds, trans = x @ theta[:-4], theta[-4:].reshape(2, 2)
    p, pairs, normaliser = forward_backward(odds, part, np.exp(trans), weight)
    at = np.flatnonzero(part[1:] == part[:-1]) + 1
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at - 1].astype(int), good[at].astype(int)), weight[at])
    penalty = np.full(len(theta), UNARY_PENALTY)
    penalty[-4:] = STEP_PENALTY
    value = normaliser - weight @ (good * odds) - (seen * trans).sum() + 0.5 * penalty @ theta**2
    return value, np.concatenate([x.T @ (weight * (p - good)), (pairs - seen).ravel()]) + penalty * theta


@dataclass
class QualityModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 1.0
    offset: float = 0.0


def fit(sample: pa.Table, totals: dict[int, int], chain: int = CHAIN, steps: int = STEPS) -> QualityModel:
    """Penalised maximum likelihood with every line carrying its text's label.

    A chain counts by its label's share over its number of lines, in lines and pairs of
    neighbours alike. Gradient steps with moment estimates on ``objective``; then slope and offset turn the log-odds of the
    length-weighted marginals into shares of label 1, at the true share of either label.
    """
    y = sample.column("label").to_numpy()
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    share = (totals.get(1, 0) + 0.5) / (totals.get(0, 0) + totals.get(1, 0) + 1.0)
    prior = float(np.log(share / (1 - share)))
    if not n0 or not n1:
        return QualityModel(offset=prior, slope=0.0)
    texts = Texts(sample.column("text").combine_chunks())
    own, length, doc = line_features(texts)
    x = with_neighbours(own, doc)
    first = np.searchsorted(doc, np.arange(texts.count))
    place = np.arange(len(doc)) - first[doc]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] % chain == 0)
    part = np.cumsum(new) - 1
    line_y = (y[doc] == 1).astype(np.float64)
    weight = np.where(y == 1, totals.get(1, n1) / n1, totals.get(0, n0) / n0)[doc]
    weight = weight / np.bincount(part)[part]  # a chain's lines share its weight
    weight /= weight.sum()
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        _, g = objective(theta, x, line_y, part, weight)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    model = QualityModel(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
    raw = _log_odds(texts, model)
    doc_weight = np.where(y == 1, totals.get(1, n1) / n1, totals.get(0, n0) / n0)
    slope, offset = fit_logistic(raw[:, None], (y == 1).astype(float), doc_weight, l2=1e-3)
    return QualityModel(model.weights, model.transitions, float(slope[0]), offset)


def _log_odds(texts: Texts, model: QualityModel) -> np.ndarray:
    """Log-odds of a text's length-weighted mean of P(good) over its lines."""
    own, length, doc = line_features(texts)
    p, _ = marginals(with_neighbours(own, doc) @ model.weights, doc, np.exp(model.transitions))
    weight = np.where((np.bincount(doc, weights=length, minlength=texts.count) > 0)[doc], length, 1.0)
    share = np.bincount(doc, weights=weight * p, minlength=texts.count) / np.maximum(
        np.bincount(doc, weights=weight, minlength=texts.count), 1e-12)
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row of ``docs`` by its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                p = logistic(model.slope * _log_odds(Texts(part.column("text")), model) + model.offset)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "score": p,
                                       "predicted": (p >= threshold).astype(np.int32)})

    return whole_texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL,
            threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    Each line of the whole text is good or bad; a linear-chain conditional random field
    over the lines sees a line's own features and those of its neighbours. The marginals
    of forward-backward, weighted by line length, make the text's quality, which a
    logistic map turns into the share of label 1. Fitted on at most ``sample_per_label``
    labelled texts of either label outside the held-out rows.

    A null or empty text is one empty line and gets its score. Texts whose lines are all
    empty weigh the lines equally. Repeated rows are scored alike. Without labels (or with
    one label only) every score is the smoothed share of label 1. Empty table: no rows.
    """
    totals = label_counts(labels, "quality")
    model = fit(labelled_sample(docs, labels, "quality", sample_per_label, totals).toArrow(), totals)
    return score(docs, model, threshold).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
