"""Language of a text by hierarchical discrimination (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .textkit import Chars, is_held_out, slices, whole_texts

LENGTHS = (1, 2, 3)
BITS = 12
#: the classifiers within families are fitted on at most so many texts of each language
PER_LANGUAGE = 400
#: those between families on at most so many in all, equally many of each language
HEAD_SAMPLE = 2000
#: a larger family is divided, so that pairs of languages grow with their number only
MAX_FAMILY = 24
#: ids that are sent to all tasks at most (16 bytes each)
FEW_IDS = 1 << 20
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Linear classifiers on scaled n-gram shares: one per family, one per pair within a family."""

    languages: list[str] = field(default_factory=list)
    family: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))


def shares(column: pa.Array) -> np.ndarray:
    """Share of each n-gram bin among all n-grams of a text, a row per text."""
    chars = Chars(column)
    out = np.zeros((chars.count, 1 << BITS))
    for n in LENGTHS:
        at, h = chars.grams(n, BITS)
        doc = np.searchsorted(chars.ends, at, side="right")
        out += np.bincount((doc << BITS) + h, minlength=out.size).reshape(out.shape)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def _svms(x: np.ndarray, sign: np.ndarray, l2: float = 1e-3, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Linear support vector machines with squared hinge loss, one per column of signs; both sides weigh the same."""
    weight = np.where(sign > 0, 0.5 / np.maximum(1, (sign > 0).sum(axis=0)), 0.5 / np.maximum(1, (sign < 0).sum(axis=0)))
    top = 2 * (weight * np.einsum("ij,ij->i", x, x)[:, None]).sum(axis=0) + 2 + l2
    w, b = np.zeros((x.shape[1], sign.shape[1]), x.dtype), np.zeros(sign.shape[1])
    mw, mb = w, b
    for k in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ mw + mb))
        g = (-2 * weight * sign * slack).astype(x.dtype)
        nw, nb = mw - ((x.T @ g + l2 * mw) / top).astype(x.dtype), mb - g.sum(axis=0) / top
        t = k / (k + 3.0)
        mw, mb = nw + x.dtype.type(t) * (nw - w), nb + t * (nb - b)
        w, b = nw, nb
    return w, b


def _linkage(means: np.ndarray) -> tuple[list[list[list[int]]], list[float]]:
    """Groups after each merge of average linkage of the mean profiles, and the distance of each merge."""
    n = len(means)
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    far = 1 - unit @ unit.T
    far[np.tril_indices(n)] = np.inf
    groups: list[list[int] | None] = [[i] for i in range(n)]
    states, heights = [[[i] for i in range(n)]], [1e-9]
    for _ in range(n - 1):
        a, b = divmod(int(far.argmin()), n)
        heights.append(float(far[a, b]))
        size_a, size_b = len(groups[a]), len(groups[b])
        both = np.minimum(far, far.T)  # distances to each group, whichever half holds them
        joined = (size_a * both[a] + size_b * both[b]) / (size_a + size_b)
        far[b, :] = far[:, b] = np.inf
        far[a, a + 1 :] = np.where(np.isinf(far[a, a + 1 :]), np.inf, joined[a + 1 :])
        far[:a, a] = np.where(np.isinf(far[:a, a]), np.inf, joined[:a])
        groups[a], groups[b] = groups[a] + groups[b], None
        states.append([list(g) for g in groups if g is not None])
    return states, heights


def families(means: np.ndarray, largest: int = 0) -> np.ndarray:
    """Family number of each language, by average linkage of the mean profiles.

    The tree of languages is cut before the merge whose distance grows most against the
    merge before it; two languages or fewer are one family each. A family of more than
    ``largest`` languages is cut again, into the two that were merged last.
    """
    n, largest = len(means), largest or MAX_FAMILY
    states, heights = _linkage(means)
    cut = 0
    if n > 2:  # after merge k the next one costs heights[k + 1]
        cut = max(range(1, n - 1), key=lambda k: heights[k + 1] / max(heights[k], 1e-9))
    open_, done = [sorted(g) for g in states[cut]], []
    while open_:
        g = open_.pop()
        if len(g) <= largest:
            done.append(g)
        else:
            halves = _linkage(means[g])[0][-2]
            open_ += [sorted(g[i] for i in half) for half in halves]
    label = np.zeros(n, np.int64)
    for f, g in enumerate(sorted(done)):
        label[g] = f
    return label


def _profiles(texts: pa.Array) -> np.ndarray:
    return np.concatenate([shares(texts.slice(i, 64)).astype(np.float32) for i in range(0, len(texts), 64)])


def mean_profiles(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the mean share of each n-gram in each, from (text, lang); a row per language reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for part in slices(batch, rows=256):
                lang = np.array(part.column("lang").to_pylist(), dtype=object)
                x = shares(part.column("text"))
                for name in set(lang):
                    n, total = sums.get(name, (0, 0.0))
                    sums[name] = (n + int((lang == name).sum()), total + x[lang == name].sum(axis=0))
        for name, (n, total) in sums.items():
            yield pa.record_batch({"lang": [name], "n": [n], "total": pa.array([total.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in table.column("total").to_pylist())
        return pa.table({"lang": table.column("lang")[:1], "n": [sum(table.column("n").to_pylist())], "total": pa.array([total.tobytes()], pa.binary())})

    form = "lang string, n long, total binary"
    rows = sorted(sample.mapInArrow(run, form).groupBy("lang").applyInArrow(add, form).collect(), key=lambda r: r["lang"])
    means = [np.frombuffer(r["total"], np.float64) / r["n"] for r in rows]
    return [r["lang"] for r in rows], np.stack(means) if means else np.zeros((0, 1 << BITS))


def fit(sample: DataFrame, heads_of: int = HEAD_SAMPLE) -> LanguageModel:
    """Families from the distances of mean profiles, then the classifiers of both levels.

    The machines of each family are fitted by one task from that family's texts; those
    that tell families apart on the driver, from at most ``heads_of`` texts, equally many of
    each language.
    """
    sample = stage(sample, "language_sample")
    names, means = mean_profiles(sample)
    if not names:
        return LanguageModel()
    scale = (1.0 / np.sqrt(means.mean(axis=0) + 1e-5)).astype(np.float32)
    family = families(means)
    number = {name: k for k, name in enumerate(names)}
    n_fam = int(family.max()) + 1

    def machines(table: pa.Table) -> pa.Table:
        y = np.array([number[v] for v in table.column("lang").to_pylist()])
        x = _profiles(table.column("text").combine_chunks()) * scale
        a, b, weights, bias = [], [], [], []
        for i, k in combinations(np.unique(y).tolist(), 2):
            own = (y == i) | (y == k)
            w, c = _svms(x[own], np.where(y[own] == i, 1.0, -1.0)[:, None])
            a, b, weights, bias = a + [i], b + [k], weights + [(w[:, 0] * scale).tobytes()], bias + [float(c[0])]
        return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "w": pa.array(weights, pa.binary()),
                         "bias": pa.array(bias, pa.float64())})

    of = sample.sparkSession.createDataFrame([(n, int(f)) for n, f in zip(names, family)], "lang string, family int")
    pairs = sorted(sample.join(of, "lang").groupBy("family").applyInArrow(machines, "a int, b int, w binary, bias double").collect())
    columns, bias = [], []
    if n_fam > 1:
        each = max(1, heads_of // len(names))
        few = sample.filter(F.col("rank") <= each).orderBy("lang", "rank").toArrow()
        y = np.array([number[v] for v in few.column("lang").to_pylist()])
        x = _profiles(few.column("text").combine_chunks()) * scale
        w, c = _svms(x, np.where(family[y][:, None] == np.arange(n_fam), 1.0, -1.0))
        columns, bias = list((w * scale[:, None]).T), list(c)
    columns += [np.frombuffer(r["w"], np.float32) for r in pairs]
    bias += [r["bias"] for r in pairs]
    weights = np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros((1 << BITS, 0), np.float32)
    return LanguageModel(names, family, [(r["a"], r["b"]) for r in pairs], weights, np.array(bias, np.float32))


def decide(margins: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Language number and score of each row: the family first, then votes within it."""
    n_fam = int(model.family.max()) + 1
    heads = n_fam if n_fam > 1 else 0
    n = len(margins)
    if heads:
        own = margins[:, :heads]
        fam = own.argmax(axis=1)
        ranked = np.sort(own, axis=1)
        sure = 1 / (1 + np.exp(-2 * (ranked[:, -1] - ranked[:, -2])))
    else:
        fam, sure = np.zeros(n, np.int64), np.ones(n)
    votes = np.zeros((n, len(model.languages)))
    weakest = np.full((n, len(model.languages)), np.inf)
    for k, (a, b) in enumerate(model.pairs):
        m = margins[:, heads + k]
        soft = np.tanh(m) * 1e-3  # parts equal votes
        votes[:, a] += (m >= 0) + soft
        votes[:, b] += (m < 0) - soft
        weakest[:, a] = np.minimum(weakest[:, a], m)
        weakest[:, b] = np.minimum(weakest[:, b], -m)
    votes[model.family[None, :] != fam[:, None]] = -np.inf
    best = votes.argmax(axis=1)
    low = weakest[np.arange(n), best]
    inside = np.where(np.isinf(low), 1.0, 1 / (1 + np.exp(-4 * np.where(np.isinf(low), 0, low))))
    return best, np.clip(sure * inside, 0, 1)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for each row of ``docs`` by its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows=256):
                column = part.column("text")
                lettered = np.array([any(map(str.isalpha, t or "")) for t in column.to_pylist()], bool)
                lang, p = [UNKNOWN] * len(lettered), np.zeros(len(lettered))
                if model.languages and lettered.any():
                    best, got = decide(shares(column) @ model.weights + model.bias, model)
                    lang = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
                    p = np.where(lettered, got, 0.0)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": p})

    return whole_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_sample(docs: DataFrame, each: int = PER_LANGUAGE) -> DataFrame:
    """At most ``each`` texts of every language outside the held-out rows, chosen by a hash of the id: text, lang, rank.

    A threshold on the hash, from the language's count, leaves about twice as many as are
    wanted before they are ranked, so that no language is ordered as a whole. While the ids
    chosen are few, they are sent to the texts.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~is_held_out())
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    below = F.least(F.lit(1.0), (2.0 * each + 64.0) / F.col("n")) * float(1 << 40)
    chosen = (
        known.join(F.broadcast(counts), "lang").filter(mark <= below)  # a row per language, as the model's.select("doc_id", "lang").distinct()
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
        .filter(F.col("rank") <= each)
    )
    chosen = stage(chosen, "language_ids")
    if chosen.count() <= FEW_IDS:  # else the texts are shuffled to them
        chosen = F.broadcast(chosen)
    return whole_texts(docs).join(chosen, "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "lang", "rank")


def identify(docs: DataFrame, each: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    Shares of character n-grams of 1 to 3 code points (hashed to ``2**BITS`` bins) of the
    whole text go first through one linear classifier per family, then through one
    classifier per pair of languages of the winning family; most votes win, margins part
    ties (equal ones go to the first language by name). Families are learned: languages with
    near mean profiles belong together, 24 at most. Fitted on at most ``each`` texts of every
    ``lang`` value outside the held-out rows; every value is learned. The model grows by some
    200 KB with each language.

    Null texts and texts without a letter are ``und`` with score 0. Without any known
    language all are ``und``. Rows with a null id are predicted and never learned from.
    Repeated rows are predicted alike. Empty table: no rows.
    """
    model = fit(language_sample(docs, each))
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
