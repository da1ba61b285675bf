"""Toxicity, language and line quality: accuracy on rows held out, defined results for odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strandlake.llm import language, quality_crf, toxicity
from strandlake.llm.queries import op2_toxicity, op4_language, op9_quality

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "en"), (2, "", None), (3, "  \n\n", "en"), (4, "1234 !!", "xx"), (None, "some text", "en"),
       (5, "wörd " * 30_000, "de"), (5, "wörd " * 30_000, "de")]
ODD = [(*r, "h", "s", 1) for r in ODD]
SCHEMA = "doc_id long, text string, lang string, held_out string, score string, label int"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def ranked(score, truth):
    order = np.argsort(np.argsort(score))
    n1, n0 = truth.sum(), (~truth).sum()
    return (order[truth].sum() + n1 - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("query, label, least", [(op2_toxicity, "toxic", 0.8), (op9_quality, "quality", 0.97)])
def test_held_out_order(spark, labels, query, label, least):
    rows = query(spark, SF).toPandas()
    assert list(rows.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(rows) == 1000 and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == rows["doc_id"].map(held)).all()
    assert (rows["predicted"] == (rows["score"] >= (0.3 if label == "toxic" else 0.7))).all()
    own = rows[rows["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert ranked(own["score"].to_numpy(), own[label].to_numpy() == 1) >= least


def test_labels_of_held_out_rows_are_not_used(spark, labels):
    """Turning their labels around changes nothing."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity.toxicity(docs, labels).collect()) == sorted(toxicity.toxicity(docs, turned).collect())


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    rows = op4_language(spark, SF).toPandas().merge(docs, on="doc_id")
    own = rows[rows["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() >= 0.98 and rows["score"].between(0, 1).all()


def test_families_are_found():
    rng = np.random.default_rng(0)
    roots = rng.random((2, 50))
    means = np.stack([roots[i // 3] + 0.1 * rng.random(50) for i in range(6)])
    assert language.families(means).tolist() == [0, 0, 0, 1, 1, 1]
    assert language.families(means[:2]).tolist() == [0, 1]
    assert language.families(means[:1]).tolist() == [0]
    assert language.families(means, 2).tolist() in ([0, 0, 1, 2, 2, 3], [0, 1, 0, 2, 3, 2], [0, 1, 1, 2, 3, 3], [0, 0, 1, 2, 3, 3], [0, 1, 1, 2, 2, 3])


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality_crf.quality])
def test_odd_rows(spark, operator):
    docs = spark.createDataFrame(ODD, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = operator(docs, none).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(1, 1, 1), (3, 0, 0), (5, 1, 0), (None, 1, 1), (4, None, 2)], "doc_id long, quality int, toxic int")
    rows = operator(docs, some).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert operator(spark.createDataFrame([], SCHEMA), some).count() == 0


def test_toxic_rows_go_as_they_are(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.schema == docs.schema
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - bad


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und")} <= rows and len(rows) == 6
    unknown = docs.withColumn("lang", docs["lang"].substr(1, 0).try_cast("int").cast("string"))
    assert {r.lang_pred for r in language.identify(unknown).collect()} == {"und"}
    assert language.identify(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    step = np.exp(rng.normal(size=(2, 2)))
    chain = np.array([0] * 4 + [1] + [2] * 6)
    odds = rng.normal(size=len(chain))
    got, pairs = quality_crf.marginals(odds, chain, step)
    want, want_pairs = np.zeros(len(chain)), np.zeros((2, 2))
    for c in range(3):
        at = np.flatnonzero(chain == c)
        weights = {}
        for code in range(2 ** len(at)):
            y = [(code >> k) & 1 for k in range(len(at))]
            w = np.exp(sum(odds[i] for i, v in zip(at, y) if v))
            for a, b in zip(y, y[1:]):
                w *= step[a, b]
            weights[tuple(y)] = w
        total = sum(weights.values())
        for y, w in weights.items():
            want[at[np.array(y) == 1]] += w / total
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w / total
    assert np.allclose(got, want, atol=1e-6) and np.allclose(pairs, want_pairs, atol=1e-6)


@pytest.mark.parametrize("seed", range(3))
def test_objective_equals_enumeration_and_its_gradient_differences(seed):
    rng = np.random.default_rng(seed)
    part = np.array([0] * 3 + [1] + [2] * 5)
    weight = np.array([0.5, 2.0, 0.1])[part]
    x, good = rng.normal(size=(len(part), 4)), rng.integers(0, 2, len(part)).astype(float)
    theta = rng.normal(size=8)
    value, gradient = quality_crf.objective(theta, x, good, part, weight)

    def score(at, y):
        return sum(v * (x[i] @ theta[:4]) for i, v in zip(at, y)) + sum(theta[4 + 2 * a + b] for a, b in zip(y, y[1:]))

    want = 0.5 * (quality_crf.UNARY_PENALTY * (theta[:4] ** 2).sum() + quality_crf.STEP_PENALTY * (theta[4:] ** 2).sum())
    for c, w in enumerate([0.5, 2.0, 0.1]):
        at = np.flatnonzero(part == c)
        every = [score(at, [(code >> k) & 1 for k in range(len(at))]) for code in range(2 ** len(at))]
        want += w * (np.log(np.exp(every).sum()) - score(at, good[at].astype(int).tolist()))
    assert np.isclose(value, want, atol=1e-8)
    for k in range(len(theta)):
        step = np.eye(len(theta))[k] * 1e-5
        up, down = (quality_crf.objective(theta + d, x, good, part, weight)[0] for d in (step, -step))
        assert np.isclose(gradient[k], (up - down) / 2e-5, atol=1e-6)


def test_document_quality_weighs_lines_by_length():
    """Log-odds of the mean of P(good), by all labellings of a text's lines; empty lines alone weigh the same."""
    from strandlake.llm.textkit import Texts

    rng = np.random.default_rng(5)
    model = quality_crf.QualityModel(rng.normal(size=quality_crf.WIDTH) * 0.3, rng.normal(size=(2, 2)))
    for text in ("A line.\n## || 12\n\nand one more, longer line", "", "\n\n", "one"):
        texts = Texts(pa.array([text]))
        own, _, doc = quality_crf.line_features(texts)
        odds = quality_crf.with_neighbours(own, doc) @ model.weights
        n, total, good = len(odds), 0.0, np.zeros(len(odds))
        for code in range(2**n):
            y = np.array([(code >> k) & 1 for k in range(n)])
            w = np.exp(odds @ y + sum(model.transitions[a, b] for a, b in zip(y, y[1:])))
            total, good = total + w, good + w * y
        length = np.array([len(t) for t in text.split("\n")], float)
        share = np.average(good / total, weights=length if length.sum() else None)
        assert np.isclose(quality_crf._log_odds(texts, model)[0], np.log(share / (1 - share)), atol=1e-6)


def test_line_features_see_neighbours():
    from strandlake.llm.textkit import Texts

    own, length, doc = quality_crf.line_features(Texts(pa.array(["a b\na b\n\nX!", None, "z"])))
    assert own.shape == (6, quality_crf.OWN) and length.tolist() == [3, 3, 0, 2, 0, 1] and doc.tolist() == [0, 0, 0, 0, 1, 2]
    x = quality_crf.with_neighbours(own, doc)
    assert (x[1, quality_crf.OWN : 2 * quality_crf.OWN] == own[0]).all() and not x[0, quality_crf.OWN : 2 * quality_crf.OWN].any()
    assert not x[4, quality_crf.OWN : 3 * quality_crf.OWN].any()


def test_linkage_equals_plain_means():
    rng = np.random.default_rng(2)
    means = rng.random((9, 30))
    unit = means / np.linalg.norm(means, axis=1, keepdims=True)
    far = 1 - unit @ unit.T
    groups, heights = [[i] for i in range(9)], [1e-9]
    while len(groups) > 1:
        pairs = [(far[np.ix_(groups[a], groups[b])].mean(), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups))]
        h, a, b = min(pairs)
        groups[a] = groups[a] + groups.pop(b)
        heights.append(h)
    states, got = language._linkage(means)
    assert np.allclose(got, heights) and sorted(states[-1][0]) == list(range(9))


def test_decision_equals_a_plain_rule():
    rng = np.random.default_rng(3)
    family = np.array([0, 0, 0, 1, 1])
    pairs = [(0, 1), (0, 2), (1, 2), (3, 4)]
    model = language.LanguageModel(list("abcde"), family, pairs, np.zeros((1, 6)), np.zeros(6))
    margins = rng.normal(size=(200, 6))
    margins[:5, 2:] = 0.0  # ties
    best, score = language.decide(margins, model)
    for row, got in zip(margins, best):
        fam = 0 if row[0] >= row[1] else 1
        votes = {k: 0.0 for k in range(5) if family[k] == fam}
        for m, (a, b) in zip(row[2:], pairs):
            if family[a] == fam:
                votes[a] += (m >= 0) + 1e-3 * np.tanh(m)
                votes[b] += (m < 0) - 1e-3 * np.tanh(m)
        assert got == max(sorted(votes), key=lambda k: votes[k])
    assert ((score >= 0) & (score <= 1)).all()


def test_250_languages(spark):
    """No language is left out, however many there are."""
    rng = random.Random(6)
    rows = []
    for k in range(250):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæ", 9)
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(40)), f"l{k:03d}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs).toPandas().merge(docs.toPandas(), on="doc_id")
    learned = set(got[~got.held_out].lang)
    assert len(learned) == 250 and set(got.lang_pred) == learned
    unseen = got[got.held_out & got.lang.isin(learned)]
    assert (unseen.lang_pred == unseen.lang).mean() > 0.95
