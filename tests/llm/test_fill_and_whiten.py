"""Fill-in-middle texts beside plain regular expressions; whitening beside numpy over all rows."""

import hashlib
import random
import re

import numpy as np

from strandlake.llm import fill_middle, whitening

ALPHABET = list("abzAZ@[`{ \n\t09<>éßñ漢😀\x00\x7f") + ["<P>", "the", "Wort"]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_equals_plain_expressions(spark):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 3, 7, 8, 9, 15, 16, 17, 40, 300])))) for k in range(900)]
    rows += [(900, None), (901, ""), (None, "abc def"), (None, None), (7, "a b"), (7, "a b"), (5000, "x" * 100_000), (5001, "é x" * 50_000)]
    rows += [(k, t) for k, t in enumerate(["<", "<S", ">", "P>", "<P", "M>a<", "S><"] * 40, 10_000)]  # parts of markers at the cuts
    docs = spark.createDataFrame([(*r, 1, "f", "o") for r in rows], "doc_id long, text string, n int, form string, h1 string")
    want = sorted((plain(*r) for r in rows), key=str)
    assert sorted(map(tuple, fill_middle.fill_in_middle(docs).collect()), key=str) == want
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    digests = sorted(((*plain(*r)[:5], sha(plain(*r)[5]), sha(r[1] or "")) for r in rows), key=str)
    assert sorted(map(tuple, fill_middle.fill_digests(docs).collect()), key=str) == digests
    assert {r.form for r in fill_middle.fill_in_middle(docs).collect()} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_another_epoch_cuts_elsewhere(spark):
    docs = spark.createDataFrame([(k, "one two three four five six") for k in range(50)], "doc_id long, text string")
    one, two = ({r.doc_id: r.output for r in fill_middle.fill_in_middle(docs, epoch=e).collect()} for e in (1, 2))
    assert one != two


def numpy_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    v = y.T @ y / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    return ((n * x - total) ** 2).sum(axis=1), y @ axes / np.sqrt(values), values / np.trace(v)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = np.float32(rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40)))
    vectors[100:200] = vectors[7]  # a third of all rows is one vector
    rows = [(int(k), v.tolist()) for k, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whitening_report(frame).toPandas()
    deviation, white, explained = numpy_whitening(vectors)
    assert len(got) == 300 * 32 and set(got.n) == {300} and set(got.component) == set(range(1, 33))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((wide * white).sum(axis=0))
    assert np.abs(wide * signs - white).max() < 1e-9
    assert (got.groupby("vec_id").deviation.first().to_numpy() == deviation).all()
    assert np.abs(got.groupby("component").explained.first().to_numpy() / explained - 1).max() < 1e-9
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    once = whitening.whiten(frame, weighting="one").toPandas()
    distinct = np.unique(vectors, axis=0)
    assert set(once.n) == {len(distinct)}
    _, _, of_one = numpy_whitening(distinct)
    assert np.abs(once.groupby("component").explained.first().to_numpy() / of_one - 1).max() < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [3.0, 5.0]),
            (None, [0.0, 0.0]), (7, []), (8, [1.0]), (9, [1e30, 2.0]), (10, [4.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<float>, x string, white int, weight int")
    got = whitening.whitening_report(frame).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == sorted(
        [(k, c, 5) for k in ("1", "1", "6", "None", "10") for c in (1, 2)] + [("8", 1, 1)])
    alone = next(r for r in got if r.vec_id == 8)
    assert alone.whitened is None and alone.explained == 0 and alone.deviation == 0
    assert whitening.whitening_report(frame.limit(0)).collect() == []
    # sums beyond a long stay exact in the operator and are null in the report
    far = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 5.0])], "vec_id long, embedding array<double>")
    x = [[int(64e9) + 10**6, 10**6], [-int(64e9) + 10**6, 10**6 + 320]]
    total = [a + b for a, b in zip(*x)]
    exact = {k: sum((2 * v - s) ** 2 for v, s in zip(row, total)) for k, row in enumerate(x, 1)}
    assert {r.vec_id: int(r.deviation) for r in whitening.whiten(far).collect()} == exact
    assert {r.deviation for r in whitening.whitening_report(far).collect()} == {None}
