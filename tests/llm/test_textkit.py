"""Words, lines and span hashes against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from strandlake.llm.textkit import Chars, SpanHash, Texts, fit_logistic, logistic, slices, small_batches

ODD = st.lists(st.one_of(st.none(), st.text(alphabet=" \n\t\x0b\x0c\r\x1c\u0085 abé日🙂.", max_size=12)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_words_and_lines(values):
    texts = Texts(pa.array(values, pa.string()))
    raw = texts.data.tobytes()
    s, e, d = texts.words()
    got = [(int(k), raw[a:b].decode()) for a, b, k in zip(s, e, d)]
    assert got == [(k, w) for k, t in enumerate(values) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    s, e, d = texts.lines()
    got = [(int(k), raw[a:b].decode()) for a, b, k in zip(s, e, d)]
    assert got == [(k, x) for k, t in enumerate(values) for x in (t or "").split("\n")]


def test_spans_hash_by_content():
    texts = Texts(pa.array(["abcabc", "xxabc", "abc"]))
    h = SpanHash(texts.data)
    assert len(set(h.of(np.array([0, 3, 8, 11]), np.array([3, 6, 11, 14])).tolist())) == 1
    assert len(set(h.windows(3).tolist())) > 3
    assert (h.windows(3)[[0, 3]] == h.windows(3)[8]).all()


def test_slices_cover_a_batch():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 100, "", "c"])})
    parts = list(slices(batch, limit=20))
    assert sum(len(p) for p in parts) == 5
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert not list(slices(batch.slice(0, 0)))


def test_grams_stay_within_a_text():
    chars = Chars(pa.array(["Ab", None, "é\tz"]))
    at, h = chars.grams(3, 20)
    assert len(at) == 2 + 3  # " ab ", "  " has none, " é z "
    assert len(set(h.tolist())) == 5


def test_logistic_regression_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    beta, bias = fit_logistic(x, y, np.ones(400), l2=1e-4, steps=500)
    assert ((logistic(x @ beta + bias) > 0.5) == (y == 1)).mean() > 0.97


def test_batch_limit(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name)
    try:
        for given, want in (("64m", "4194304b"), ("1m", "1m"), ("67108864b", "4194304b"), ("100b", "100b")):
            spark.conf.set(name, given)
            small_batches(spark)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, old)
