"""Ids against the tokenizer itself, and packed sequences as they must be."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strandlake.llm import packing
from strandlake.llm.queries import op3_packing, vocabulary
from strandlake.llm.textkit import Texts

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(vocabulary())


def test_ids_are_the_tokenizers(encoder):
    rng = random.Random(2)
    bits = list(" \n\t.,'!<|x3éß日🙂　\u0085a\x1ds") + ["'s", "'ll", "  ", "  ", "<|endoftext|>", "word ", " The"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(4000)] + [None, "", " ", "\0 \0a"]
    ids, counts = encoder.encode(Texts(pa.array(texts, pa.string())))
    at = 0
    for t, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)
        at += n


def test_small_memory(encoder, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 10)
    for text in ("one two three", "four five six", "one two three"):
        ids, _ = encoder.encode(Texts(pa.array([text])))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, docs, encoder):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(docs)
    for doc_id, text in docs.items():
        ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:]) and len(own) == -(-len(ids) // 1024)
        start = 0
        for r in own:
            assert r.start == start
            assert r.ids_crc32 == zlib.crc32(np.array(ids[start : start + r.length], "<u4").tobytes())
            start += r.length
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


def test_query(spark, sf_dir, encoder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_packing(spark, sf_dir).collect()
    n = check(rows, docs, encoder)
    assert n <= 1.03 * sum(r.length for r in rows) / 1024 + 1


def test_odd_rows(spark, encoder):
    docs = {1: None, 2: "", 3: "word " * 9000, 4: "x"}
    df = spark.createDataFrame([(k, v, "s", 1) for k, v in docs.items()], "doc_id long, text string, sequence_id string, run int")
    check(packing.pack_documents(df, vocabulary()).collect(), docs, encoder)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], SCHEMA)
    rows = packing.pack_documents(twice, vocabulary()).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), vocabulary()).count() == 0


def test_sequences_hold_their_ids(spark, encoder):
    docs = {1: "alpha beta", 2: "gamma " * 1500, 3: ""}
    df = spark.createDataFrame(list(docs.items()), SCHEMA)
    got = packing.packed_ids(df, packing.pack_documents(df, vocabulary()), vocabulary()).collect()
    want = sorted(i for t in docs.values() for i in encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2])
    assert sorted(i for r in got for i in r.ids) == want and all(len(r.ids) <= 1024 for r in got)


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1024, 600)
    capacity = np.array([1024, 3, 500_000.0])
    number, offset = packing.best_fit(np.minimum(lengths, 700), capacity, rule)
    lengths = np.minimum(lengths, 700)
    for s in np.unique(number):
        own = lengths[number == s]
        assert own.sum() <= 1024 and len(own) <= 3 and (own.astype(float) ** 2).sum() <= 500_000
        order = np.argsort(offset[number == s])
        assert (offset[number == s][order] == np.concatenate([[0], np.cumsum(own[order])[:-1]])).all()
    lengths = rng.integers(1, 700, 600)
    free, _ = packing.best_fit(lengths, np.array([1024, 1024, 1024.0**2]), rule)
    assert free.max() + 1 <= 1.02 * -(-lengths.sum() // 1024) + 1
