"""Removal of repeated strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest

from strandlake.llm import substrings

SCHEMA = "doc_id long, text string"


def by_dictionary(rows):
    first, out = {}, []
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - 49 if i is not None else 0):
            first[b[p : p + 50]] = min(i, first.get(b[p : p + 50], i))
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 49 if i is not None else 0):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, x in zip(b, gone) if not x)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in substrings.remove_repeats(df).collect()), key=str)


def mixed_rows(seed):
    rng = random.Random(seed)
    bits = ["ab", "the ", "x", "é", "\n", "lorem ", "123", "a"]
    passages = ["".join(rng.choices(bits, k=rng.randint(20, 60))) for _ in range(12)] + ["a" * 120, "ab" * 70, "the " * 40]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                parts.append(p[a : a + rng.randint(10, 200)])
            else:
                parts.append("".join(rng.choices(bits, k=rng.randint(1, 30))))
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    return rows


def test_equals_dictionary(spark):
    rows = mixed_rows(4)
    rows += [(1000, rows[3][1]), (1001, None), (1002, ""), (1003, "z" * 49), (1004, "z" * 49), (1005, "z" * 50), (1006, "z" * 51)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_dictionary(rows)


def test_split_anchors(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MANY_CONTEXTS", 1)
    monkeypatch.setattr(substrings, "MANY_LOCAL", 1)
    rows = mixed_rows(9)
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_dictionary(rows)


def test_many_contexts_of_one_document(spark, monkeypatch):
    """An earlier document in another task holds one of the contexts, whichever it is."""
    monkeypatch.setattr(substrings, "MANY_LOCAL", 1)
    rng = random.Random(3)
    early, late = [], []
    for k in range(24):
        passage, *sides = ("".join(rng.choices("abcdefghijklmnop ", k=n)) for n in (60, 70, 70, 70, 70, 70, 70))
        around = [sides[2 * i] + passage + sides[2 * i + 1] for i in range(3)]
        early.append((k, around[k % 3]))
        late.append((100 + k, "".join(around)))
    rows = early + late
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), SCHEMA)
    assert result(df) == by_dictionary(rows)


def test_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = result(docs)
    assert got == by_dictionary(rows) and any(r[2] for r in got)


def test_short_phrases_are_not_compared(spark, monkeypatch):
    """A phrase of 24 bytes that many texts hold has none of their contexts compared, at any number of texts; and the
    packed pairs are judged before the texts are shuffled."""
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    phrase, passage = ("".join(rng.choices(letters, k=n)) for n in (24, 60))
    rows = [(i, "".join(rng.choices(letters, k=80)) + phrase + "".join(rng.choices(letters, k=80))) for i in range(60)]
    rows += [(i, "".join(rng.choices(letters, k=80)) + passage + "".join(rng.choices(letters, k=80))) for i in (70, 71, 72)]
    staged, plans, stage = {}, {}, substrings.stage

    def spy(df, name, *compression):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        staged[name] = stage(df, name, *compression)
        return staged[name]

    monkeypatch.setattr(substrings, "stage", spy)
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_dictionary(rows)
    compared = staged["contexts"].filter("context is not null").select("doc_id").distinct().collect()
    assert {r[0] for r in compared} == {70, 71, 72}
    assert "FlatMapGroupsInArrow" in plans["judged"] and "FlatMapGroupsInArrow" not in plans["contexts"]


def test_odd_rows(spark):
    text = "".join(random.Random(2).choices("abcdefgh ", k=300))
    rows = [(None, text), (5, text), (5, text), (8, "x" + text[:60]), (2, text[100:160] + "q" * 200_000)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_dictionary(rows)
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, "a" * 60, 2, 3)], "doc_id long, text string, ch int, first_id int")
    assert substrings.remove_repeats(clash).first()["n_removed"] == 0


@pytest.mark.parametrize("seed", range(3))
def test_least_ids(seed):
    rng = random.Random(seed)
    bits = ["ab", "a", "\0", "xyz" * 9]
    contexts = [("".join(rng.choices(bits, k=40)) + "a" * 50).encode()[:90] for _ in range(40)]
    ids = np.array([rng.randint(0, 50) for _ in contexts])
    first = {}
    for c, i in zip(contexts, ids.tolist()):
        for p in range(len(c) - 49):
            first[c[p : p + 50]] = min(i, first.get(c[p : p + 50], i))
    for c, least in zip(contexts, substrings.least_ids(contexts, ids)):
        assert least.tolist() == [first[c[p : p + 50]] for p in range(len(c) - 49)]


def test_suffixes_are_sorted():
    rng = np.random.default_rng(0)
    codes = np.concatenate([[0, 3, 3, 1, 3, 3, 1, 0, 3, 3, 1, 0], rng.integers(0, 3, 300), np.full(40, 5), [0]]).astype(np.uint16)
    order = substrings.suffix_array(codes)
    stops = np.flatnonzero(codes == 0)
    tails = [(codes[i : stops[np.searchsorted(stops, i)]].tolist(), i) for i in order.tolist()]
    assert tails == sorted(tails)


@pytest.mark.parametrize("seed", range(3))
def test_strings_of_all_contexts_are_judged_together(seed):
    rng = random.Random(seed)
    contexts = [("".join(rng.choices(["ab", "a", "xyz" * 9], k=40)) + "a" * 50).encode()[:90] for _ in range(60)] + [b"a" * 50, b"b" * 49]
    ids = np.array([rng.randint(-5, 20) for _ in contexts])
    want = []
    for i, least in enumerate(substrings.least_ids(contexts, ids)):
        hit = [False, *(least < ids[i]).tolist(), False]
        begins = [p for p in range(len(least)) if hit[p + 1] and not hit[p]]
        stops = [p + 50 for p in range(len(least)) if hit[p + 1] and not hit[p + 2]]
        want += [(i, s, e) for s, e in zip(begins, stops)]
    assert want and list(zip(*(x.tolist() for x in substrings.repeats(contexts, ids)))) == want


def test_parts_hold_whole_anchors(monkeypatch):
    monkeypatch.setattr(substrings, "ARRAY_BYTES", 100)
    anchor, sizes = np.array([1, 1, 2, 3, 3, 3, 3, 9]), np.array([60, 50, 70, 60, 60, 60, 60, 50])
    assert [(p.start, p.stop) for p in substrings._whole_anchors(anchor, sizes)] == [(0, 2), (2, 7), (7, 8)]
    assert list(substrings._whole_anchors(anchor[:0], sizes[:0])) == []


def test_contexts_are_listed_by_document():
    doc, context = np.array([0, 0, 1, 2]), np.array([5, 7, 5, (1 << 48) - 1], np.uint64)
    lists = [[np.array([7, 9], np.uint64).tobytes(), b""], [], [np.array([(1 << 48) - 1], np.uint64).tobytes()]]
    assert substrings._listed(doc, context, lists).tolist() == [False, True, False, True]
    assert not substrings._listed(doc, context, [[], [b""], []]).any()


def test_ties_go_by_document_and_place():
    rng = np.random.default_rng(0)
    key, doc = rng.integers(0, 300, 1000).astype(np.uint64), rng.integers(-5, 5, 1000)
    key[:400] = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    assert substrings._order(key, doc).tolist() == np.lexsort((doc, key)).tolist()
