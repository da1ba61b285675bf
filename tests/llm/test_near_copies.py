"""The n-gram join against all pairs, and its parts by themselves."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strandlake.llm import ngram_jaccard as join
from strandlake.llm.components import components
from strandlake.llm.textkit import Texts

SCHEMA = "doc_id long, text string"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def by_all_pairs(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(rng, words, vocabulary, edits):
    w = list(words)
    for _ in range(edits):
        j, kind = rng.randrange(len(w)), rng.random()
        if kind < 0.5:
            w[j] = rng.choice(vocabulary)
        elif kind < 0.75 and len(w) > 1:
            del w[j]
        else:
            w.insert(j, rng.choice(vocabulary))
    return w


def clusters(seed, groups, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 12, 20, 40, 100, 300]))]
        for _ in range(rng.choice(copies)):
            rows.append((len(rows), " ".join(edited(rng, base, vocabulary, rng.randint(0, max(1, len(base) // 18))))))
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in join.link_components(df).collect()}


def test_equals_all_pairs(spark):
    rows = clusters(5, 40, [1, 2, 5, 25])
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "A b"), (n + 4, "a\tB"), (n + 5, "a")]
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_all_pairs(rows)


def test_buckets_larger_than_a_tree(spark, monkeypatch):
    monkeypatch.setattr(join, "TREE_POINTS", 7)
    monkeypatch.setattr(join, "MANY_LOCAL", 3)
    rows = clusters(11, 6, [40])
    assert result(spark.createDataFrame(rows, SCHEMA)) == by_all_pairs(rows)


def test_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == by_all_pairs(rows)


def test_odd_rows(spark):
    text = " ".join(f"x{i}" for i in range(60))
    rows = [(None, text), (7, text), (7, text), (3, text + " y"), (9, None), (9, "other words"), (1, "é" * 50_000)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id)
                  for r in join.link_components(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(True, 0, 56, None), (False, 7, 56, 3), (False, 7, 56, 3), (False, 3, 57, 3), (False, 9, 0, 9),
                          (False, 9, 1, 9), (False, 1, 1, 1)], key=str)
    empty = join.link_components(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x", 2, 3, "y")], "doc_id long, text string, fp string, root int, _gone int, bucket string")
    assert result(df) == {1: (2, 1)}
    assert join.keep_one_of_each(df.drop("_gone")).columns == ["doc_id", "text", "fp", "root", "bucket"]


def sets_of(texts):
    return join.shingle_sets(Texts(pa.array(texts, pa.string())))


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_signature(seed):
    """Whatever the hash groups: sets that link meet."""
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        cut = base[: n - int(rng.integers(0, n // 5 + 1))]
        other = np.concatenate([cut, rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        sig, doc = join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())


def test_trees_find_what_the_bound_allows():
    rng = np.random.default_rng(3)
    base = rng.poisson(4, (5, join.GROUPS))
    points = np.maximum(0, base[rng.integers(0, 5, 300)] + rng.integers(-1, 2, (300, join.GROUPS)) * (rng.random((300, join.GROUPS)) < 0.2))
    sizes, groups = points.sum(axis=1), rng.integers(0, 40, 300)
    for cut in (300, 170):
        left = join.RTree(points[:cut].astype(np.int32), sizes[:cut], groups[:cut])
        right = left if cut == 300 else join.RTree(points[cut:].astype(np.int32), sizes[cut:], groups[cut:])
        i, j = join.tree_pairs(left, right)
        j = j + (0 if cut == 300 else cut)
        overlap = np.minimum(points[:, None], points[None]).sum(axis=2)
        want = join.may_link(overlap, sizes[:, None], sizes[None]) & (groups[:, None] != groups[None])
        want = want if cut == 300 else want[:cut, cut:]
        x, y = np.nonzero(want)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(x.tolist(), (y + (0 if cut == 300 else cut)).tolist()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(300, 200), (200, 300), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {x: 100 for x in range(100, 130)} | {200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, int(rng.integers(1, 3000))).astype(np.uint64)
        sets += [base, base[: len(base) * 9 // 10 + 1], np.concatenate([base, rng.integers(0, 2**63, len(base) // 6).astype(np.uint64)])]
    sizes = np.array([len(x) for x in sets])
    vectors = join.Vectors(join.count_vectors(np.concatenate(sets), sizes))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    allowed = vectors.allowed(i, j, sizes)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) if a // 3 == b // 3 else 0 for a, b in zip(i, j)])
    assert allowed[100 * both >= 80 * (sizes[i] + sizes[j] - both)].all()
    far = both == 0
    assert allowed[far & (sizes[i] > 60) & (sizes[j] > 60)].mean() < 0.01
