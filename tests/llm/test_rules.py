"""Counts of the quality rules against regular expressions, and the guarantee of the cutoffs."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import quality_rules as rules
from strandlake.llm.queries import op5_quality_rules


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    times = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {k for i in range(len(w) - 4) if times[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeated, len(cover)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(texts[r.doc_id])
        assert r.base_failed == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert not (r.kept and r.base_failed)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = op5_quality_rules(spark, sf).collect()
    check(rows, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [r for r in rows if not r.base_failed and quality.get(r.doc_id) is not None]
    assert any(r.failed_rules for r in judged)
    good = [r for r in judged if quality[r.doc_id] == 1]
    bad = [r for r in judged if quality[r.doc_id] == 0]
    assert sum(not r.kept for r in good) <= rules.FALSE_REJECTION * len(good)
    assert sum(not r.kept for r in bad) / len(bad) > 0.3


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: "a b c d e " * 20_000, 4: "\n\nx\nx\n x\n", 5: "é ü 日 " * 4 + "#*$%&|<>"}
    df = spark.createDataFrame([(k, v, None, 1) for k, v in texts.items()],
                               "doc_id long, text string, lang string, stratum int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    check(rules.apply_rules(df, labels).collect(), texts)
    assert rules.apply_rules(df.limit(0), labels).count() == 0
    twice = rules.apply_rules(df.unionAll(df), labels).collect()
    assert len(twice) == 10


@pytest.mark.parametrize("n, p", [(30, 0.05), (400, 0.0125), (1000, 0.3)])
def test_binomial_is_exact(n, p):
    total = 0.0
    for k in range(0, n, max(1, n // 40)):
        total = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert rules.binomial_below(k, n, p) == pytest.approx(total, rel=1e-8, abs=1e-12)
    assert rules.binomial_below(n, n, p) == 1.0


def test_false_rejections_stay_in_the_limit():
    """Of many calibrations few may pick a cutoff whose true rejection is over the limit."""
    rng = np.random.default_rng(5)
    over = 0
    for _ in range(400):
        steps = np.minimum(rng.exponential(20, 600).astype(int), rules.STEPS)
        rejected = np.bincount(steps, minlength=rules.STEPS + 1)[::-1].cumsum()[::-1]
        cut = rules.strictest(rejected, 600, 0.05, 0.05)
        over += cut is not None and math.exp(-cut / 20) > 0.05
    assert over <= 32  # 5 percent and three standard errors
    assert rules.strictest(rejected, 0, 0.05, 0.05) is None


def test_cutoffs_by_stratum(spark):
    rows = [(i, "ab", 0, i % 7, 0, 0) for i in range(900)] + [(1000 + i, "cd", 0, 100, 0, 0) for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, stratum string, symbol_share int, repeat_share int, upper_share int, mark_share int")
    table = table.selectExpr("*", "false as base_failed")
    labels = spark.createDataFrame([(r[0], 1) for r in rows] * 2, "doc_id long, quality int")
    named, found = rules.cutoffs(table, labels)
    assert named == ["ab", "cd"] and "cd" not in found
    assert found["ab"] == {"symbol_share": 1, "repeat_share": 7, "upper_share": 1, "mark_share": 1}


def test_many_strata_are_each_judged_alone(spark):
    """250 labelled strata: none is cut by the cutoffs of others, nor is one without labels."""
    rows = [(i, f"s{i % 249:03}", 0, 0, 0, 0) for i in range(249 * 6)] + [(9000 + i, "zz", 0, 0, 0, 100) for i in range(5)]
    table = spark.createDataFrame(rows, "doc_id long, stratum string, symbol_share int, repeat_share int, upper_share int, mark_share int")
    table = table.selectExpr("*", "false as base_failed")
    named, found = rules.cutoffs(table, spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int"))
    assert len(named) == 250 and found == {}
