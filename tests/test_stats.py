"""Tail probabilities, q-values and placement against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions.ranking import row_index
from strandlake.functions.stats import binomial_score, log_factorial, poisson_score
from strandlake.operators import peaks as pk, placement as pl, tags as tg


def poisson_by_hand(k, lam):
    logs = [j * math.log(lam) - lam - math.lgamma(j + 1) for j in range(k, k + 20000)]
    top = max(logs)
    return -(top + math.log(math.fsum(math.exp(x - top) for x in logs))) / math.log(10)


def test_log_factorial(spark):
    ks = [0, 1, 2, 3, 10, 170, 1000, 10**6, 10**9]
    got = spark.createDataFrame([(k,) for k in ks], "k bigint").select("k", log_factorial(F.col("k")).alias("v")).collect()
    for r in got:
        assert r["v"] == pytest.approx(math.lgamma(r["k"] + 1), rel=1e-11, abs=1e-9)


def test_poisson_score(spark):
    cases = [(1, 0.1), (3, 2.9), (50, 1.0), (120, 100.0), (2100, 2000.0), (5000, 2000.0), (101, 100.9)]
    got = spark.createDataFrame(cases, "k int, lam double").select("k", "lam", poisson_score(F.col("k"), F.col("lam")).alias("v")).collect()
    for r in got:
        assert r["v"] == pytest.approx(poisson_by_hand(r["k"], r["lam"]), abs=1e-6)


def test_binomial_score(spark):
    cases = [(5, 10, 0.2), (40, 100, 0.3), (10, 10, 0.5), (600, 5000, 0.1)]
    got = spark.createDataFrame(cases, "h int, n int, p double").select("h", "n", "p", binomial_score(F.col("h"), F.col("n"), F.col("p")).alias("v")).collect()
    for r in got:
        h, n, q = r["h"], r["n"], r["p"]
        exact = math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(q) + (n - i) * math.log(1 - q))
            for i in range(h, min(n, h + 400) + 1))
        assert r["v"] == pytest.approx(-math.log10(exact), abs=1e-6)


def test_bh_scores(spark):
    rng = random.Random(2)
    values = sorted({round(rng.expovariate(0.3), 3) for _ in range(300)} | {0.0})
    rows = [("S", v, rng.randrange(1, 50)) for v in values]
    got = {r["score"]: r["qscore"] for r in pk.bh_scores(spark.createDataFrame(rows, "sample string, score double, weight bigint")).collect()}
    total, rank, t = sum(w for *_, w in rows), 0, {}
    for _, v, w in reversed(rows):
        rank += w
        t[v] = v + math.log10(rank) - math.log10(total)
    best = 0.0
    for v in values:
        best = max(best, t[v])
        assert got[v] == pytest.approx(best, abs=1e-9)


def test_row_index_over_ranges(spark):
    rng = random.Random(4)
    keys = rng.sample(range(500000), 2000)
    df = spark.createDataFrame([("a" if k % 3 else "b", k) for k in keys], "f string, k bigint")
    got = {(r["f"], r["k"]): r["idx"] for r in row_index(df, ["f"], "k", width=4096).collect()}
    for f in "ab":
        for i, k in enumerate(sorted(k for k in keys if ("a" if k % 3 else "b") == f)):
            assert got[(f, k)] == i


def test_autocorrelation_across_tiles(spark):
    rng = random.Random(6)
    rows = [("S", "c", p, st, rng.randrange(1, 4)) for p in rng.sample(range(3000), 300) for st in "+-"]
    df = spark.createDataFrame(rows, "sample string, chrom string, p bigint, strand string, n bigint")
    same, opposite = {}, {}
    for _, _, p, st, n in rows:
        for _, _, q, su, m in rows:
            if 0 <= q - p <= 50:
                if st == su and q > p:
                    same[q - p] = same.get(q - p, 0) + n * m
                if st == "+" and su == "-":
                    opposite[q - p] = opposite.get(q - p, 0) + n * m
    for r in tg.tag_autocorrelation(df, 50, tile=128).collect():
        d = r["distance"]
        assert (r["same"], r["opposite"]) == (same.get(d, 0), opposite.get(d, 0))


def test_placement_by_hand(spark):
    rng = random.Random(8)
    genome = "".join(rng.choice("ACGT") for _ in range(700)) + "A" * 60 + "ACGTN" * 4
    comp = str.maketrans("ACGTN", "TGCAN")
    reads = []
    for i in range(60):
        n = rng.choice([24, 40])
        p = rng.randrange(0, len(genome) - n)
        text = list(genome[p:p + n])
        for _ in range(rng.choice([0, 1, 2, 3])):
            text[rng.randrange(n)] = rng.choice("ACGTN")
        text = "".join(text)
        reads.append(("S", f"r{i}", 1, text.translate(comp)[::-1] if i % 2 else text))
    expected = set()
    for s, name, m, seq in reads:
        for strand, q in (("+", seq), ("-", seq.translate(comp)[::-1])):
            for p in range(len(genome) - len(q) + 1):
                nm = sum(x != y or x not in "ACGT" for x, y in zip(q, genome[p:p + len(q)]))
                if nm <= 2:
                    expected.add((name, p, strand, nm))
    chunks = [("c", o, genome[o:o + 100 + 39]) for o in range(0, len(genome), 100)]
    hits = pl.place_reads(spark.createDataFrame(reads, "sample string, name string, mate int, seq string"),
                          spark.createDataFrame(chunks, "chrom string, off bigint, seq string"), 2)
    got = [(r["name"], r["pos"], r["strand"], r["nm"]) for r in hits.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    best = {r["name"]: r for r in pl.best_hits(hits).collect()}
    for name in {x[0] for x in expected}:
        mine = [x for x in expected if x[0] == name]
        nm = min(x[3] for x in mine)
        top = sorted(x[1:] for x in mine if x[3] == nm)
        assert best[name]["x0"] == len(top) and (best[name]["pos"], best[name]["strand"], best[name]["nm"]) == top[0]


def test_peak_heights_and_summit(spark):
    rows = [("S", "chr1", 1000 + i, 1200 + i) for i in range(0, 100, 2)] + [("S", "chr1", 5000 * i, 5000 * i + 100) for i in range(1, 30)]
    f = spark.createDataFrame(rows, "sample string, chrom string, s bigint, e bigint")
    scored = pk.scored_pileup(f, 1e6)
    peaks = pk.summits(pk.call_peaks(scored), f).collect()
    (p,) = [x for x in peaks if x["height"] > 1]
    assert p["height"] == 50 and p["summit"] == (1098 + 1200) // 2 and p["s"] <= 1000 and p["e"] >= 1298 - 25
