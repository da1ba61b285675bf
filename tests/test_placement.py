"""Placement and pairs beside plain loops: reads of many lengths, repeats, odd letters, pieces that overlap."""

import random

import pytest

from strandlake.operators import placement as pl

READ = "sample string, name string, mate int, seq string"
PIECE = "chrom string, off bigint, seq string"
COMP = str.maketrans("ACGTN", "TGCAN")


def turned(text):
    return text.translate(COMP)[::-1]


def all_hits(text, genome, most):
    found = []
    for strand, q in (("+", text), ("-", turned(text))):
        for chrom, ref in genome.items():
            for p in range(len(ref) - len(q) + 1):
                nm = 0
                for x, y in zip(q, ref[p : p + len(q)]):
                    nm += x != y or x not in "ACGT"
                    if nm > most:
                        break
                if nm <= most:
                    found.append((chrom, p, strand, len(q), nm))
    return found


@pytest.fixture(scope="module")
def world():
    rng = random.Random(21)
    unit = "".join(rng.choice("ACGT") for _ in range(90))
    base = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    genome = {"c1": base(400) + unit + base(200) + "A" * 120 + "ACGTNNACGT" + unit + base(100), "c2": base(300) + unit + turned(unit) + base(77)}
    reads = []
    for k in range(60):
        chrom = rng.choice(["c1", "c2"])
        n1, n2 = rng.choice([(30, 30), (41, 36), (95, 70), (3, 30)])
        s = rng.randrange(0, len(genome[chrom]) - 160)
        pair = [genome[chrom][s : s + n1], turned(genome[chrom][s + 150 - n2 : s + 150])]
        for m in range(2):
            text = list(pair[m])
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice("ACGTN")
            pair[m] = "".join(text)
        if k % 2:
            pair.reverse()
        reads += [("S", f"r{k}", m + 1, t if k % 7 else t.lower()) for m, t in enumerate(pair) if (k, m) != (5, 0)]
    reads += [("S", "poly", 1, "A" * 30), ("S", "poly", 2, "T" * 30), ("S", "none", 1, "N" * 30), ("S", "none", 2, None), ("S", "empty", 1, "")]
    reads += [("T", "r1", m, t) for _, n, m, t in reads if n == "r1"]
    return genome, reads


def pieces(genome, length=140, step=40):
    return [(c, o, g[o : o + length]) for c, g in genome.items() for o in range(0, len(g), step)]


@pytest.mark.parametrize("seed, many", [(14, 1000), (5, 3), (2, 2)])
def test_places_of_reads(spark, world, monkeypatch, seed, many):
    monkeypatch.setattr(pl, "SEED", seed)
    monkeypatch.setattr(pl, "MANY_PLACES", many)
    genome, reads = world
    got = pl.place_reads(spark.createDataFrame(reads, READ), spark.createDataFrame(pieces(genome), PIECE), 2).collect()
    want = sorted((s, n, m, *h) for s, n, m, t in reads if t and len(t) > 2 for h in all_hits(t.upper(), genome, 2))
    assert sorted((r["sample"], r["name"], r["mate"], r["chrom"], r["pos"], r["strand"], r["len"], r["nm"]) for r in got) == want


@pytest.mark.parametrize("smallest, largest", [(0, 200), (100, 150), (0, 45)])
def test_pairs_of_texts_are_those_of_reads(spark, world, smallest, largest):
    genome, reads = world
    frame, ref = spark.createDataFrame(reads, READ), spark.createDataFrame(pieces(genome), PIECE)
    hits = pl.place_reads(frame, ref, 2)
    want = pl.join_mates(hits.filter("mate = 1"), hits.filter("mate = 2"), smallest, largest, frame)
    got = pl.pair_placements(frame, ref, 2, smallest, largest)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_text_with_many_places_is_merged_near_its_partner(spark):
    rows = [("rare", "-", "c", 50_000, 30, 0)] + [("often", "+", "c", 10 * k, 30, k % 3) for k in range(20_000)]
    hits = spark.createDataFrame(rows, "seq string, strand string, chrom string, pos bigint, len int, nm int")
    pairs = spark.createDataFrame([("often", "rare"), ("often", "often")], "seq1 string, seq2 string")
    best = {(r["seq1"], r["seq2"]): r["p"] for r in pl.best_text_pairs(pairs, hits, 0, 500).collect()}
    assert best.keys() == {("often", "rare")}
    at = min(p for p in range(49_530, 50_001, 10) if p // 10 % 3 == 0)
    assert (best["often", "rare"]["s1"], best["often", "rare"]["s2"], best["often", "rare"]["nm"]) == (at, 50_000, 0)


def test_no_reads_and_no_reference(spark):
    reads, ref = spark.createDataFrame([("S", "a", 1, "ACGTACGTAC")], READ), spark.createDataFrame([("c", 0, "ACGTACGTAC")], PIECE)
    assert pl.place_reads(reads.limit(0), ref).count() == 0 and pl.place_reads(reads, ref.limit(0)).count() == 0
    assert [r["flag"] for r in pl.pair_placements(reads, ref.limit(0)).collect()] == [77, 141]


@pytest.mark.parametrize("places", [1e-3, 1e-9])
def test_short_texts_are_looked_up_by_several_parts(spark, world, monkeypatch, places):
    """F1 to F4: one part of a short text stands for a share of all places; positions never go through the driver."""
    plans, kept = [], pl.stage
    monkeypatch.setattr(pl, "PLACES", places, raising=False)
    monkeypatch.setattr(pl, "stage", lambda df, *rest: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, *rest))[1])
    genome, reads = world
    reads = [(s, n, m, t and t[: 18 + len(n) % 3]) for s, n, m, t in reads]
    got = pl.place_reads(spark.createDataFrame(reads, READ), spark.createDataFrame(pieces(genome), PIECE), 2).collect()
    want = sorted((s, n, m, *h) for s, n, m, t in reads if t and len(t) > 2 for h in all_hits(t.upper(), genome, 2))
    assert sorted((r["sample"], r["name"], r["mate"], r["chrom"], r["pos"], r["strand"], r["len"], r["nm"]) for r in got) == want
    assert "shape" in plans[-1] and not any("Broadcast" in p for p in plans if "odd#" in p or "qw#" in p)
