"""Profiles around points beside plain loops: crowded and single points, tile edges, ends before 0, two genomes."""

import random

from strandlake.operators import qc


def test_profile_equals_plain_loops(spark):
    """F5, F8, F9: no pair of a run and a point is formed, no table of points is sent to all tasks."""
    rng = random.Random(5)
    place = lambda: (rng.choice(["hg19", "mm10"]), rng.choice(["c1", "c2"]))
    fragments = [(rng.choice(["S", "T", None]), *place(), s, s + rng.randrange(0, 90))
                 for s in [rng.choice([0, 16_300, 32_700]) + rng.randrange(150) for _ in range(300)]]
    fragments += [("U", "hg19", None, 5, 50), ("V", "hg19", "c9", 5, 50)]
    points = [(*place(), rng.choice([-20, 0, 16_300, 32_700]) + rng.randrange(150), rng.choice(["+", "-", None])) for _ in range(120)]
    points += [("mm10", "c1", 16_384, "-")] * 40 + [("hg19", None, 7, "+"), ("hg19", "c2", None, "+")]
    flank = 60
    want = {(f[0], o): 0 for f in fragments for o in range(-flank, flank + 1)}
    for sample, genome, chrom, s, e in fragments:
        for g, c, p, strand in points:
            if (g, c) == (genome, chrom) and p is not None and chrom is not None:
                for x in range(max(s, p - flank), min(e, p + flank + 1)):
                    want[sample, x - p if strand == "+" else p - x] += 1
    got = qc.tss_profile(spark.createDataFrame(fragments, "sample string, genome string, chrom string, s bigint, e bigint"),
                         spark.createDataFrame(points, "genome string, chrom string, s bigint, strand string"), flank)
    assert got.dtypes == [("sample", "string"), ("offset", "bigint"), ("depth", "bigint")]
    assert {(r["sample"], r["offset"]): r["depth"] for r in got.collect()} == want
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
