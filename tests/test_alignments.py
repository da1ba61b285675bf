"""Pairs, duplicates and order against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import alignments as al

SCHEMA = "sample string, qname string, mate int, chrom string, s bigint, e bigint, strand string, flag int, x0 int"


def filter_by_hand(records, threshold, mode):
    """One pass over name-sorted records, pairing neighbours of equal name."""
    kept, left, held = [], [], None
    for r in records:
        if held is None:
            held = r
        elif held[1] != r[1]:
            left.append(held)
            held = r
        else:
            failed = sum(x[8] is None or x[8] > threshold for x in (held, r))
            if failed <= (1 if mode == "both" else 0):
                kept += [held, r]
            held = None
    return kept, left + ([held] if held else [])


@pytest.mark.parametrize("mode", ["both", "one"])
@pytest.mark.parametrize("threshold", [1, 2])
def test_pair_filter_equals_one_pass(spark, mode, threshold):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        for j in range(rng.choice([1, 2, 2, 2, 3, 4, 5])):
            rows.append(("S", f"q{i:04d}", 1 + j % 2, "chr1", 100 * j, 100 * j + 50, "+", 65 + j, rng.choice([None, 1, 2, 3])))
    rows.sort(key=lambda r: (r[1], r[2], r[7]))
    kept, left = filter_by_hand(rows, threshold, mode)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (r["qname"], r["mate"], r["flag"])
    got = al.x0_pair_filter(df, threshold, mode)
    assert sorted(map(key, got.collect())) == sorted((r[1], r[2], r[7]) for r in kept)
    assert sorted(map(key, al.orphans(df).collect())) == sorted((r[1], r[2], r[7]) for r in left)
    sizes = got.groupBy("qname").count().filter("count % 2 = 1")
    assert sizes.count() == 0
    tagged = {key(r): r["x_fail"] for r in got.collect()}
    for r in kept:
        assert tagged[(r[1], r[2], r[7])] == ("NO_X0" if r[8] is None else "HI_X0" if r[8] > threshold else None)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        al.x0_pair_filter(spark.createDataFrame([], SCHEMA), 1, "any")


def test_duplicates_by_hand(spark):
    """Pairs and single reads, clipped ends, ties by name; one position holds a third of all reads."""
    rng = random.Random(3)
    reads = []
    for i in range(600):
        s = 5000 if i % 3 == 0 else rng.randrange(0, 40) * 10
        clip = rng.choice([0, 0, 5])
        q = chr(33 + rng.choice([10, 20, 30])) * 50
        mates = (1, 2) if rng.random() < 0.8 else (rng.choice([1, 2]),)
        for m in mates:
            a = s + clip if m == 1 else s + 100
            reads.append(dict(sample="S", qname=f"n{i}", mate=m, chrom="chr1", s=a, e=(a + 50 - clip) if m == 1 else a + 50,
                              strand="+" if m == 1 else "-", flag=1 + (64 if m == 1 else 128) + rng.choice([0, 1024]),
                              cigar=f"{clip}S{50 - clip}M" if m == 1 and clip else "50M", qual=q))
    by_name = {}
    for r in reads:
        by_name.setdefault(r["qname"], []).append(r)
    best, units = {}, {}
    for name, rs in by_name.items():
        q = sum(50 * (ord(r["qual"][0]) - 33) if ord(r["qual"][0]) - 33 >= 15 else 0 for r in rs)
        us = [r["s"] - (50 - (r["e"] - r["s"])) for r in rs]
        key = ("pair", min(us), max(r["e"] for r in rs)) if len(rs) == 2 else (
            ("one", rs[0]["strand"], rs[0]["e"] if rs[0]["strand"] == "-" else us[0]))
        units[name] = key
        best[key] = min(best.get(key, (1, "")), (-q, name)) if key in best else (-q, name)
    expected = {(r["qname"], r["mate"]): best[units[r["qname"]]][1] != r["qname"] for r in reads}
    df = spark.createDataFrame(reads, "sample string, qname string, mate int, chrom string, s bigint, e bigint, strand string, flag int, cigar string, qual string")
    got = {(r["qname"], r["mate"]): bool(r["flag"] & 1024) for r in al.mark_duplicates(df).collect()}
    assert got == expected


def test_quality_sum_with_nulls(spark):
    df = spark.createDataFrame([("I5!",), (None,), ("",), ("+++",)], "q string").coalesce(1)
    assert [r[0] for r in df.select(al.quality_sum("q")).collect()] == [60, 0, 0, 0]


def test_coordinate_sort_is_karyotypic(spark):
    rows = [("S", f"q{i}", 1, c, s, s + 1, "+", 0, 1) for i, (c, s) in enumerate(
        [("chr10", 1), ("chr2", 5), ("chrX", 0), ("chr2", 1), ("chrM", 3), ("chrUn_1", 2), ("chrY", 9), ("chr1", 7)])]
    got = [(r["chrom"], r["s"]) for r in al.coordinate_sort(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [("chr1", 7), ("chr2", 1), ("chr2", 5), ("chr10", 1), ("chrX", 0), ("chrY", 9), ("chrM", 3), ("chrUn_1", 2)]


def test_shipped_masks():
    assert al.PRUNE_ATAC == (3, 3340) and al.PRUNE_CHIP_PAIRED == (3, 3852) and al.PRUNE_CHIP_SINGLE == (0, 3844)


def test_tag_is_replaced(spark):
    df = spark.createDataFrame([(1, {"X?": "old"}), (5, {"NM": "0"})], "x0 int, tags map<string,string>")
    got = [r["tags"] for r in al.tag_failures(df, 2).orderBy("x0").collect()]
    assert got == [{}, {"NM": "0", "X?": "HI_X0"}]
