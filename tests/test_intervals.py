"""Interval operators against plain Python, with hot spots and long rows."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import intervals as iv
from strandlake.operators import coverage as cov

SCHEMA = "id int, chrom string, s bigint, e bigint"


def make(rng, n, longest, hot=None):
    rows = []
    for i in range(n):
        c = f"chr{rng.randrange(1, 4)}"
        s = rng.randrange(0, 60000)
        if hot is not None and i % 3 == 0:
            c, s = "chr1", hot + rng.randrange(0, 20)
        rows.append((i, c, s, s + rng.randrange(1, longest)))
    return rows


def touch(a, b):
    return a[1] == b[1] and b[2] < max(a[3], a[2] + 1) and a[2] < b[3]


@pytest.fixture(params=[(300, 200), (30000, 300), (200, 30000), (40000, 40000)], ids=str)
def tables(request, spark):
    rng = random.Random(str(request.param))
    a, b = make(rng, 300, request.param[0], hot=16380), make(rng, 60, request.param[1], hot=16384)
    a += [(900, "chr1", 0, 1), (901, "chr2", 59999, 59999), (902, "chr9", 5, 9), (903, "chr1", 16384, 16384)]
    return a, b, spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)


def test_exclude_and_keep_split_the_rows(tables):
    a, b, da, db = tables
    hit = {x[0] for x in a if any(touch(x, y) for y in b)}
    assert {r["id"] for r in iv.keep_overlaps(da, db).collect()} == hit
    assert sorted(r["id"] for r in iv.exclude_overlaps(da, db).collect()) == sorted(x[0] for x in a if x[0] not in hit)
    flagged = {r["id"]: r["hit"] for r in iv.flag_overlaps(da, db).collect()}
    assert flagged == {x[0]: x[0] in hit for x in a}


def test_join_and_counts(tables):
    a, b, da, db = tables
    a = [x for x in a if x[2] < x[3]]
    da = da.filter("s < e")
    pairs = sorted((x[0], y[0]) for x in a for y in b if touch(x, y))
    for width in (64, 2048, 1 << 20):
        assert sorted((r["id"], r["b_id"]) for r in iv.overlap_join(da, db, bin_width=width).collect()) == pairs
    counts = {r["id"]: r["n"] for r in iv.overlap_counts(da, db).collect()}
    assert counts == {x[0]: sum(p[0] == x[0] for p in pairs) for x in a}


def test_merge_is_idempotent_and_disjoint(tables):
    a, b, da, db = tables
    covered = {}
    for _, c, s, e in b:
        covered.setdefault(c, set()).update(range(s, e))
    m = iv.merge_intervals(db)
    rows = m.collect()
    for c, bases in covered.items():
        assert sum(r["e"] - r["s"] for r in rows if r["chrom"] == c) == len(bases)
    assert sorted(map(tuple, iv.merge_intervals(m).collect())) == sorted(map(tuple, rows))
    assert all(r["disjoint"] for r in iv.is_disjoint(m).collect())


def test_empty_b_excludes_nothing(tables):
    a, _, da, db = tables
    assert iv.exclude_overlaps(da, db.filter("false")).count() == len(a)
    assert iv.keep_overlaps(da, db.filter("false")).count() == 0


def test_touching_intervals_merge_but_do_not_overlap(spark):
    df = spark.createDataFrame([(1, "c", 0, 16384), (2, "c", 16384, 20000), (3, "c", 20001, 20002)], SCHEMA)
    assert sorted((r["s"], r["e"]) for r in iv.merge_intervals(df).collect()) == [(0, 20000), (20001, 20002)]
    assert iv.overlapping_rows(df).count() == 0
    assert [(r["s"], r["e"]) for r in iv.merge_intervals(df, gap=1).collect()] == [(0, 20002)]


def test_gap_over_empty_tiles(spark):
    df = spark.createDataFrame([(1, "c", 0, 10), (2, "c", 100000, 100010), (3, "c", 200011, 200020)], SCHEMA)
    got = sorted((r["s"], r["e"]) for r in iv.merge_intervals(df, gap=99990).collect())
    assert got == [(0, 100010), (200011, 200020)]


def test_summit_outside_region_stays(spark):
    peaks = spark.createDataFrame([(1, "c", 100, 200)], SCHEMA)
    tops = spark.createDataFrame([(1, "c", 150, 151)], SCHEMA)
    kept, kept_tops = iv.exclude_peaks_and_summits(peaks, tops, spark.createDataFrame([(9, "c", 190, 300)], SCHEMA))
    assert (kept.count(), kept_tops.count()) == (0, 1)


def test_header_counts_bed_lines(spark):
    header = spark.createDataFrame([(i, f"# line {i}") for i in range(1, 7)], "line_no int, text string")
    bed = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    got = {r["line_no"]: r["text"] for r in iv.rewrite_header(header, bed).collect()}
    assert got == {i: f"# line {i}" for i in (1, 2, 3, 5, 6)} | {4: "# peaks remaining after blacklist filtering 3 "}
    short = header.filter("line_no < 4")
    assert iv.rewrite_header(short, bed).count() == 3


def test_depth_integral_and_hot_position(spark):
    rng = random.Random(5)
    rows = [("S", "c", 500, 650) if i % 3 == 0 else ("S", "c", s := rng.randrange(0, 70000), s + rng.randrange(1, 400)) for i in range(900)]
    df = spark.createDataFrame(rows, "sample string, chrom string, s bigint, e bigint")
    runs = cov.depth(df).collect()
    assert sum((r["e"] - r["s"]) * r["depth"] for r in runs) == sum(e - s for _, _, s, e in rows)
    at = {}
    for r in runs:
        for p in range(r["s"], r["e"]):
            at[p] = r["depth"]
    for p in (0, 500, 649, 650, 16383, 16384, 32768, 69999):
        assert at.get(p, 0) == sum(s <= p < e for _, _, s, e in rows)
    ordered = sorted((r["s"], r["e"], r["depth"]) for r in runs)
    assert all(not (x[1] == y[0] and x[2] == y[2]) for x, y in zip(ordered, ordered[1:]))


def test_cpm_gives_back_counts(spark, sf_dir):
    from strandlake.plans import views as v

    f = v.fragments(spark, sf_dir)
    out = cov.coverage_excluding(f).join(cov.sample_totals(f), "sample")
    assert out.filter(F.abs(F.col("cpm") * F.col("total") / 1e6 - F.col("n")) > 1e-6).count() == 0


def test_rows_of_every_length_and_many_sparse_keys(spark):
    rng = random.Random(9)
    rows, regions = [], []
    for i in range(400):
        c = f"chr{rng.randrange(1, 6)}"
        s = rng.randrange(0, 200_000_000)
        rows.append((i, c, s, s + rng.choice([1, 100, 16384, 16385, 300_000, 5_000_000, 80_000_000])))
        regions.append((i, f"chr{rng.randrange(1, 300)}", t := rng.randrange(0, 240_000_000), t + rng.choice([1, 500, 40_000, 3_000_000])))
    da, db = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(regions, SCHEMA)
    hit = {x[0] for x in rows if any(touch(x, y) for y in regions)}
    assert {r["id"] for r in iv.keep_overlaps(da, db).collect()} == hit
    assert {r["id"]: r["hit"] for r in iv.flag_overlaps(da, db).collect()} == {x[0]: x[0] in hit for x in rows}


def test_overlap_join_over_all_lengths(spark):
    rng = random.Random(12)
    place = lambda: rng.choice([rng.randrange(3000), rng.randrange(10**6), rng.randrange(2 * 10**8)])
    length = lambda: rng.choice([0, 1, 50, 2047, 2048, 2049, 20_000, 150_000, 3_000_000, 200_000_000])
    sides = []
    for n in (150, 120):
        rows = [(k, rng.choice(["c1", "c2"]), place()) for k in range(n)]
        sides.append([(k, c, s, s + length()) for k, c, s in rows] + [(n, None, 5, 9), (n + 1, "c1", 0, 200_000_000)])
    a, b = (spark.createDataFrame(r, "id int, chrom string, s bigint, e bigint") for r in sides)
    want = sorted((x[0], y[0]) for x in sides[0] for y in sides[1] if x[1] and x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    got = iv.overlap_join(a, b)
    assert sorted((r["id"], r["b_id"]) for r in got.collect()) == want
    assert got.columns == ["chrom", "id", "s", "e", "b_id", "b_s", "b_e"]
    assert iv.overlap_join(a, b.limit(0)).count() == 0


def test_an_interval_of_any_length_is_listed_twice_at_most_in_a_level(spark):
    rows = [("c1", 2047, 2049), ("c1", 5, 200_000_000), ("c1", 10**8 - 5, 10**8 + 5)]
    a = spark.createDataFrame(rows, "chrom string, s bigint, e bigint")
    alone = iv._listed(a, "s", "e", 1 << 11, F.array().cast("array<int>"), 1, 1)
    assert all(r["count"] <= 2 for r in alone.groupBy("s").count().collect())
    visits = iv._listed(a, "s", "e", 1 << 11, F.array(F.lit(0), F.lit(2)), 1, 1).filter("_way = 1").groupBy("s", "_lev").count().collect()
    assert all(r["count"] <= 2 for r in visits) and {r["_lev"] for r in visits if r["s"] == 2047} == {0, 2}


def test_overlap_join_meets_lists_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(iv, "CELL_ROWS", 50)
    rng = random.Random(5)
    b_rows = [(k, "c1", s := rng.choice([7, 8, rng.randrange(-3000, 5000)]), s + rng.choice([0, 30, 900, 5000])) for k in range(900)]
    b_rows += [(900, None, 5, 9), (901, "c1", None, 9), (902, "c1", 9, None)]
    a_rows = [(k, rng.choice(["c1", None]), s := rng.randrange(-6000, 6000), s + rng.choice([0, 1, 200, 2500])) for k in range(200)]
    a, b = (spark.createDataFrame(r, "id int, chrom string, s bigint, e bigint") for r in (a_rows, b_rows))
    full = [y for y in b_rows if None not in y]
    want = sorted((x[0], y[0]) for x in a_rows for y in full if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    got = iv.overlap_join(a, b)
    assert sorted((r["id"], r["b_id"]) for r in got.collect()) == want
    right = b.select("chrom", F.col("id").alias("b_id"), F.col("s").alias("b_s"), F.col("e").alias("b_e"))
    lists = iv._in_cells(iv._listed(right, "b_s", "b_e", 1 << 11, None, 1, 2), ["chrom"], ["b_id", "b_s", "b_e"], F.lit(2048).cast("bigint"))
    sizes = [r[0] for r in lists.select(F.size("_list")).collect()]
    assert max(sizes) <= 120 and sum(sizes) > 10 * len(sizes)
    # a pair is a row only once its list is read, after the join
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("inline") < plan.index("Join Inner")


def test_overlap_join_works_out_the_place_of_a_bin_once_a_list(spark):
    a, b = (spark.createDataFrame([("c1", 5, 9, 1)], "chrom string, s bigint, e bigint, id int") for _ in range(2))
    plan = iv.overlap_join(a, b)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("inline")]
    assert "_from" in above and "_lev" not in above and "_bin" not in above


def test_a_hot_bin(spark):
    a = spark.range(3000).select(F.lit("c1").alias("chrom"), F.lit(100).cast("bigint").alias("s"), F.lit(150).cast("bigint").alias("e"), "id")
    b = spark.createDataFrame([("c1", 90, 120, 1), ("c1", 140, 10**8, 2), ("c1", 150, 160, 3)], "chrom string, s bigint, e bigint, x int")
    got = iv.overlap_join(a, b)
    assert {(r["b_x"], r["count"]) for r in got.groupBy("b_x").count().collect()} == {(1, 3000), (2, 3000)}
