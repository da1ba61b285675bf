"""Rows that went wrong before: cuts, mixed samples, strand order, single reads, controls without tags."""

from pyspark.sql import functions as F

from strandlake import session, sinks
from strandlake.operators import alignments as al, coverage as cov, intervals as iv, peaks as pk, placement as pl
from strandlake.operators import qc, reads as rd, tags as tg
from strandlake.plans import trunk, views as v
from strandlake.sources import genomic as gs

READ = "sample string, qname string, mate int, chrom string, s bigint, e bigint, strand string, flag int, tlen bigint, qual string"


def test_reads_of_unlisted_lengths_are_placed(spark):
    seqs = spark.createDataFrame([("chr1", 0, "ACGTTGCAAGGCTTAACCGGATCGATTTACG")], "chrom string, off bigint, seq string")
    reads = spark.createDataFrame(
        [("S", "a", 1, "TTGCAAGGCTTAACCGGATC"), ("S", "b", 1, "TTGCAAGGCTTAACCGGATCG"), ("S", "c", 1, "N" * 20), ("S", "d", 1, "")],
        "sample string, name string, mate int, seq string")
    assert {r["name"] for r in pl.place_reads(reads, seqs).collect()} == {"a", "b"}
    best = {r["name"]: r for r in pl.best_placements(reads, seqs).collect()}
    assert best["a"]["pos"] == 3 and best["b"]["pos"] == 3 and best["c"]["pos"] is None and best["d"]["pos"] is None
    rows = {r["qname"]: r["flag"] for r in pl.single_alignments(pl.best_placements(reads, seqs)).collect()}
    assert rows == {"a": 0, "b": 0, "c": 4, "d": 4}


def test_templates_without_a_hit_stay(spark):
    hits = spark.createDataFrame([], "sample string, name string, mate int, chrom string, pos bigint, strand string, len int, nm int")
    names = spark.createDataFrame([("S", "t"), ("S", "t")], "sample string, name string")
    rows = pl.join_mates(hits, hits, templates=names).collect()
    assert sorted((r["mate"], r["flag"]) for r in rows) == [(1, 1 | 4 | 8 | 64), (2, 1 | 4 | 8 | 128)]


def test_single_reads_give_a_track(spark):
    rows = [("S", f"r{i}", 1, "chr1", 100 * i, 100 * i + 50, "+-"[i % 2], 16 * (i % 2), 0, "I" * 50) for i in range(20)]
    reads = spark.createDataFrame(rows, READ)
    pruned = trunk.prune_chip_single(reads, "hg38")
    wide, narrow = trunk.track(pruned, length=150), trunk.track(pruned)
    assert wide.agg(F.sum("n")).first()[0] > narrow.agg(F.sum("n")).first()[0] > 0
    got = {r["qname"]: (r["s"], r["e"]) for r in cov.extend_reads(pruned, unpaired=150).collect()}
    assert got["r0"] == (0, 150) and got["r3"] == (200, 350)


def test_mixed_layouts_in_one_study(spark):
    rows = [("P", "p", 1, "chr1", 100, 150, "+", 1 | 2 | 64, 200, "I" * 50), ("P", "p", 2, "chr1", 250, 300, "-", 1 | 2 | 128 | 16, -200, "I" * 50),
            ("U", "u", 1, "chr1", 100, 150, "+", 0, 0, "I" * 50)]
    got = {r["sample"]: (r["s"], r["e"]) for r in trunk.whole_fragments(spark.createDataFrame(rows, READ), 120).collect()}
    assert got == {"P": (100, 300), "U": (100, 220)}


def test_copies_read_from_the_other_end(spark):
    rows = [("S", "a", 1, "chr1", 100, 150, "+", 1 | 64, 200, "I" * 50), ("S", "a", 2, "chr1", 250, 300, "-", 1 | 128, 200, "I" * 50),
            ("S", "b", 2, "chr1", 100, 150, "+", 1 | 128, 200, "#" * 50), ("S", "b", 1, "chr1", 250, 300, "-", 1 | 64, 200, "#" * 50)]
    marked = al.mark_duplicates(spark.createDataFrame(rows, READ))
    assert {(r["qname"], bool(r["flag"] & 1024)) for r in marked.collect()} == {("a", False), ("b", True)}


def test_equal_names_in_two_samples(spark):
    reads = spark.createDataFrame([("a", "r", 1), ("b", "r", 2), ("c", "r", 1), ("c", "r", 2)], "sample string, name string, mate int")
    parts = {(r["sample"], r["mate"]): r["part"] for r in rd.split_mates(reads).collect()}
    assert parts == {("a", 1): "single", ("b", 2): "single", ("c", 1): "1", ("c", 2): "2"}
    names = spark.createDataFrame([("a", "r")], "sample string, name string")
    assert {r["sample"] for r in rd.subset_reads(reads, names).collect()} == {"a"}
    found = al.distinct_names(reads.withColumnRenamed("name", "qname"))
    assert found.columns == ["sample", "qname"] and found.count() == 3


def test_control_without_tags_keeps_the_peaks(spark):
    tags = spark.createDataFrame([("S1", "chr1", 100, "+", 20)], "sample string, chrom string, p bigint, strand string, n bigint")
    peaks = spark.createDataFrame([("S1", "chr1", 0, 200, 100, 20)], "sample string, chrom string, s bigint, e bigint, p bigint, tags bigint")
    kept = tg.control_filter(peaks, tags, tags.limit(0)).collect()
    assert len(kept) == 1 and kept[0]["fold"] is None


def test_sample_without_points_has_a_flat_profile(spark):
    frags = spark.createDataFrame([("A", "chr1", 990, 1100), ("B", "chr2", 0, 50)], "sample string, chrom string, s bigint, e bigint")
    tss = spark.createDataFrame([("chr1", 1000, 1000, "+")], "chrom string, s bigint, e bigint, strand string")
    rows = qc.tss_profile(frags, tss, 10).collect()
    assert {r["sample"]: None for r in rows}.keys() == {"A", "B"} and sum(r["sample"] == "B" for r in rows) == 21
    assert {r["depth"] for r in rows if r["sample"] == "B"} == {0}


def test_local_rate_without_a_control_is_the_samples_own(spark):
    bins = spark.createDataFrame([(s, "chr1", b, 3, 75) for s in ("S1", "S2") for b in (1, 2, 500)],
                                 "sample string, chrom string, bin bigint, k bigint, bases bigint")
    control = bins.filter("sample = 'S1'")
    lam = pk.local_lambda(bins, pk.background(bins, 1e9), control=control, control_rates=pk.background(control, 1e9))
    by = {(r["sample"], r["bin"]): r["lam"] for r in lam.collect()}
    assert by[("S2", 1)] == by[("S1", 1)] > by[("S2", 500)] > 1e-6


def test_contigs_are_numbered_in_order(spark):
    rows = [("S", "chrUn_a", 0, 10), ("S", "chrUn_b", 0, 10), ("S", "chrUn_a", 50, 60), ("S", "chr2", 5, 9)]
    got = pk.number_rows(spark.createDataFrame(rows, "sample string, chrom string, s bigint, e bigint"), ["sample"])
    assert {(r["chrom"], r["s"]): r["n"] for r in got.collect()} == {("chr2", 5): 1, ("chrUn_a", 0): 2, ("chrUn_a", 50): 3, ("chrUn_b", 0): 4}


def test_rows_without_a_chromosome(spark):
    a = spark.createDataFrame([(None, 1, 2, "x"), ("chr1", 1, 2, "y"), ("chr1", 50, 60, "z")], "chrom string, s bigint, e bigint, id string")
    b = spark.createDataFrame([("chr1", 0, 10)], "chrom string, s bigint, e bigint")
    assert {r["id"] for r in iv.exclude_overlaps(a, b).collect()} == {"x", "z"}
    assert {r["id"] for r in iv.keep_overlaps(a, b).collect()} == {"y"}
    assert {(r["id"], r["hit"]) for r in iv.flag_overlaps(a, b).collect()} == {("x", False), ("y", True), ("z", False)}


def test_regions_across_stretches(spark):
    step = iv.STRETCH
    b = spark.createDataFrame([("chr1", k * step + 7, k * step + 20) for k in (0, 1, 2, 9)], "chrom string, s bigint, e bigint")
    rows = [("chr1", k * step + d, k * step + d + 5 + 3 * step * (d == 30), f"{k}.{d}") for k in range(10) for d in (1, 8, 30)]
    a = spark.createDataFrame(rows, "chrom string, s bigint, e bigint, id string")
    want = {i for c, s, e, i in rows if not any(x < e and s < y for x, y in ((k * step + 7, k * step + 20) for k in (0, 1, 2, 9)))}
    assert {r["id"] for r in iv.exclude_overlaps(a, b).collect()} == want


def test_parts_of_a_fastq_file_are_one_file(spark, tmp_path):
    reads = spark.createDataFrame([("f", i, f"r{i}", "ACGT", "IIII") for i in range(500)], "file string, idx bigint, name string, seq string, qual string")
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        sinks.write_fastq(reads, str(tmp_path / "q"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])
    assert len(list((tmp_path / "q" / "file=f").glob("part-*.gz"))) > 1
    back = gs.read_fastq(spark, str(tmp_path / "q"), F.regexp_extract("path", r"/file=([^/]+)/", 1)).collect()
    assert sorted((r["idx"], r["name"]) for r in back) == [(i, f"r{i}") for i in range(500)]


def test_chip_study(spark, sf_dir):
    """Samples of two genomes, two parameter sets, centred tags, motifs on the kept peaks."""
    reads = v.alignments(spark, sf_dir)
    sheet = spark.createDataFrame([("S1", "mm10", "S3"), ("S2", "hg19", "S3"), ("S3", "mm10", None)], "sample string, genome string, input string")
    excluded = spark.createDataFrame([("hg19", f"chr{c}", 0, 100_000) for c in range(1, 6)], "genome string, chrom string, s bigint, e bigint")
    sequences = spark.createDataFrame([(f"chr{c}", 0, "ACGTTGCA" * 30_000) for c in range(1, 6)], "chrom string, off bigint, seq string")
    sets = {"loose": {"fold": 0.5, "threshold": 3}, "tight": {"fold": 0.5, "threshold": 6}}
    out = trunk.chip_study(reads, sheet, excluded, sets, sequences, 240_000, max_dist=300, word=4)
    n = {(r["paramset"], r["genome"]): r["n"] for r in out["all"].groupBy("paramset", "genome").agg(F.count("*").alias("n")).collect()}
    left = {(r["paramset"], r["genome"]): r["n"] for r in out["peaks"].groupBy("paramset", "genome").agg(F.count("*").alias("n")).collect()}
    assert n[("tight", "mm10")] <= n[("loose", "mm10")] and left[("loose", "mm10")] == n[("loose", "mm10")]
    assert left.get(("loose", "hg19"), 0) < n[("loose", "hg19")]
    fourth = {(r["paramset"], r["sample"]): r["text"] for r in out["header"].filter("line_no = 4").collect()}
    assert fourth[("loose", "S1")] == f"# peaks remaining after blacklist filtering {left[('loose', 'mm10')]} "
    assert out["track"].count() > 0 and out["lengths"].count() == 3 and out["motifs"].columns[:3] == ["paramset", "sample", "rank"]
    ranks = out["motifs"].groupBy("paramset", "sample").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count("*").alias("n")).collect()
    assert all(r["a"] == 1 and r["b"] == r["n"] for r in ranks)


def test_intermediates_can_be_dropped(spark):
    kept, session._staged[:] = list(session._staged), []
    staged = session.stage(spark.range(3), "x")
    assert staged.count() == 3 and session.drop_staged(spark) == 1 and not session._staged
    session._staged[:] = kept


def test_reads_of_all_samples_are_listed_at_once(spark, tmp_path):
    import pytest

    from strandlake.sources.tables import list_sample_reads

    for s in ("a", "b"):
        (tmp_path / s).mkdir()
        for m in (1, 2):
            (tmp_path / s / f"{s}_R{m}.fastq.gz").touch()
    rows = list_sample_reads(spark, {"x": str(tmp_path / "a"), "y": str(tmp_path / "b")}).collect()
    assert [(r["sample"], r["path"].rsplit("/", 1)[-1]) for r in rows] == [
        ("x", "a_R1.fastq.gz"), ("x", "a_R2.fastq.gz"), ("y", "b_R1.fastq.gz"), ("y", "b_R2.fastq.gz")]
    with pytest.raises(FileNotFoundError):
        list_sample_reads(spark, {"x": str(tmp_path)})
    with pytest.raises(ValueError):
        list_sample_reads(spark, {})
