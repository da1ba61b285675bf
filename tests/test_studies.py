"""Whole analyses on the derived tables."""

from pyspark.sql import functions as F

from strandlake.plans import trunk, views as v


def test_atac_study(spark, sf_dir):
    out = trunk.atac_study(
        v.alignments(spark, sf_dir), "mm10", 1e6, v.excluded(spark, sf_dir), v.tss(spark, sf_dir), {"default_params": {}, "strict": {"q": 1e-4}})
    assert {r["sample"] for r in out["metrics"].collect()} == {"S1", "S2", "S3"}
    sets = {r["paramset"]: r["n"] for r in out["all"].groupBy("paramset").agg(F.count("*").alias("n")).collect()}
    assert sets["strict"] < sets["default_params"]
    assert out["peaks"].count() <= out["all"].count() and out["track"].count() > 0
    bad = out["all"].filter("offset < 0 or s + offset >= e or signal <= 1 or qscore <= 1.3")
    assert bad.count() == 0


def test_chip_study_histone(spark, sf_dir):
    sheet = spark.createDataFrame([("S1", "mm10", "S3"), ("S2", "mm10", None), ("S3", "mm10", None)], "sample string, genome string, input string")
    pruned = trunk.prune_chip_single(v.alignments(spark, sf_dir), "mm10")
    peaks = trunk.chip_peaks(pruned, sheet, v.excluded(spark, sf_dir), "histone", 0.5, width=500, min_dist=1000, threshold=3)
    assert {r["sample"] for r in peaks.select("sample").distinct().collect()} == {"S1"}


SINGLE = ~(0x1 | 0x2 | 0x8 | 0x20)


def mixed(spark, sf_dir):
    """S3's reads as those of a single-end run."""
    reads = v.alignments(spark, sf_dir)
    flag = F.col("flag").cast("int")
    return reads.withColumn("flag", F.when(F.col("sample") == "S3", flag.bitwiseAND(F.lit(SINGLE))).otherwise(flag))


def test_layouts_are_pruned_by_their_own_rules(spark, sf_dir):
    reads = mixed(spark, sf_dir)
    key = ["sample", "qname", "mate", "chrom", "s", "flag"]
    got = sorted(map(tuple, trunk.prune_chip(reads, "mm10").select(*key).collect()))
    pairs = trunk.prune_chip_paired(reads.filter("sample <> 'S3'"), "mm10").select(*key)
    singles = trunk.prune_chip_single(reads.filter("sample = 'S3'"), "mm10").select(*key)
    assert got == sorted(map(tuple, pairs.unionByName(singles).collect()))
    assert {r[0] for r in got} == {"S1", "S2", "S3"}


def test_chip_study_of_mixed_layouts(spark, sf_dir):
    """Every sample is in track and peaks; motifs come from each sample's own bases; thresholds from a rate."""
    sheet = spark.createDataFrame(
        [("S1", "mm10", "S2"), ("S2", "mm10", None), ("S3", "hg19", "S2")], "sample string, genome string, input string")
    excluded = spark.createDataFrame([("hg19", "chr9", 0, 1)], "genome string, chrom string, s bigint, e bigint")
    bases = [("mm10", "ACGTTGCA"), ("hg19", "TTTTCCCC")]
    sequences = spark.createDataFrame(
        [(g, f"chr{c}", 0, unit * 30_000) for g, unit in bases for c in range(1, 6)], "genome string, chrom string, off bigint, seq string")
    sets = {"loose": {"fold": 0.2, "threshold": 3}, "rate": {"fold": 0.2, "fdr": 0.5, "genome_size": 1e6}}
    out = trunk.chip_study(mixed(spark, sf_dir), sheet, excluded, sets, sequences, 240_000, length=150, max_dist=300, word=4)
    assert {r["sample"] for r in out["track"].select("sample").distinct().collect()} == {"S1", "S2", "S3"}
    found = {(r["paramset"], r["sample"]) for r in out["peaks"].select("paramset", "sample").distinct().collect()}
    assert {("loose", "S1"), ("loose", "S3")} <= found
    words = {}
    for r in out["motifs"].collect():
        words.setdefault(r["sample"], set()).add(r["kmer"])
    own = {"S1": "ACGTTGCA" * 2, "S3": "TTTTCCCC" * 2}
    comp = str.maketrans("ACGT", "TGCA")
    for sample, kmers in words.items():
        held = {own[sample][i : i + 4] for i in range(8)}
        assert kmers <= {min(w, w.translate(comp)[::-1]) for w in held}


def test_effective_sizes_by_genome(spark):
    from strandlake.operators import peaks as pk

    sheet = spark.createDataFrame([("a", "hg38"), ("b", "mm10"), ("c", "hg19")], "sample string, genome string")
    assert {tuple(r) for r in pk.effective_sizes(sheet).collect()} == {("a", 2.7e9), ("b", 1.87e9), ("c", 2.7e9)}


def test_atac_study_of_two_genomes(spark, sf_dir):
    """Points, excluded regions, chromosomes and effective sizes by genome."""
    sheet = spark.createDataFrame([("S1", "hg19"), ("S2", "mm10"), ("S3", "mm10")], "sample string, genome string")
    reads = trunk.with_genomes(v.alignments(spark, sf_dir), sheet)
    tss = v.tss(spark, sf_dir).withColumn("genome", F.lit("mm10"))
    excluded = v.excluded(spark, sf_dir).withColumn("genome", F.lit("hg19"))
    out = trunk.atac_study(reads, None, None, excluded, tss, {"p": {"q": 0.05}})
    score = {r["sample"]: r["tss_enrichment"] for r in out["metrics"].collect()}
    assert score.keys() == {"S1", "S2", "S3"} and score["S1"] is None and score["S2"] is not None


def test_alignments_are_not_shuffled_to_find_their_genome(spark):
    """few samples would be as many tasks."""
    from strandlake.plans.trunk import with_genomes

    rows = spark.range(1000).selectExpr("concat('S', id % 3) as sample", "id")
    sheet = rows.select("sample").distinct().selectExpr("sample", "if(sample = 'S1', 'hg19', 'mm10') as genome")
    out = with_genomes(rows, sheet)
    assert "hashpartitioning(sample" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.groupBy("genome").count().collect().__len__() == 2 and out.count() == 1000
