"""FASTQ, SAM and FASTA text, and chunking by position."""

import gzip

import pytest
from pyspark.sql import functions as F

from strandlake.operators import reads as rd
from strandlake.sources import genomic as gs
from strandlake.sources.text import numbered_lines


def chunks_by_hand(n, d, lane):
    """The rule as stated: record i opens a file when i mod d = 1 and at least d records follow."""
    out, current = [], lane - 1
    for i in range(1, n + 1):
        if d and i % d == 1 and n - i >= d:
            current += 1
        out.append(current)
    return out


def test_split_reads_equals_the_rule(spark):
    for d in (1, 2, 3, 5, 7, 24):
        sizes = list(range(1, 60, 3)) + [10, 11]
        rows = [(str(n), i) for n in set(sizes) for i in range(n)]
        df = spark.createDataFrame(rows, "file string, idx bigint")
        got = {}
        for r in rd.split_reads(df, "s", 1, lane=3, per_file=d).collect():
            got.setdefault(int(r["file"]), {})[r["idx"]] = r["lane"]
        for n in set(sizes):
            assert [got[n][i] for i in range(n)] == chunks_by_hand(n, d, 3), (n, d)


def test_ten_reads_by_five_is_one_chunk(spark):
    df = spark.range(10).select(F.lit("f").alias("file"), F.col("id").alias("idx"))
    assert {r["out_file"] for r in rd.split_reads(df, "x", 2, per_file=5).collect()} == {"x_L001_R2.fastq"}
    with pytest.raises(ValueError):
        rd.split_reads(df, "x", 1)


def test_fastq_in_many_splits(spark, tmp_path):
    """Plain FASTQ read in small splits keeps its records, quality lines that begin with @ too."""
    n = 3000
    text = "".join(f"@r{i} x\nACGT{'A' * (i % 50)}\n+\n@{'I' * (3 + i % 50)}\n" for i in range(n))
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(tmp_path / "a.fastq")).rdd.getNumPartitions() > 5
        got = gs.read_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 2 * n
    for r in got:
        i = r["idx"]
        assert (r["name"], r["seq"], r["qual"]) == (f"r{i} x", "ACGT" + "A" * (i % 50), "@" + "I" * (3 + i % 50))


def test_sam_malformed_records_are_kept_apart(spark, tmp_path):
    p = tmp_path / "a.sam"
    p.write_text(
        "@HD\tVN:1.0\tSO:queryname\n"
        "q1\t83\tchr1\t101\t60\t5S20M3I10M2D4M\t=\t51\t-90\tACGT\tIIII\tX0:i:1\tX0:i:9\tNM:i:0\n"
        "q2\tbad\tchr1\t7\t0\t*\t*\t0\t0\t*\t*\n"
        "short\t4\n")
    got = {r["qname"]: r for r in gs.read_alignments(spark, str(p), "S").collect()}
    q1 = got["q1"]
    assert (q1["s"], q1["e"], q1["strand"], q1["mate"], q1["x0"], q1["mate_s"]) == (100, 136, "-", 1, 1, 50)
    assert q1["tags"] == {"X0": "1", "NM": "0"} and q1["reject"] is None
    assert got["q2"]["reject"] == "bad flag" and got["q2"]["cigar"] is None
    assert got["short"]["reject"] == "too few fields"


def test_fasta_chunks(spark, tmp_path):
    import random

    rng = random.Random(1)
    seqs = {"chr1": "".join(rng.choice("ACGT") for _ in range(1003)), "chrUn_2": "".join(rng.choice("ACGTN") for _ in range(77))}
    with open(tmp_path / "g.fa", "w") as f:
        for k, s in seqs.items():
            f.write(f">{k} note\n" + "\n".join(s[i:i + 13] for i in range(0, len(s), 13)) + "\n")
    got = {(r["chrom"], r["off"]): r["seq"] for r in gs.read_sequences(spark, str(tmp_path / "g.fa"), 50, 9).collect()}
    assert got == {(k, o): s[o:o + 59] for k, s in seqs.items() for o in range(0, len(s), 50)}


def test_numbered_lines(spark, tmp_path):
    (tmp_path / "x.txt").write_text("\n".join(str(i) for i in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = numbered_lines(spark, str(tmp_path / "x.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r["line_no"] for r in rows) == list(range(500))
    assert all(str(r["line_no"]) == r["value"] for r in rows)


def test_lines_are_dealt_out_before_they_are_sorted(spark):
    """one sort for what a task receives, none for all lines that it makes; values of the third line stay behind."""
    from strandlake.operators.reads import assemble_records

    rows = [("f", 4 * k + i, t) for k in range(50) for i, t in enumerate([f"@r{k}", "ACGT", "+ long comment", "IIII"])] + [("g", 2, "+")]
    df = assemble_records(spark.createDataFrame(rows, "file string, line_no bigint, value string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("SortAggregate") < plan.index("Exchange")
    assert "SortAggregate" not in plan[plan.index("Exchange"):]
    assert sorted(df.collect(), key=str) == sorted([("f", k, f"r{k}", "ACGT", "IIII") for k in range(50)] + [("g", 0, None, None, None)], key=str)
