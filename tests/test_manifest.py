"""Samplesheets, listings and names: the documented cases."""

import gzip

import pytest
from pyspark.sql import functions as F

from strandlake.functions import names as N
from strandlake.operators import manifest as mf, reads as rd
from strandlake.sources import tables as ts

RUNS = [("SRR5799398", "SAMN07312033"), ("SRR5799401", "SAMN07312030"), ("SRR5799402", "SAMN07312030"), ("SRR5799447", "SAMN07312104")]


def value(spark, expr, text):
    return spark.createDataFrame([(text,)], "x string").select(expr(F.col("x"))).first()[0]


def test_group_runs_by_sample(spark):
    files = [(f"d/{r}_{m}.fastq.gz",) for r, _ in RUNS for m in (2, 1)] + [("d/SRR1_1.fastq.gz",)]
    got = mf.group_files(spark.createDataFrame(files, "path string"), spark.createDataFrame(RUNS, "Run string, BioSample string"))
    assert {r["group"]: r["files"] for r in got.collect()} == {
        "SAMN07312033": ["SRR5799398_1.fastq.gz", "SRR5799398_2.fastq.gz"],
        "SAMN07312030": ["SRR5799401_1.fastq.gz", "SRR5799401_2.fastq.gz", "SRR5799402_1.fastq.gz", "SRR5799402_2.fastq.gz"],
        "SAMN07312104": ["SRR5799447_1.fastq.gz", "SRR5799447_2.fastq.gz"],
    }


def test_group_without_files_is_empty(spark):
    got = mf.group_files(spark.createDataFrame([], "path string"), spark.createDataFrame(RUNS[:1], "Run string, BioSample string"))
    assert got.first()["files"] == []


@pytest.mark.parametrize("name,expected,warns", [
    ("SRR5799402_2.fastq.gz", "SRR5799402_R2.fastq.gz", False),
    ("SRR5799402.fastq.gz", "SRR5799402_R1.fastq.gz", False),
    ("SRR5799402_R2.fastq.gz", "SRR5799402_R2_R1.fastq.gz", True),
])
def test_add_read_number(spark, name, expected, warns):
    row = mf.add_read_numbers(spark.createDataFrame([(name,)], "file string")).first()
    assert (row["renamed"], row["warning"]) == (expected, warns)


def test_capture_read_groups_lanes(spark):
    names = ["2_L001_R1", "2_L002_R1", "2_L001_R2", "2_L002_R2"]
    files = spark.createDataFrame([("2", f"d/{n}.fastq.gz") for n in names], "sample string, path string")
    got = {r["read"]: r["paths"] for r in mf.reads_by_sample(mf.capture_read(files)).collect()}
    assert got == {m: [f"d/2_L001_R{m}.fastq.gz", f"d/2_L002_R{m}.fastq.gz"] for m in "12"}


def test_capture_read_fails_on_no_match_and_skips_partial(spark):
    schema = "sample string, path string"
    with pytest.raises(Exception, match="does not match"):
        mf.capture_read(spark.createDataFrame([("a", "d/a.fastq.gz")], schema)).collect()
    assert mf.capture_read(spark.createDataFrame([("a", "d/a_R1.fastq.gz.md5")], schema)).count() == 0


def test_missing_column_and_bad_names(spark):
    sheet = spark.createDataFrame([("s1_2*(@%",), ("good_1",), (None,)], "sample string")
    with pytest.raises(ValueError, match="lib"):
        mf.require_columns(sheet)
    mf.require_columns(sheet, mf.REQUIRED_PEAKS_ONLY)
    assert {r[0] for r in mf.invalid_samples(sheet).collect()} == {"s1_2*(@%", None}


def test_missing_genome_is_an_error(spark):
    samples = spark.createDataFrame([("a", "mm9")], "sample string, genome string")
    refs = mf.reference_table(spark, {"tss": {"hg19": "x"}})
    with pytest.raises(Exception, match="no tss for genome mm9"):
        mf.resolve_reference(samples, refs, "tss").collect()
    assert mf.resolve_reference(samples, refs, "tss", strict=False).first()["path"] is None


def test_planned_outputs_follow_the_columns(spark):
    bare = spark.createDataFrame([("a",)], "sample string")
    assert {r["kind"] for r in mf.planned_outputs(bare, ["p"]).collect()} == {"tdf", "bigwig"}
    blank = spark.createDataFrame([("a", None, "hg19r")], "sample string, input string, homer_fmg_genome string")
    assert {r["kind"] for r in mf.planned_outputs(blank, ["p"]).collect()} == {"tdf", "bigwig"}
    with pytest.raises(ValueError):
        mf.planned_outputs_peaks_only(bare, ["p"])


def test_samplesheet_with_byte_order_mark(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_bytes("﻿lib,sample,genome,input\n1,a,hg19,\n2,b,hg19,a\n".encode())
    df = ts.read_samplesheet(spark, str(p))
    assert df.columns == ["lib", "sample", "genome", "input"]
    assert [tuple(r) for r in df.orderBy("lib").collect()] == [("1", "a", "hg19", None), ("2", "b", "hg19", "a")]


def test_run_table_with_escaped_commas(spark, tmp_path):
    p = tmp_path / "runs.txt"
    p.write_text('Run,chip_antibody,Bases\nSRR1,"H3K27ac (39133\\, Active Motif)",12\nSRR2,NA,7\nSRR3,"a, b",x\n')
    df = ts.read_run_table(spark, str(p), "Run string, chip_antibody string, Bases bigint")
    assert [tuple(r) for r in df.orderBy("Run").collect()] == [
        ("SRR1", "H3K27ac (39133, Active Motif)", 12), ("SRR2", None, 7), ("SRR3", "a, b", None)]


def test_accessions_drop_comments(spark, tmp_path):
    p = tmp_path / "acc.txt"
    p.write_text("SRR1 # input\nSRR2\n\n")
    assert sorted(r[0] for r in ts.read_accessions(spark, str(p)).collect()) == ["SRR1", "SRR2"]


def test_list_reads_sees_empty_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ts.list_reads(spark, str(tmp_path))
    (tmp_path / "a.fastq.gz").touch()
    (tmp_path / "a.txt").touch()
    assert [r[0] for r in ts.list_reads(spark, str(tmp_path)).collect()] == [str(tmp_path / "a.fastq.gz")]


def test_read_names_and_sra_listing(spark):
    reads = spark.createDataFrame([("f", 0, "SRR9.77.1 length=5"), ("g", 0, "SRR9.77 x"), ("h", 1, "SRR9.7.2")], "file string, idx int, name string")
    assert [r["file"] for r in mf.check_read_names(reads).collect()] == ["f"]
    listing = spark.createDataFrame([("a/b/SRR12_1.fastq.gz",)], "path string")
    assert mf.looks_like_sra(listing).first()["sra"] is True
    assert mf.looks_like_sra(listing.filter("false")).first()["sra"] is False


def test_name_expressions(spark):
    assert value(spark, N.strip_mate_suffix, "SRR12.345.2") == "SRR12.345"
    assert value(spark, N.clean_read_name, "q1/2") == "q1"
    assert value(spark, N.normalise_extension, "a.fq.gz") == "a.fastq.gz"
    assert value(spark, N.reverse_complement, "AACGN") == "NCGTT"
