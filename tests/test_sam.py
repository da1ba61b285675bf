"""Header and order of SAM text: given lengths, genomes, read groups, records without a place, repeated tags."""

from pyspark.sql import functions as F

from strandlake import sinks
from strandlake.sources import genomic as gs

ROW = "sample string, qname string, mate int, flag int, chrom string, s bigint, e bigint, strand string, tlen bigint, tags map<string,string>"
ROWS = [("A", "r2", 1, 0, "chr10", 5, 9, "+", 0, {"RG": "x"}), ("A", "r1", 1, 0, "chr2", 7, 9, "+", 0, {"RG": "y"}),
        ("A", "r1", 1, 0, "chrX", 1, 9, "+", 0, {}), ("A", "r0", 1, 4, None, None, None, "+", 0, None),
        ("A", "r3", 2, 129, "chr2", 7, 9, "+", 0, {}), ("A", "r3", 1, 65, "chr2", 7, 9, "+", 0, {}), ("B", "q", 1, 0, "chr2", 0, 4, "+", 0, {})]


def lines(path, sample):
    found = []
    for p in sorted((path / f"sample={sample}").glob("part-*")):
        found += p.read_text().splitlines()
    return found


def test_header_and_order(spark, tmp_path):
    df = spark.createDataFrame(ROWS, ROW)
    sinks.write_sam(df, str(tmp_path / "a"))
    got = lines(tmp_path / "a", "A")
    assert got[:6] == ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:chr2\tLN:9", "@SQ\tSN:chr10\tLN:9", "@SQ\tSN:chrX\tLN:9",
                       "@RG\tID:x\tSM:A", "@RG\tID:y\tSM:A"]
    assert [tuple(t.split("\t")[:3]) for t in got[6:]] == [
        ("r1", "0", "chr2"), ("r3", "65", "chr2"), ("r3", "129", "chr2"), ("r2", "0", "chr10"), ("r1", "0", "chrX"), ("r0", "4", "*")]
    assert lines(tmp_path / "a", "B")[:2] == ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:chr2\tLN:4"]
    header = gs.read_sam_header(spark, str(tmp_path / "a")).filter("sample = 'A' and kind = 'SQ'").orderBy("line_no").collect()
    assert [(r["line_no"], r["fields"]) for r in header] == [
        (1, {"SN": "chr2", "LN": "9"}), (2, {"SN": "chr10", "LN": "9"}), (3, {"SN": "chrX", "LN": "9"})]
    assert gs.read_alignments(spark, str(tmp_path / "a")).count() == len(ROWS)


def test_lengths_are_given(spark, tmp_path):
    df = spark.createDataFrame(ROWS, ROW)
    sizes = spark.createDataFrame([("chr2", 100), ("chr10", 90), ("chrX", 80), ("chrY", 70)], "chrom string, length bigint")
    got = {(r["sample"], r["chrom"], r["place"], r["length"]) for r in sinks.sam_dictionary(df, sizes).collect()}
    want = [("chr2", 0, 100), ("chr10", 1, 90), ("chrX", 2, 80), ("chrY", 3, 70)]
    assert got == {(s, *w) for s in "AB" for w in want}
    own = df.withColumn("genome", F.when(F.col("sample") == "A", "hg19").otherwise("mm10"))
    by = spark.createDataFrame([("hg19", "chr1", 5), ("mm10", "chr1", 6)], "genome string, chrom string, length bigint")
    assert {(r["sample"], r["length"]) for r in sinks.sam_dictionary(own, by).collect()} == {("A", 5), ("B", 6)}


def test_the_first_of_repeated_tags_counts(spark, tmp_path):
    text = "r\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tX0:i:3\tX0:i:9\tRG:Z:a:b\tbad"
    (tmp_path / "sample=S").mkdir()
    (tmp_path / "sample=S" / "x.sam").write_text("@CO\tfree: text\n" + text + "\n")
    (row,) = gs.read_alignments(spark, str(tmp_path)).collect()
    assert row["tags"] == {"X0": "3", "RG": "a:b"} and row["x0"] == 3
    (head,) = gs.read_sam_header(spark, str(tmp_path)).collect()
    assert head["kind"] == "CO" and head["fields"] == {} and head["text"] == "@CO\tfree: text"
