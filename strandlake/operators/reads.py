"""Sequencing reads as records (file, idx, name, seq, qual)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import idiv

MATES = ["sample", "ordinal", "idx"]


def assemble_records(lines: DataFrame) -> DataFrame:
    """Four lines -> one record: (file, line_no, value) -> (file, idx, name, seq, qual).

    Lines are dealt out by record first: texts are aggregated by sorting, which is done once
    then, for what a task has received, and not for all that it has read or made.
    """
    part = F.col("line_no") % 4

    def line(i: int, name: str) -> Column:
        return F.max(F.when(F.col("part") == i, F.col("value"))).alias(name)

    return (
        lines.select("file", idiv("line_no", 4).alias("idx"), part.alias("part"), F.when(part != 2, F.col("value")).alias("value"))
        .repartition("file", "idx")
        .groupBy("file", "idx")
        .agg(line(0, "name"), line(1, "seq"), line(3, "qual"))
        .withColumn("name", F.regexp_replace("name", "^@", ""))
    )


def concat_reads(reads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of a (sample, read) in list order: (sample, read, ordinal, idx) is the order; nothing is moved.

    ``manifest`` has (sample, read, paths).
    """
    listed = manifest.select("sample", "read", F.posexplode("paths").alias("ordinal", "file"))
    return reads.join(listed, "file")


def count_reads(reads: DataFrame) -> DataFrame:
    return reads.groupBy("file").agg(F.count(F.lit(1)).alias("reads"))


def split_reads(reads: DataFrame, sample: str, mate: int, lane: int = 1, files: int | None = None,
                per_file: int | None = None) -> DataFrame:
    """Adds ``lane`` and ``out_file``: chunks of ``per_file`` records, or an even split into ``files``.

    A chunk starts at record i (from 1) when i mod d = 1 and at least d records follow
    it, so what is left over joins the last chunk. With d = 1 the first condition
    never holds and every record stays in the lane before the first.
    """
    if (files is None) == (per_file is None):
        raise ValueError("give either files or per_file")
    n = F.col("reads")
    d = idiv(n, files) if files else F.lit(per_file).cast("bigint")
    i = F.col("idx") + 1
    opened = F.least(idiv(i - 1, d) + 1, idiv(n - d - 1, d) + 1)
    number = F.lit(lane - 1) + F.when((d >= 2) & (n > d), opened).otherwise(0)
    out = F.format_string(f"{sample}_L%03d_R{mate}.fastq", F.col("lane"))
    return (
        reads.join(count_reads(reads), "file").withColumn("lane", number).withColumn("out_file", out).drop("reads")
    )


def subset_reads(reads: DataFrame, names: DataFrame) -> DataFrame:
    """Reads whose name is listed, for their sample where both tables have one."""
    keys = [c for c in ("sample", "name") if c in reads.columns and c in names.columns]
    return reads.join(names.select(*keys).distinct(), keys, "left_semi")


def pair_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Mates by position in files listed in the same order; ``same_name`` tells whether the names agree."""
    right = r2.select(*MATES, *[F.col(c).alias(f"{c}_2") for c in ("name", "seq", "qual")])
    return r1.select(*MATES, "name", "seq", "qual").join(right, MATES).withColumn(
        "same_name", F.col("name") == F.col("name_2")
    )


def slice_reads(reads: DataFrame, first: int, last: int) -> DataFrame:
    """Records first..last of each file, counted from 1."""
    return reads.filter(F.col("idx").between(first - 1, last - 1))


def split_mates(reads: DataFrame) -> DataFrame:
    """Adds ``part``: read 1 or 2 of a complete pair, or a single read.

    A name is complete if both mates occur in one sample; the group is the reads of one name.
    """
    template = [c for c in ("sample", "name") if c in reads.columns]
    mates = F.size(F.collect_set("mate").over(Window.partitionBy(*template)))
    return reads.withColumn("part", F.when(mates == 2, F.col("mate").cast("string")).otherwise("single"))
