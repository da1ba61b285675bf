"""File-name and read-name expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arith import col

# fixed values: default patterns of the command line
CAPTURE_REGEX = r".*_R([12])(?=[_\.]).*\.fastq\.gz"
STRIP_REGEX = r"_R?[12]_?[0-9]{0,3}\.fastq\.gz$"
SAMPLE_REGEX = r"^[a-zA-Z0-9_]+$"
# fixed values: names of numbered read files and of other ones, with what they become
NUMBERED_FILE, NUMBERED_AS = r"_([12])\.fastq\.gz", r"_R$1.fastq.gz"
PLAIN_FILE, PLAIN_AS = r"(.*)\.fastq\.gz", r"$1_R1.fastq.gz"
# fixed values: an archive's names of reads and of files
ARCHIVE_READ = r"^(SRR[0-9]+\.[0-9]+)\.[12]$"
ARCHIVE_FILE = r"^SRR\d+_\d\.(fastq|fq)"


def base_name(path: str | Column) -> Column:
    return F.substring_index(col(path), "/", -1)


def strip_suffix(name: str | Column, regex: str = STRIP_REGEX) -> Column:
    return F.regexp_replace(col(name), regex, "")


def has_read_number(name: str | Column) -> Column:
    return col(name).rlike("^(?:" + CAPTURE_REGEX + ")")


def add_read_number(name: str | Column) -> Column:
    """``x_1.fastq.gz`` -> ``x_R1.fastq.gz``; any other name is taken for read 1."""
    out = col(name)
    numbered = F.regexp_replace(out, NUMBERED_FILE, NUMBERED_AS)
    return F.when(out.rlike(NUMBERED_FILE), numbered).otherwise(F.regexp_replace(out, PLAIN_FILE, PLAIN_AS))


def normalise_extension(name: str | Column) -> Column:
    return F.regexp_replace(col(name), r"\.fq\.gz$", ".fastq.gz")


def clean_read_name(name: str | Column) -> Column:
    return F.substring_index(col(name), "/", 1)


def strip_mate_suffix(name: str | Column) -> Column:
    return F.regexp_replace(col(name), ARCHIVE_READ, "$1")


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(F.translate(col(seq), "ACGTacgt", "TGCAtgca"))
