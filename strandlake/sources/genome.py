"""Constants per genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arith import col

# fixed values: genome -> (organism, number of autosomes, effective-size code)
GENOMES = {
    "hg19": ("human", 22, "hs"),
    "hg38": ("human", 22, "hs"),
    "mm9": ("mouse", 19, "mm"),
    "mm10": ("mouse", 19, "mm"),
    "rn4": ("rat", 20, "mm"),
    "rn5": ("rat", 20, "mm"),
}


def included_chromosomes(genome: str) -> list[str]:
    """Autosomes, X and Y; the mitochondrion and unplaced contigs are left out."""
    return [f"chr{i}" for i in range(1, GENOMES[genome][1] + 1)] + ["chrX", "chrY"]


def genome_constants(spark: SparkSession) -> DataFrame:
    """(genome, organism, size_code, chrom, ordinal), under 150 rows whatever the data."""
    rows = [
        (g, organism, code, c, i)
        for g, (organism, _, code) in GENOMES.items()
        for i, c in enumerate(included_chromosomes(g), 1)
    ]
    return spark.createDataFrame(rows, "genome string, organism string, size_code string, chrom string, ordinal int")


def chromosome_ordinal(chrom: str | Column) -> Column:
    """Karyotype order: numbers, X, Y, M, then the rest."""
    name = F.regexp_replace(col(chrom), "^chr", "")
    return (
        F.when(name == "X", F.lit(1000))
        .when(name == "Y", F.lit(1001))
        .when(name == "M", F.lit(1002))
        .otherwise(F.coalesce(F.try_to_number(name, F.lit("999")).cast("int"), F.lit(1003)))
    )
