"""References of many genomes in one place: points, excluded regions, sizes, bases, by genome."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_catalog(tables: Mapping[str, DataFrame], path: str, mode: str = "error") -> None:
    """Each kind of reference (a table with ``genome``) under a folder of its name, split by genome."""
    for kind, rows in tables.items():
        if "genome" not in rows.columns:
            raise ValueError(f"{kind} does not name the genome")
        rows.repartition("genome").write.mode(mode).partitionBy("genome").parquet(f"{path}/{kind}")


def read_catalog(spark: SparkSession, path: str, kind: str, samples: DataFrame | None = None) -> DataFrame:
    """One kind of reference; with ``samples`` (genome) that of their genomes alone.

    The genomes of the samples prune the folders when the plan runs, so that a study reads
    its own references however many the catalog holds. Samples without a genome need none.
    """
    rows = spark.read.parquet(f"{path}/{kind}")
    if samples is None:
        return rows
    genomes = samples.select("genome").filter(F.length("genome") > 0).distinct()
    return rows.join(genomes, "genome", "left_semi")
