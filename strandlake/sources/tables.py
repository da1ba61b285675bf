"""Samplesheets, run tables, accession lists, listings and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text, blank cells null."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_run_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with quoted commas, some of them escaped by a backslash; NA is null.

    Without a schema all columns are text.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", "\\").option("nullValue", "NA")
    df = reader.csv(path)
    clean = [F.regexp_replace(F.col(f"`{c}`"), r"\\,", ",").alias(c) for c in df.columns]
    df = df.select(*clean)
    if schema is None:
        return df
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_accessions(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, what follows a # left out."""
    acc = F.trim(F.regexp_extract("value", r"^([^#]*)", 1))
    return spark.read.text(path).select(acc.alias("accession")).filter("accession <> ''")


def list_reads(spark: SparkSession, folder: str, glob: str = "*.fastq.gz") -> DataFrame:
    """(path) of the files in a folder, empty ones too; an error when there is none.

    A listing through the file system that Spark itself uses, so it works on shared storage.
    """
    return spark.createDataFrame([(p,) for p in _matching(spark, folder, glob)], "path string")


def _matching(spark: SparkSession, folder: str, glob: str) -> list[str]:
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = sorted(f.getPath().toUri().getPath() for f in found)
    if not paths:
        raise FileNotFoundError(f"no file matches {glob} in {folder}")
    return paths


def list_sample_reads(spark: SparkSession, samples: dict[str, str], glob: str = "*.fastq.gz") -> DataFrame:
    """(sample, path) over the folders of all samples."""
    if not samples:
        raise ValueError("no samples given")
    return spark.createDataFrame(
        [(sample, path) for sample, folder in samples.items() for path in _matching(spark, folder, glob)],
        "sample string, path string")


def read_metrics(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Metrics written as (gzipped) JSON; folders of the form key=value add their keys."""
    return spark.read.schema(schema).json(paths)
