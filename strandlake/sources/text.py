"""Line numbers for text files that are read in splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], file: Column | None = None, **options: object) -> DataFrame:
    """(path, line_no, value) with 0-based line numbers per file, also where a file is read in many splits.

    ``file`` (an expression of ``path``) makes one file of several parts, numbered on in
    order of their paths; it is then what ``path`` holds.

    Lines are counted per split; the counts are summed in order of the splits' offsets
    and added to the row's place in its own split. The lines themselves do not move.
    """
    raw = spark.read.options(**options).text(paths if isinstance(paths, str) else list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("file", F.col("path") if file is None else file)
    before = Window.partitionBy("file").orderBy("path", "split").rowsBetween(Window.unboundedPreceding, -1)
    splits = raw.groupBy("file", "path", "split").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).select(
        "path", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return raw.join(splits, ["path", "split"]).select(
        raw["file"].alias("path"), (F.col("row") - F.col("first") + F.col("offset")).alias("line_no"), "value"
    )
