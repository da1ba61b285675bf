"""Row numbers and running totals that do not need one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .arith import idiv


def running_total(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], value: Column,
                  name: str, down: bool = False) -> DataFrame:
    """Running sum of ``value`` within ``keys``, where ``bucket`` is monotone in ``order``.

    The sum is taken per bucket first; only the bucket totals are ordered across a
    whole group, and rows are ordered inside their bucket alone.
    """
    by_bucket = Window.partitionBy(*keys).orderBy(F.col(bucket).desc() if down else F.col(bucket))
    base = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.sum("_sum").over(by_bucket) - F.col("_sum"))
        .drop("_sum")
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (
        df.join(base, [*keys, bucket])
        .withColumn(name, F.col("_base") + F.sum(value).over(inside))
        .drop("_base")
    )


def row_index(df: DataFrame, keys: Sequence[str], order: str, name: str = "idx", width: int = 1 << 16) -> DataFrame:
    """0-based row number by the unique integer ``order`` within ``keys``, split into ranges of ``order``."""
    cols = df.columns
    ranged = df.withColumn("_range", idiv(order, width))
    out = running_total(ranged, keys, "_range", [F.col(order)], F.lit(1).cast("bigint"), name)
    return out.select(*cols, (F.col(name) - 1).alias(name))
