"""Name -> query and name -> SQL, filled by the ``queries_*`` modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Integers as bigint and doubles rounded, so that both engines print the same."""
    def cell(name: str, kind: str):
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        if kind == "double":
            return F.round(F.col(name), digits).alias(name)
        return F.col(name)

    return df.select(*[cell(n, k) for n, k in df.dtypes])


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
