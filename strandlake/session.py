"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "strandlake", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster passes its own."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []
_staged: list[str] = []
_tables: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; a cluster needs a folder that
    every executor sees.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="strandlake-"))
        root = _local_root[0]
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Deletes all intermediates that this process has written, and returns how many there were.

    For the end of a study, when its results have been stored: DataFrames that read an
    intermediate cannot be computed afterwards.
    """
    jvm = spark._jvm
    n = 0
    while _tables:
        spark.sql(f"drop table if exists {_tables.pop()}")
    while _staged:
        folder = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        n += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return n


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes an intermediate that several results read, and returns the written table.

    A written table survives the loss of executors and is computed once, which a
    second branch of the same plan is not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, name: str, keys: Sequence[str], spread: bool = True) -> DataFrame:
    """Like ``stage``, in buckets by ``keys``: what groups, joins or windows by them reads the table without a shuffle.

    There are as many buckets as shuffle partitions. ``spread`` False leaves out the shuffle
    before the write, for rows that are already dealt out by the keys.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = f"staged_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys) if spread else df
    rows.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(table)
    _tables.append(table)
    return spark.table(table)
