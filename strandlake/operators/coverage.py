"""Coverage tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arith as A
from ..functions.arith import idiv
from ..functions.tiling import TILE, depth_runs, join_cut_runs, join_runs, tile_range
from .intervals import exclude_overlaps, place_keys

TRACK = ("sample", "chrom")


def extend_reads(df: DataFrame, length: int | None = None, sizes: DataFrame | None = None,
                 unpaired: int | None = None) -> DataFrame:
    """Replaces s, e by the whole fragment of a paired read, or by ``length`` bases from the 5' end.

    Reads of both kinds may be mixed: with ``unpaired`` the length is that of reads without
    an insert size. Without any length such a read is its own fragment. ``sizes``
    (chrom, size) clips at the chromosome end.
    """
    if length is not None:
        reach = F.lit(length).cast("bigint")
    else:
        alone = F.col("e") - F.col("s") if unpaired is None else F.lit(unpaired).cast("bigint")
        whole = F.coalesce(F.col("tlen"), F.lit(0)) != 0
        if "flag" in df.columns:
            whole = whole & A.has_any("flag", A.PAIRED)
        reach = F.when(whole, F.abs("tlen")).otherwise(alone)
    forward = F.col("strand") == "+"
    s = F.when(forward, F.col("s")).otherwise(F.greatest(F.col("e") - reach, F.lit(0)))
    e = F.when(forward, F.col("s") + reach).otherwise(F.col("e"))
    out = df.withColumn("_s", s).withColumn("e", e).withColumn("s", F.col("_s")).drop("_s")
    if sizes is None:
        return out
    return out.join(sizes, "chrom", "left").withColumn("e", F.least("e", F.coalesce("size", F.col("e")))).drop("size")


def fragments(df: DataFrame, keep_dup: str | int = "all") -> DataFrame:
    """One row per pair, from mate 1 (single reads count as mate 1), with a policy for equal positions.

    ``keep_dup=n`` keeps at most n fragments of one (sample, chrom, s, e).
    """
    first = df.filter(F.col("mate") == 1)
    if keep_dup == "all":
        return first
    copies = first.groupBy(*TRACK, "s", "e").agg(F.least(F.count(F.lit(1)), F.lit(int(keep_dup))).cast("int").alias("n"))
    return copies.select(*TRACK, "s", "e", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))


def bin_coverage(df: DataFrame, width: int = 25, keys: Sequence[str] = TRACK) -> DataFrame:
    """Fragments that touch each bin; bins without any are left out.

    Counted as depth in units of bins: two events per fragment are shuffled, not one
    row per bin it touches, and bins are written out only after the sums are known.
    """
    span = df.filter("s < e").select(
        *keys, idiv("s", width).alias("s"), (idiv(F.col("e") - 1, width) + 1).alias("e")
    )
    runs = depth_runs(span, keys)
    return runs.select(
        *keys, F.explode(F.sequence(F.col("s"), F.col("e") - 1)).alias("bin"), F.col("depth").alias("n")
    )


def sample_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))


def normalise_cpm(bins: DataFrame, totals: DataFrame, value: str = "n") -> DataFrame:
    """Count per million fragments used; the totals hold one row per sample."""
    return bins.join(totals, "sample").withColumn("cpm", F.col(value) * 1e6 / F.col("total")).drop("total")


def coverage_excluding(df: DataFrame, excluded: DataFrame | None = None, width: int = 25) -> DataFrame:
    """CPM track of fragments; those in excluded regions go first, and only if a table is given."""
    used = df if excluded is None else exclude_overlaps(df, excluded, place_keys(df, excluded))
    return normalise_cpm(bin_coverage(used, width), sample_totals(used))


def depth(df: DataFrame, keys: Sequence[str] = TRACK) -> DataFrame:
    """Exact depth as maximal runs (s, e, depth)."""
    return join_cut_runs(depth_runs(df, keys), keys, ["depth"]).select(*keys, "s", "e", "depth")


def compact_bins(bins: DataFrame, width: int, value: str, keys: Sequence[str] = TRACK) -> DataFrame:
    """Runs of equal value from a binned track."""
    runs = bins.select(
        *keys,
        F.col(value).alias("value"),
        idiv("bin", TILE).alias("tile"),
        (F.col("bin") * width).alias("s"),
        ((F.col("bin") + 1) * width).alias("e"),
    )
    return join_runs(runs, keys, same=["value"]).select(*keys, "s", "e", "value")


def window_bases(df: DataFrame, width: int, keys: Sequence[str] = TRACK) -> DataFrame:
    """Bases of coverage in each window, from depth runs rather than from single fragments."""
    w = depth_runs(df, keys).select("*", F.explode(tile_range("s", "e", width)).alias("bin"))
    lo = F.greatest(F.col("s"), F.col("bin") * width)
    hi = F.least(F.col("e"), (F.col("bin") + 1) * width)
    return w.groupBy(*keys, "bin").agg(F.sum((hi - lo) * F.col("depth")).alias("bases"))


def window_counts(df: DataFrame, width: int = 25, pairs: bool = True, extend: int = 150,
                  include_duplicates: bool = True) -> DataFrame:
    """Mean depth per window: whole fragments of pairs, or reads extended to a fixed length."""
    used = df if include_duplicates else df.filter(~A.has_any("flag", A.DUPLICATE))
    spans = fragments(extend_reads(used)) if pairs else extend_reads(used, extend)
    return window_bases(spans, width).withColumn("mean_depth", F.col("bases") / width).drop("bases")


def zoom(bins: DataFrame, factors: Sequence[int], value: str, keys: Sequence[str] = TRACK) -> DataFrame:
    """Coarser levels of a binned track: sum and maximum per group of bins, absent bins counting as zero."""
    level = F.explode(F.array(*[F.lit(f).cast("bigint") for f in factors]))
    return (
        bins.select(*keys, "bin", value, level.alias("factor"))
        .groupBy(*keys, "factor", idiv("bin", F.col("factor")).alias("zbin"))
        .agg((F.sum(value) / F.col("factor")).alias("mean"), F.max(value).alias("max"))
    )
