"""Quality metrics, from marked but unpruned alignments and unfiltered peaks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import arith as A
from ..functions.arith import idiv
from ..functions.tiling import TILE, depth_runs
from ..sources.genome import genome_constants
from .intervals import exclude_overlaps, flag_overlaps, overlap_counts, place_keys
from .tags import shifted_products

TRACK = ["sample", "chrom"]


def read_counts(df: DataFrame) -> DataFrame:
    """Reads per flag class; read groups are ignored, the sample is one group."""
    def n(mask: int, name: str):
        return A.count_flag("flag", mask).alias(name)

    return df.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total"),
        n(A.PAIRED, "paired"), n(A.PROPER, "proper"), n(A.UNMAPPED, "unmapped"), n(A.MATE_UNMAPPED, "mate_unmapped"),
        n(A.SECONDARY, "secondary"), n(A.SUPPLEMENTARY, "supplementary"), n(A.QC_FAIL, "qc_fail"),
        n(A.DUPLICATE, "duplicate"),
    )


def fragment_lengths(df: DataFrame) -> DataFrame:
    """Histogram over first mates of proper pairs."""
    used = df.filter(A.has_all("flag", A.PROPER) & (F.col("mate") == 1) & ~A.has_any("flag", A.UNMAPPED))
    return used.groupBy("sample", F.abs("tlen").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def peak_reads(df: DataFrame, peaks: DataFrame) -> DataFrame:
    """Reads per peak, each peak by itself."""
    return overlap_counts(peaks, df, TRACK, "reads")


def peak_fractions(df: DataFrame, peaks: DataFrame) -> DataFrame:
    """Per sample: reads, reads in any peak (each once) and their share; the reads are passed once."""
    return flag_overlaps(df, peaks, TRACK).groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"),
        F.count_if("hit").alias("in_peaks"),
        (F.count_if("hit") / F.count(F.lit(1))).alias("fraction"),
    )


def ranked_peaks(counted: DataFrame) -> DataFrame:
    """Cumulative reads over peaks in falling order of reads: one row per distinct count."""
    by_count = counted.groupBy("sample", "reads").agg(F.count(F.lit(1)).alias("peaks"))
    down = Window.partitionBy("sample").orderBy(F.col("reads").desc())
    return by_count.select(
        "sample", "reads", F.sum("peaks").over(down).alias("peaks"),
        F.sum(F.col("reads") * F.col("peaks")).over(down).alias("cumulative"),
    )


def duplicate_split(df: DataFrame, peaks: DataFrame, paramsets: Sequence[str] = ()) -> DataFrame:
    """Reads and duplicates inside and outside of peaks; with ``paramsets`` (of the peaks) for each of them."""
    hit, dup = F.col("hit"), A.has_any("flag", A.DUPLICATE)
    keys: list[str] = []
    if paramsets:
        keys = ["paramset"]
        df = df.withColumn("paramset", F.explode(F.array(*map(F.lit, paramsets))))
    return flag_overlaps(df, peaks, [*keys, *TRACK]).groupBy(*keys, "sample").agg(
        F.count_if(hit).alias("reads_in"),
        F.count_if(hit & dup).alias("duplicates_in"),
        F.count_if(~hit).alias("reads_out"),
        F.count_if(~hit & dup).alias("duplicates_out"),
    )


def tss_profile(fragments: DataFrame, tss: DataFrame, flank: int = 1000) -> DataFrame:
    """Summed depth at each offset from the points, in the direction of their strand.

    Depth (one run per stretch of a genome, however many reads) and points meet tile by
    tile: the depths of a tile and of the flanks beside it are correlated with the
    weights of its points, for all offsets at once, so a crowded tile costs what it is
    wide and no (run, point) pair is formed. Equal points are counted once with a
    weight. A sample that meets no point has depth 0 everywhere. Where both tables name
    the genome, a sample meets the points of its own.
    """
    place = place_keys(fragments, tss)
    width = TILE
    while width < 4 * flank:
        width *= 2
    points = tss.groupBy(*place, "s", (F.col("strand") == "+").alias("forward")).agg(F.count(F.lit(1)).alias("w")).groupBy(
        *place, _tile(F.col("s"), width).alias("at")
    ).agg(F.collect_list(F.struct(F.col("s").cast("bigint").alias("p"), F.coalesce("forward", F.lit(False)).alias("forward"), "w")).alias("points"))
    track = list(dict.fromkeys([*TRACK, *place]))
    runs = depth_runs(fragments, track).select(*track, F.greatest("s", F.lit(0)).cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"), "depth").filter("s < e")
    near = F.sequence(_tile(F.col("s") - flank, width), _tile(F.col("e") - 1 + flank, width))
    runs = runs.select("*", F.explode(near).alias("at")).groupBy(*track, "at").agg(F.collect_list(F.struct("s", "e", "depth")).alias("runs"))
    # sorted and merged by hint: neither side is as small as the tables that it is made of
    met = runs.join(points.hint("merge"), [*place, "at"]).select(
        "sample", "at", F.col("runs.s").alias("s"), F.col("runs.e").alias("e"), F.col("runs.depth").alias("depth"),
        F.col("points.p").alias("p"), F.col("points.forward").alias("forward"), F.col("points.w").alias("w"))

    def correlated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in batches:
            for r in pdf.itertuples():
                first = r.at * width - flank
                change = np.zeros(width + 2 * flank + 1, np.int64)
                np.add.at(change, np.clip(r.s - first, 0, len(change) - 1), r.depth)
                np.add.at(change, np.clip(r.e - first, 0, len(change) - 1), -r.depth)
                depth = np.cumsum(change)[:-1]
                total = sums.setdefault(r.sample, np.zeros(2 * flank + 1, np.int64))
                forward = r.forward.astype(bool)
                for own, step in ((forward, 1), (~forward, -1)):
                    weights = np.zeros(width, np.int64)
                    weights[r.p[own] - r.at * width] = r.w[own]
                    total += shifted_products([(weights, depth)], 2 * flank)[::step]
        yield pd.DataFrame({"sample": list(sums), "sums": list(sums.values())})

    kind = fragments.select("sample").schema[0].dataType.simpleString()
    parts = met.mapInPandas(correlated, f"sample {kind}, sums array<bigint>")
    zeros = fragments.select("sample").distinct().withColumn("sums", F.array_repeat(F.lit(0).cast("bigint"), 2 * flank + 1))
    return (
        parts.unionByName(zeros).select("sample", F.posexplode("sums").alias("i", "d"))
        .groupBy("sample", (F.col("i") - flank).cast("bigint").alias("offset")).agg(F.sum("d").alias("depth"))
    )


def _tile(p: Column, width: int) -> Column:
    """The tile of a position, also of one before 0."""
    return idiv(p - F.pmod(p, F.lit(width)), width)


def tss_enrichment(fragments: DataFrame, tss: DataFrame, flank: int = 1000, outer: int = 100) -> DataFrame:
    """Depth relative to the mean of the outermost bases on both sides, per offset."""
    profile = tss_profile(fragments, tss, flank)
    far = F.abs("offset") > flank - outer
    base = F.avg(F.when(far, F.col("depth"))).over(Window.partitionBy("sample"))
    return profile.withColumn("enrichment", F.col("depth") / F.nullif(base, F.lit(0.0)))


def tss_score(enrichment: DataFrame) -> DataFrame:
    return enrichment.filter("offset = 0").select("sample", F.col("enrichment").alias("tss_enrichment"))


def chromosome_classes(df: DataFrame, organism: str | None = None) -> DataFrame:
    """Reads on autosomes, sex chromosomes, the mitochondrion and the rest.

    Without ``organism`` each row's ``genome`` says which chromosomes there are.
    """
    constants = genome_constants(df.sparkSession)
    place = ["genome", "chrom"] if organism is None else ["chrom"]
    if organism is not None:
        constants = constants.filter(F.col("organism") == organism)
    known = constants.select(*place).distinct().withColumn("known", F.lit(True))
    kind = (
        F.when(F.col("chrom").isin("chrX", "chrY"), "sex")
        .when(F.col("chrom") == "chrM", "mitochondrial")
        .when(F.col("known"), "autosomal")
        .otherwise("other")
    )
    counts = df.groupBy("sample", *place).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.join(known, place, "left").groupBy("sample", kind.alias("class"))
        .agg(F.sum("n").alias("reads"))
    )


def exclude_regions(df: DataFrame, excluded: DataFrame) -> DataFrame:
    return exclude_overlaps(df, excluded, place_keys(df, excluded))


def long_metrics(df: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Wide metrics to (keys, metric, value)."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in rest]).unpivot(list(keys), rest, "metric", "value")


def metrics_rollup(metrics: DataFrame, samples: Sequence[str] | None = None) -> DataFrame:
    """One row per (paramset, metric): a column for each of the given samples, or a map from sample to value."""
    rows = metrics.groupBy("paramset", "metric")
    if samples:
        return rows.pivot("sample", list(samples)).agg(F.first("value"))
    return rows.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("sample", "value")))).alias("values"))
