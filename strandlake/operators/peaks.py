"""Peaks called from pileups against a background rate.

The unit is a bin. Its height k is the greatest depth in it; the expected height is
the larger of the genome-wide and the local rate of fragment bases.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import idiv
from ..functions.ranking import running_total
from ..functions.stats import poisson_score
from ..functions.tiling import TILE, depth_runs, join_runs, tile_range, with_halo
from ..session import stage
from ..sources.genome import chromosome_ordinal, genome_constants
from .coverage import depth
from .intervals import keep_overlaps, overlap_join

TRACK = ["sample", "chrom"]
BIN = 25
SEARCH = 1 << 13  # bins per tile of the local rate

# fixed values: effective genome size by size code
EFFECTIVE_SIZE = {"hs": 2.7e9, "mm": 1.87e9}


def pileup_bins(fragments: DataFrame, width: int = BIN) -> DataFrame:
    """(sample, chrom, bin, k, bases): greatest depth and summed depth of each covered bin."""
    runs = depth_runs(fragments, TRACK).select("*", F.explode(tile_range("s", "e", width)).alias("bin"))
    inside = F.least(F.col("e"), (F.col("bin") + 1) * width) - F.greatest(F.col("s"), F.col("bin") * width)
    return runs.groupBy(*TRACK, "bin").agg(
        F.max("depth").alias("k"), F.sum(inside * F.col("depth")).alias("bases")
    )


def effective_sizes(samplesheet: DataFrame) -> DataFrame:
    """(sample, genome_size) by the size code of each sample's genome."""
    codes = genome_constants(samplesheet.sparkSession).select("genome", "size_code").distinct()
    size = F.create_map(*[F.lit(x) for pair in EFFECTIVE_SIZE.items() for x in pair])
    return samplesheet.join(codes, "genome").select("sample", size[F.col("size_code")].alias("genome_size"))


def background(bins: DataFrame, genome_size: float | DataFrame) -> DataFrame:
    """One row per sample, from its pileup bins: fragment bases, and their rate over the effective genome.

    ``genome_size`` is one number, or a table (sample, genome_size).
    """
    totals = bins.groupBy("sample").agg(F.sum("bases").alias("total_bases"))
    if isinstance(genome_size, DataFrame):
        totals = totals.join(genome_size, "sample")
    else:
        totals = totals.withColumn("genome_size", F.lit(float(genome_size)))
    return totals.withColumn("lam_bg", F.col("total_bases") / F.col("genome_size")).drop("genome_size")


def local_lambda(
    bins: DataFrame, rates: DataFrame, windows: Sequence[int] = (10000,), width: int = BIN,
    control: DataFrame | None = None, control_rates: DataFrame | None = None,
) -> DataFrame:
    """Adds ``lam``, the larger of the background and the rate in each window around the bin.

    With a control (bins of the same form, under the name of the treated sample), the
    windows are taken over the control, scaled to the depth of the treated sample; a
    sample without a control is its own.
    Bins are copied into the tiles whose windows reach them, so a window group is a
    tile and not a chromosome.
    """
    if control is None:
        rows = bins.withColumn("cb", F.col("bases"))
        per_sample = rates.select("sample", "lam_bg", F.lit(1.0).alias("scale"))
    else:
        other = control_rates.select("sample", F.col("total_bases").alias("control_bases"))
        own = bins.join(other.select("sample", F.lit(True).alias("has_control")), "sample", "left")
        rows = own.withColumn("cb", F.when(F.col("has_control"), F.lit(0).cast("bigint")).otherwise(F.col("bases"))).drop(
            "has_control").unionByName(
            control.select(*TRACK, "bin", F.lit(None).cast("bigint").alias("k"),
                           F.lit(0).cast("bigint").alias("bases"), F.col("bases").alias("cb"))
        )
        per_sample = rates.join(other, "sample", "left").select(
            "sample", "lam_bg", F.coalesce(F.col("total_bases") / F.col("control_bases"), F.lit(1.0)).alias("scale")
        )
    halves = [w // (2 * width) for w in windows]
    near = with_halo(rows, "bin", max(halves, default=0), SEARCH)
    along = Window.partitionBy(*TRACK, "tile").orderBy("bin")
    for i, h in enumerate(halves):
        near = near.withColumn(f"w{i}", F.sum("cb").over(along.rangeBetween(-h, h)) / float((2 * h + 1) * width))
    near = near.filter("own and k is not null").join(per_sample, "sample")
    local = [F.col(f"w{i}") * F.col("scale") for i in range(len(halves))]
    return near.select(*TRACK, "bin", "k", "bases", F.greatest("lam_bg", "lam_bg", *local).alias("lam"))


def bh_scores(scores: DataFrame) -> DataFrame:
    """Benjamini-Hochberg in -log10: (sample, score, weight) with one row per score -> adds ``qscore``.

    Ranks are running weights from the best score down, q the running best from the
    worst score up. Both run over ranges of the score first and over single scores
    only inside a range, so no task orders all scores of a sample.
    """
    bucket = F.floor(F.log(F.col("score") + 1e-9) * 256)
    ranged = scores.withColumn("bucket", bucket)
    ranked = running_total(ranged, ["sample"], "bucket", [F.col("score").desc()], F.col("weight"), "rank", down=True)
    total = scores.groupBy("sample").agg(F.sum("weight").alias("tests"))
    adjusted = ranked.join(total, "sample").withColumn(
        "t", F.col("score") + F.log10(F.col("rank").cast("double")) - F.log10(F.col("tests").cast("double"))
    )
    below = Window.partitionBy("sample").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tops = adjusted.groupBy("sample", "bucket").agg(F.max("t").alias("_top")).select(
        "sample", "bucket", F.max("_top").over(below).alias("_below")
    )
    inside = Window.partitionBy("sample", "bucket").orderBy("score")
    best = F.greatest(F.max("t").over(inside), F.col("_below"), F.lit(0.0))
    return adjusted.join(tops, ["sample", "bucket"]).withColumn("qscore", best).select("sample", "score", "weight", "qscore")


def score_values(bins: DataFrame, width: int = BIN) -> DataFrame:
    """(sample, k, lam, weight, score): -log10 p of every distinct height and rate; 0 where k is not above lam."""
    values = bins.groupBy("sample", "k", "lam").agg((F.count(F.lit(1)) * width).alias("weight"))
    return values.withColumn("score", p_score("k", "lam"))


def p_score(k: str, lam: str) -> Column:
    """-log10 p of a height above its rate; 0 where it is not above."""
    return F.when(F.col(k) > F.col(lam), F.greatest(poisson_score(F.col(k), F.col(lam)), F.lit(0.0))).otherwise(0.0)


def score_bins(bins: DataFrame, width: int = BIN) -> DataFrame:
    """Adds ``pscore`` and ``qscore`` (-log10 p and q).

    Each bin is scored where it lies and written, as the scores are read twice: summed by
    value for the q-values, and joined with them. The q-values have unique keys, so a
    common score (one fragment over the background rate) is a skewed side that
    adaptive execution splits.
    """
    scored = stage(bins.withColumn("pscore", p_score("k", "lam")), "bins")
    counts = scored.groupBy("sample", F.col("pscore").alias("score")).agg((F.count(F.lit(1)) * width).alias("weight"))
    q = bh_scores(counts).select("sample", F.col("score").alias("pscore"), "qscore")
    return scored.join(q, ["sample", "pscore"]).select(*TRACK, "bin", "k", "bases", "lam", "pscore", "qscore")


def scored_pileup(fragments: DataFrame, genome_size: float | DataFrame, windows: Sequence[int] = (10000,), width: int = BIN,
                  control: DataFrame | None = None) -> DataFrame:
    """Pileup, rates and scores of all samples at once; the fragments are passed once."""
    bins = stage(pileup_bins(fragments, width), "pileup")
    against = None if control is None else stage(pileup_bins(control, width), "control-pileup")
    lam = local_lambda(
        bins, background(bins, genome_size), windows, width,
        against, None if against is None else background(against, genome_size),
    )
    return score_bins(lam, width)


def _threshold(q: float) -> float:
    return -math.log10(q)


def call_peaks(scored: DataFrame, q: float = 0.05, min_len: int = 100, max_gap: int = 75, width: int = BIN) -> DataFrame:
    """Bins below the q-value, joined up to ``max_gap`` apart, kept from ``min_len`` on."""
    return sweep(scored, {"default": {"q": q, "min_len": min_len, "max_gap": max_gap}}, width).drop("paramset")


def sweep(scored: DataFrame, paramsets: Mapping[str, Mapping[str, float]], width: int = BIN) -> DataFrame:
    """Peaks of one scored table under many settings: (paramset, sample, chrom, s, e)."""
    sets = F.array(*[
        F.struct(
            F.lit(name).alias("paramset"),
            F.lit(_threshold(p.get("q", 0.05))).alias("cut"),
            F.lit(int(p.get("min_len", 100))).cast("bigint").alias("min_len"),
            F.lit(int(p.get("max_gap", 75))).cast("bigint").alias("max_gap"),
        )
        for name, p in paramsets.items()
    ])
    lowest = min(_threshold(p.get("q", 0.05)) for p in paramsets.values())
    hits = (
        scored.filter(F.col("qscore") > lowest)
        .select(*TRACK, "bin", "qscore", F.inline(sets))
        .filter("qscore > cut")
        .select(
            "paramset", *TRACK, "min_len", "max_gap",
            (F.col("bin") * width).alias("s"), ((F.col("bin") + 1) * width).alias("e"),
            idiv(F.col("bin") * width, TILE).alias("tile"),
        )
    )
    joined = join_runs(hits, ["paramset", *TRACK, "min_len", "max_gap"], "max_gap")
    return joined.filter("e - s >= min_len").select("paramset", *TRACK, "s", "e")


def summits(peaks: DataFrame, fragments: DataFrame) -> DataFrame:
    """Adds ``summit``: the middle of the leftmost run of greatest depth inside the peak.

    Only fragments that touch a peak shape the depth inside one.
    """
    peaks = stage(peaks, "peaks")  # read three times
    ids = [F.col(c if c in TRACK else f"b_{c}").alias(c) for c in peaks.columns]
    runs = depth(keep_overlaps(fragments, peaks, TRACK))
    lo, hi = F.greatest("s", "b_s"), F.least("e", "b_e")
    return (
        overlap_join(runs.select(*TRACK, "s", "e", "depth"), peaks, TRACK)
        .select(*ids, "depth", idiv(lo + hi, 2).alias("mid"))
        .groupBy(*peaks.columns)
        .agg(F.max_by("mid", F.struct(F.col("depth"), -F.col("mid"))).alias("summit"), F.max("depth").alias("height"))
    )


def number_rows(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """1-based number in coordinate order within ``keys``, counted tile by tile; contigs of one rank go by name."""
    ranged = df.withColumn("_at", F.struct(chromosome_ordinal("chrom").alias("rank"), "chrom", idiv("s", TILE).alias("tile")))
    order = [F.col("s"), F.col("e")]
    return running_total(ranged, keys, "_at", order, F.lit(1).cast("bigint"), name).drop("_at")


def narrowpeak(peaks: DataFrame, scored: DataFrame, width: int = BIN) -> DataFrame:
    """The ten columns, from peaks with summits and the scores at the summit's bin."""
    keys = [c for c in ("paramset", "sample") if c in peaks.columns]
    at = scored.select(*TRACK, "bin", "k", "lam", "pscore", "qscore")
    p = number_rows(peaks, keys).withColumn("bin", idiv("summit", width)).join(at, [*TRACK, "bin"])
    return p.select(
        *keys, "chrom", "s", "e",
        F.concat("sample", F.lit("_peak_"), F.col("n").cast("string")).alias("name"),
        F.least(F.lit(1000), F.floor(F.round(F.col("qscore") * 10, 6))).cast("bigint").alias("score"),
        F.lit(".").alias("strand"),
        ((F.col("k") + 1) / (F.col("lam") + 1)).alias("signal"),
        "pscore", "qscore", (F.col("summit") - F.col("s")).alias("offset"),
    )
