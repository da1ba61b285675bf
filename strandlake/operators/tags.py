"""Tag directories, and peaks called from 5' ends against a control."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import idiv
from ..functions.stats import poisson_score
from ..functions.tiling import TILE, tile_range, with_halo
from .intervals import PEAKS_LEFT, merge_intervals

TRACK = ["sample", "chrom"]
NEAR = 1 << 10  # bases per bin where regions meet single positions


def tag_directory(df: DataFrame) -> DataFrame:
    """Tags by 5' position and strand, every tag counted."""
    five = F.when(F.col("strand") == "-", F.col("e") - 1).otherwise(F.col("s"))
    return df.groupBy(*TRACK, five.alias("p"), "strand").agg(F.count(F.lit(1)).alias("n"))


def tag_totals(tags: DataFrame) -> DataFrame:
    return tags.groupBy("sample").agg(
        F.sum("n").alias("tags"),
        F.count(F.lit(1)).alias("positions"),
        (F.sum("n") / F.count(F.lit(1))).alias("tags_per_position"),
    )


#: a transform's error stays below a quarter while the norms' product does not exceed this
EXACT_NORM = 1e13
#: bits of a part of a count, where counts are too large for one transform
LIMB = 12


def _smooth(n: int) -> int:
    """The least product of 2, 3 and 5 that is at least n, a length at which transforms are fast."""
    best = 1 << (n - 1).bit_length()
    for five in (1, 5, 25, 125):
        for three in (1, 3, 9, 27, 81):
            odd = five * three
            best = min(best, odd << max(0, (-(-n // odd) - 1).bit_length()))
    return best


def shifted_products(pairs: Sequence[tuple[np.ndarray, np.ndarray]], reach: int) -> np.ndarray:
    """Sum over the pairs of sum_i a[i] * b[i + d] for d = 0 to ``reach``, from vectors of counts; exact as far as it fits a long.

    b is ``reach`` longer than a. Few counts are multiplied one by one or shift by shift; else the products
    of all shifts come from one transform, at a cost that does not depend on ``reach``. Counts
    too large for exact rounding are transformed in parts of 12 bits.
    """
    size = _smooth(max(len(b) for _, b in pairs) + 1)
    places = sum(np.count_nonzero(a) for a, _ in pairs)
    if places * (reach + 1) <= 40 * size:
        out = np.zeros(reach + 1, np.int64)
        for a, b in pairs:
            at = np.flatnonzero(a)
            if len(at) <= reach:
                for i in at:
                    out += a[i] * b[i : i + reach + 1]
            else:
                for d in range(reach + 1):
                    out[d] += a[at] @ b[at + d]
        return out
    norm = sum(float(np.linalg.norm(a.astype(float)) * np.linalg.norm(b.astype(float))) for a, b in pairs)
    if norm <= EXACT_NORM:
        total = sum(np.conj(np.fft.rfft(a, size)) * np.fft.rfft(b, size) for a, b in pairs)
        return np.rint(np.fft.irfft(total, size)[: reach + 1]).astype(np.int64)
    out = np.zeros(reach + 1, np.int64)
    for a, b in pairs:
        low, high = a & ((1 << LIMB) - 1), a >> LIMB
        if high.any():
            out += shifted_products([(low, b)], reach) + (shifted_products([(high, b)], reach) << LIMB)
        else:
            out += shifted_products([(a, b & ((1 << LIMB) - 1))], reach) + (shifted_products([(a, b >> LIMB)], reach) << LIMB)
    return out


def tag_autocorrelation(tags: DataFrame, max_dist: int = 1000, tile: int = 1 << 17) -> DataFrame:
    """Sum of count products by distance, on the same and on the opposite strand.

    Same strand: both orders of a pair are one (d > 0). Opposite strand: the minus tag
    lies d bases after the plus tag. A task holds two count vectors of one tile and
    the bases after it, and correlates them block by block; pairs are never listed.
    """
    near = tags.withColumn("home", idiv("p", tile)).withColumn(
        "tile", F.explode(F.sequence(F.greatest(idiv(F.col("p") - max_dist, tile), F.lit(0)), F.col("home")))
    )

    def products(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sample, _, t = key
        plus, minus = np.zeros(tile + max_dist, np.int64), np.zeros(tile + max_dist, np.int64)
        at = (pdf["p"] - t * tile).to_numpy()
        forward = (pdf["strand"] != "-").to_numpy()
        n = pdf["n"].to_numpy(dtype=np.int64)
        np.add.at(plus, at[forward], n[forward])
        np.add.at(minus, at[~forward], n[~forward])
        same = shifted_products([(plus[:tile], plus), (minus[:tile], minus)], max_dist)
        same[0] = 0
        opposite = shifted_products([(plus[:tile], minus)], max_dist)
        return pd.DataFrame({"sample": sample, "distance": np.arange(max_dist + 1), "same": same, "opposite": opposite})

    parts = near.select(*TRACK, "tile", "p", "strand", "n").groupBy("sample", "chrom", "tile").applyInPandas(
        products, "sample string, distance bigint, same bigint, opposite bigint"
    )
    return parts.groupBy("sample", "distance").agg(F.sum("same").alias("same"), F.sum("opposite").alias("opposite"))


def fragment_length(correlation: DataFrame, minimum: int = 50) -> DataFrame:
    """Distance of the greatest opposite-strand sum from ``minimum`` on; the shortest of equals."""
    return (
        correlation.filter(F.col("distance") >= minimum)
        .groupBy("sample")
        .agg(F.max_by("distance", F.struct(F.col("opposite"), -F.col("distance"))).alias("fragment_length"))
    )


def centre_tags(tags: DataFrame, lengths: DataFrame) -> DataFrame:
    """Tags moved by half the fragment length of their sample (sample, fragment_length) towards the fragment's middle."""
    half = F.coalesce(idiv("fragment_length", 2), F.lit(0).cast("bigint"))
    p = F.when(F.col("strand") == "-", F.greatest(F.col("p") - half, F.lit(0))).otherwise(F.col("p") + half)
    return tags.join(lengths, "sample", "left").select(*TRACK, p.alias("p"), "strand", "n").groupBy(
        *TRACK, "p", "strand").agg(F.sum("n").alias("n"))


def _positions(tags: DataFrame, shift: int = 0) -> DataFrame:
    p = F.when(F.col("strand") == "-", F.greatest(F.col("p") - shift, F.lit(0))).otherwise(F.col("p") + shift)
    return tags.groupBy(*TRACK, p.alias("p")).agg(F.sum("n").alias("n"))


def window_tags(tags: DataFrame, width: int, reach: int = 0, shift: int = 0) -> DataFrame:
    """Tags within width / 2 of each tag position, right for rows up to ``reach`` outside a tile."""
    half = width // 2
    near = with_halo(_positions(tags, shift), "p", half + reach, TILE)
    along = Window.partitionBy(*TRACK, "tile").orderBy("p")
    return near.withColumn("tags", F.sum("n").over(along.rangeBetween(-half, half)))


def _reaching(windows: DataFrame, threshold: int | DataFrame) -> DataFrame:
    """Windows with as many tags as asked for; a table (sample, threshold) asks each sample for its own, and drops the others."""
    if isinstance(threshold, DataFrame):
        asked = windows.join(threshold.select("sample", F.col("threshold").alias("_asked")), "sample")
        return asked.filter(F.col("tags") >= F.col("_asked")).drop("_asked")
    return windows.filter(F.col("tags") >= threshold)


def find_peaks_factor(tags: DataFrame, width: int = 200, min_dist: int = 400, threshold: int | DataFrame = 10,
                      shift: int = 0) -> DataFrame:
    """Fixed-width peaks: windows at or above the threshold that no other within ``min_dist`` exceeds.

    Of equal windows the leftmost stays. ``threshold`` may be a table (sample, threshold), as ``fdr_cutoff`` gives it.
    """
    near = window_tags(tags, width, min_dist, shift)
    along = Window.partitionBy(*TRACK, "tile").orderBy("p")
    left = F.max("tags").over(along.rangeBetween(-min_dist, -1))
    right = F.max("tags").over(along.rangeBetween(1, min_dist))
    top = (F.coalesce(left, F.lit(0)) < F.col("tags")) & (F.coalesce(right, F.lit(0)) <= F.col("tags"))
    half = width // 2
    return (
        _reaching(near.withColumn("top", top).filter(F.col("own") & F.col("top")), threshold)
        .select(*TRACK, F.greatest(F.col("p") - half, F.lit(0)).alias("s"), (F.col("p") + half).alias("e"), "p", "tags")
    )


def find_peaks_region(tags: DataFrame, width: int = 500, min_dist: int = 1000, threshold: int | DataFrame = 20,
                      shift: int = 0) -> DataFrame:
    """Variable-width peaks: windows at or above the threshold, joined up to ``min_dist`` apart, tags recounted."""
    half = width // 2
    seeds = _reaching(window_tags(tags, width, 0, shift).filter("own"), threshold).select(
        *TRACK, F.greatest(F.col("p") - half, F.lit(0)).alias("s"), (F.col("p") + half).alias("e")
    )
    regions = merge_intervals(seeds, TRACK, min_dist)
    return count_tags(regions, _positions(tags, shift), "tags")


def count_tags(peaks: DataFrame, tags: DataFrame, name: str) -> DataFrame:
    """Adds the number of tags with s <= p < e, from one row per position."""
    spans = peaks.select(*TRACK, "s", "e").distinct()
    at = spans.select("*", F.explode(tile_range("s", "e", NEAR)).alias("bin"))
    hits = at.join(tags.select(*TRACK, "p", "n", idiv("p", NEAR).alias("bin")), [*TRACK, "bin"])
    sums = hits.filter("s <= p and p < e").groupBy(*TRACK, "s", "e").agg(F.sum("n").alias(name))
    return peaks.join(sums, [*TRACK, "s", "e"], "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def control_filter(peaks: DataFrame, tags: DataFrame, control: DataFrame, fold: float = 4.0) -> DataFrame:
    """Peaks whose share of target tags is ``fold`` times that of control tags (plus one).

    ``control`` holds the tags of the control under the name of the treated sample. A
    control without any tag cannot speak against a peak: all peaks stay, with null ``fold``.
    """
    counted = count_tags(count_tags(peaks.drop("tags"), _positions(tags), "tags"), _positions(control), "control_tags")
    totals = tags.groupBy("sample").agg(F.sum("n").alias("total")).join(
        control.groupBy("sample").agg(F.sum("n").alias("control_total")), "sample", "left"
    )
    share = F.col("tags") / F.col("total")
    other = (F.col("control_tags") + 1) / F.col("control_total")
    return (
        counted.join(totals, "sample").withColumn("fold", share / other)
        .filter(F.col("control_total").isNull() | (share >= fold * other)).drop("total", "control_total")
    )


def fdr_cutoff(candidates: DataFrame, tags: DataFrame, genome_size: float, width: int, fdr: float = 0.001) -> DataFrame:
    """Smallest tag count at which expected / observed peaks fall to the rate asked for, per sample.

    Expected counts come from a Poisson tail at the sample's mean rate, once per
    distinct tag count.
    """
    rate = tags.groupBy("sample").agg((F.sum("n") * F.lit(width / float(genome_size))).alias("rate"))
    counts = candidates.groupBy("sample", "tags").agg(F.count(F.lit(1)).alias("n"))
    upward = Window.partitionBy("sample").orderBy(F.col("tags").desc())
    observed = counts.withColumn("observed", F.sum("n").over(upward)).join(rate, "sample").filter("tags > rate")
    expected = F.lit(genome_size / width) * F.pow(F.lit(10.0), -poisson_score(F.col("tags"), F.col("rate")))
    return (
        observed.withColumn("ratio", expected / F.col("observed"))
        .filter(F.col("ratio") <= fdr)
        .groupBy("sample")
        .agg(F.min("tags").alias("threshold"), F.min_by("observed", "tags").alias("observed"),
             F.min_by("ratio", "tags").alias("ratio"))
    )


def peak_rows(peaks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of a peak report: id, 1-based position, strand, tag count."""
    return peaks.select(
        *keys, "sample", F.concat_ws("-", "chrom", (F.col("s") + 1).cast("string"), F.col("e").cast("string")).alias("id"),
        "chrom", (F.col("s") + 1).alias("start"), F.col("e").alias("end"), F.lit("+").alias("strand"),
        F.col("tags").alias("score"),
    )


def filtered_header(header: DataFrame, rows: DataFrame, keys: Sequence[str] = (), line: int = 4) -> DataFrame:
    """Header lines with the fourth replaced by the number of rows that are left, per sample (and keys)."""
    by = [*keys, "sample"]
    left = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_left"))
    text = F.concat(F.lit(PEAKS_LEFT), F.coalesce("_left", F.lit(0)).cast("string"), F.lit(" "))
    return header.join(left, by, "left").select(
        *by, "line_no", F.when(F.col("line_no") == line, text).otherwise(F.col("text")).alias("text"))


def report_header(peaks: DataFrame, tags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Header lines of a peak report, four facts per sample (and keys; those without a peak have no header then)."""
    found = peaks.groupBy(*keys, "sample").agg(F.count(F.lit(1)).alias("peaks"), F.sum("tags").alias("in_peaks"))
    facts = tags.groupBy("sample").agg(F.sum("n").alias("total")).join(found, "sample", "inner" if keys else "left")

    def num(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("string")

    lines = [
        F.concat(F.lit("# sample = "), F.col("sample")),
        F.concat(F.lit("# total tags = "), num("total")),
        F.concat(F.lit("# tags in peaks = "), num("in_peaks")),
        F.concat(F.lit("# total peaks = "), num("peaks")),
    ]
    return facts.select(*keys, "sample", F.posexplode(F.array(*lines)).alias("i", "text")).select(
        *keys, "sample", (F.col("i") + 1).alias("line_no"), "text"
    )
