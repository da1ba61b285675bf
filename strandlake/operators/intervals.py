"""Genomic intervals: overlap, exclusion, merging, selection by id.

Every range operator turns the range condition into an equality on a bin, so that
Spark hashes on (keys, bin) instead of on some two dozen chromosomes. No side is
broadcast by hint: Spark broadcasts what its own size estimate or, at run time,
its measured size allows, and otherwise splits hot bins (skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import idiv
from ..functions.tiling import TILE, clip_to_tiles, depth_runs, join_runs, tile_range

# fixed value: beginning of the header line that counts the peaks left, which ends with a space
PEAKS_LEFT = "# peaks remaining after blacklist filtering "

CHROM = ("chrom",)
LOOKUPS = [1 << n for n in (14, 18, 22, 26, 32)]  # bases per bin where a row looks up one interval
NEAR = 1 << 11  # bases per bin where intervals meet single positions
LONGEST = 1 << 32  # bases of the widest bins
STRETCH = 1 << 20  # bases within which merged intervals are ordered by one task
CELLS = 16  # lists of starts that a bin is cut into
CELL_ROWS = 1 << 12  # rows of a list, about


def _levels(width: int) -> int:
    """Number of levels of nested bins, each eight times as wide as the one below, up to the longest sequence."""
    n = 1
    while width << 3 * (n - 1) < LONGEST:
        n += 1
    return n


def _level_of(s: str, e: str, width: int) -> Column:
    """The finest level whose bins are no shorter than the interval, so that it touches two of them at most."""
    pick = F.lit(_levels(width) - 1)
    for n in range(_levels(width) - 2, -1, -1):
        pick = F.when(F.col(e) - F.col(s) <= width << 3 * n, n).otherwise(pick)
    return pick


def _listed(df: DataFrame, s: str, e: str, width: int, other: Column | None, home: int, visit: int) -> DataFrame:
    """Rows under (_lev, _bin, _way): in the level that holds them, and visiting coarser ones.

    ``other``: the levels that the other side uses; None visits them all. ``home`` and ``visit``
    are the ways of both. A side that knows the other's levels waits at home for its
    visitors too, where it has any. A point touches one bin.
    """
    top = _levels(width) - 1
    own, none = F.col("_own"), F.array().cast("array<int>")
    rows = df.withColumn("_own", _level_of(s, e, width))
    if other is None:
        visits = F.when(own < top, F.transform(F.sequence(own + 1, F.lit(top)), lambda n: 4 * n + visit)).otherwise(none)
        listed = F.concat(F.array(4 * own + home), visits)
    else:
        rows = rows.withColumn("_other", other)
        coarser = F.transform(F.filter("_other", lambda n: n > own), lambda n: 4 * n + visit)
        listed = F.concat(
            F.array(4 * own + home), F.when(F.array_max("_other") > own, coarser).otherwise(none),
            F.when(F.array_min("_other") < own, F.array(4 * own + 3 - home)).otherwise(none))
    lev = F.shiftright("_code", 2)
    wide = F.call_function("shiftleft", F.lit(width).cast("bigint"), 3 * lev)
    bins = F.sequence(idiv(s, wide), idiv(F.greatest(F.col(e) - 1, F.col(s)), wide))
    return rows.select(*df.columns, F.explode(listed).alias("_code")).select(
        *df.columns, lev.alias("_lev"), F.explode(bins).alias("_bin"), F.col("_code").bitwiseAND(F.lit(3)).alias("_way"))


def _in_cells(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], width: Column) -> DataFrame:
    """Rows that ``_listed`` has put into bins, as lists: one row for those of a bin that start close together.

    ``_lo`` and ``_hi`` bound what a list covers. Where very many start together, a hash deals
    them out to several lists.
    """
    cell = [*keys, "_lev", "_bin", "_way", "_cell"]
    kinds = dict(rows.dtypes)
    whole = F.xxhash64(*[F.col(c) for c in cols if "map<" not in kinds[c]])
    for k in keys:  # what matches nothing would be one list
        rows = rows.filter(F.col(k).isNotNull())
    rows = rows.withColumn("_cell", idiv("b_s", F.greatest(idiv(width, CELLS), F.lit(1).cast("bigint"))))
    crowded = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CELL_ROWS)
    part = F.coalesce(F.pmod(whole, idiv("_n", CELL_ROWS) + 1), F.lit(0).cast("bigint"))
    return (
        rows.join(crowded, cell, "left").withColumn("_part", part)
        .groupBy(*cell, "_part")
        .agg(F.min("b_s").alias("_lo"), F.max("b_e").alias("_hi"), F.collect_list(F.struct(*cols)).alias("_list"))
        .drop("_cell", "_part")
    )


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM, bin_width: int = 1 << 11) -> DataFrame:
    """All pairs with a.s < b.e and b.s < a.e; columns of b other than the keys get the prefix ``b_``.

    Bins are nested, each level eight times as wide as the one below. An interval of any
    length lies in the level whose bins just hold it, in two bins at most, and visits
    coarser levels, in two bins at most of each: those of a only the levels that b's
    intervals lie in, those of b (the side of fewer rows) all. Two intervals meet in the
    coarser one of their levels and are kept in the first bin they share there, so nothing
    has to be made distinct afterwards. Visitors never meet visitors. The rows of b in a bin
    are lists, by start: a row of a is joined with a list it may touch, and the list is read
    in one go, which costs a fraction of a joined row for each pair. A dense bin is
    split by adaptive execution, which measures it.
    """
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in keys])
    cols = [c for c in right.columns if c not in keys]
    levels = b.agg(F.collect_set(_level_of("s", "e", bin_width))).scalar()
    # way 1: a at home or visiting meets b at home; way 2: a at home meets visitors of b
    left = _listed(a, "s", "e", bin_width, levels, 1, 1)
    width = F.call_function("shiftleft", F.lit(bin_width).cast("bigint"), 3 * F.col("_lev"))
    right = _in_cells(_listed(right, "b_s", "b_e", bin_width, None, 1, 2), keys, cols, width)
    # least place of a bin; quotients of negative places are cut towards 0
    start = F.when(F.col("_bin") > 0, F.col("_bin") * width).otherwise((F.col("_bin") - 1) * width + 1)
    kept = [*keys, *[c for c in a.columns if c not in keys]]
    return (
        left.join(right, [*keys, "_lev", "_bin", "_way"])
        .filter((F.col("s") < F.col("_hi")) & (F.col("_lo") < F.col("e")))
        .select(*kept, start.alias("_from"), "_list")  # once a list: beside ``inline`` each pair would work it out
        .select(*kept, "_from", F.inline("_list"))
        # of the bins that a pair shares, only the first does not start after both of its starts
        .filter((F.col("s") < F.col("b_e")) & (F.col("b_s") < F.col("e")) & (F.greatest("s", "b_s") >= F.col("_from")))
        .drop("_from")
    )


def merge_intervals(df: DataFrame, keys: Sequence[str] = CHROM, gap: int = 0) -> DataFrame:
    """Union of overlapping or touching intervals (or up to ``gap`` apart)."""
    pieces = clip_to_tiles(df.select(*keys, "s", "e")).groupBy(*keys, "tile", "s").agg(F.max("e").alias("e"))
    return join_runs(pieces, keys, gap)


def _level(length: Column, of: Sequence[Column | int]) -> Column:
    """The entry of ``of`` for the narrowest look-up width that holds ``length``."""
    pick = F.lit(of[-1])
    for w, value in list(zip(LOOKUPS, of))[-2::-1]:
        pick = F.when(length <= w, value).otherwise(pick)
    return pick


def _with_end_before(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``before``: the end of the interval ahead of each of disjoint ones, 0 for the first.

    Inside stretches of the genome first; across them only their last ends are ordered.
    """
    ranged = df.withColumn("_range", idiv("s", STRETCH))
    along = Window.partitionBy(*keys).orderBy("_range")
    ends = ranged.groupBy(*keys, "_range").agg(F.max("e").alias("_last")).select(
        *keys, "_range", F.lag("_last", 1, 0).over(along).alias("_ahead"))
    inside = Window.partitionBy(*keys, "_range").orderBy("s")
    return (
        ranged.join(ends, [*keys, "_range"]).withColumn("before", F.coalesce(F.lag("e").over(inside), F.col("_ahead")))
        .drop("_range", "_ahead")
    )


def _first_reached(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Joins each row of a with the one interval that decides whether it touches b at all.

    Of disjoint intervals, [s, e) can only miss them all if it misses the first that
    ends after s: the one with ``before`` <= s < its end, ``before`` being the end of
    its predecessor. A row no longer than w need not look further than w ahead, so an
    interval is listed under the bins of width w from w before its start to its end,
    a few for each of five widths. A row of any length is settled in the bin of its
    start, at the narrowest width that holds it, and never copied.
    """
    widths = F.explode(F.array(*[F.lit(w) for w in LOOKUPS])).alias("b_width")
    ahead = F.greatest(F.col("before"), F.col("s") - F.col("b_width"))
    reach = (
        _with_end_before(merge_intervals(b.filter("s < e"), keys), keys)
        .select("*", widths)
        .select(
            *[F.col(k).alias(f"b_{k}") for k in keys],
            F.col("s").alias("b_s"),
            F.col("e").alias("b_e"),
            F.col("before").alias("b_before"),
            "b_width",
            F.explode(F.sequence(idiv(ahead, F.col("b_width")), idiv(F.col("e") - 1, F.col("b_width")))).alias("b_bin"),
        )
    )
    length = F.greatest(F.col("e") - F.col("s"), F.lit(1))
    width = _level(length, LOOKUPS)
    at = _level(length, [idiv("s", w) for w in LOOKUPS])
    cond = (width == F.col("b_width")) & (at == F.col("b_bin")) & (F.col("b_before") <= F.col("s")) & (F.col("s") < F.col("b_e"))
    kinds = dict(a.dtypes)
    whole = F.xxhash64(*[F.col(c) for c in a.columns if "map<" not in kinds[c]])
    for k in keys:
        own = F.col(k)
        if kinds[k] == "string":  # rows without a place match nothing; a hash keeps them out of one task
            own = F.coalesce(own, F.concat(F.lit("\0"), F.pmod(whole, F.lit(1 << 12)).cast("string")))
        cond = cond & (own == F.col(f"b_{k}"))
    if how != "left":
        cond = cond & _reaches()
    return a.join(reach, cond, how)


def _reaches() -> Column:
    return F.col("b_s") < F.greatest("e", F.col("s") + 1)  # a point counts as one base


def place_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """Chromosome, and genome where both tables name it: samples of several genomes meet their own regions only."""
    return ["genome", "chrom"] if "genome" in a.columns and "genome" in b.columns else ["chrom"]


def exclude_overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM) -> DataFrame:
    """Rows of a that share no base with any interval of b; an empty b excludes nothing."""
    return _first_reached(a, b, keys, "left_anti")


def keep_overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM) -> DataFrame:
    """Rows of a that share a base with some interval of b."""
    return _first_reached(a, b, keys, "left_semi")


def flag_overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM, name: str = "hit") -> DataFrame:
    """All rows of a, with whether they share a base with some interval of b."""
    return _first_reached(a, b, keys, "left").select(*a.columns, F.coalesce(_reaches(), F.lit(False)).alias(name))


def points_in(points: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM) -> DataFrame:
    """Points (s = e, or one base) with b.s <= s < b.e."""
    return keep_overlaps(points, b, keys)


def exclude_peaks_and_summits(peaks: DataFrame, summits: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both filtered on their own: a peak may go while its summit, outside the region, stays."""
    return exclude_overlaps(peaks, b, place_keys(peaks, b)), exclude_overlaps(summits, b, place_keys(summits, b))


def overlap_counts(a: DataFrame, b: DataFrame, keys: Sequence[str] = CHROM, name: str = "n") -> DataFrame:
    """Number of intervals of b that touch each row of a (rows of a no shorter than a base).

    n = depth of b at a.s + starts of b inside (a.s, a.e). Both come from one table
    with a row per position of b, so no (a, b) pair is ever formed.
    """
    spans = a.select(*keys, "s", "e").distinct().select("*", F.explode(tile_range("s", "e", NEAR)).alias("bin"))
    runs = depth_runs(b, keys, width=NEAR, births=True).select(
        *keys, F.col("tile").alias("bin"), F.col("s").alias("p"), F.col("e").alias("q"), "depth", "born"
    )
    at_start = (F.col("p") <= F.col("s")) & (F.col("s") < F.col("q"))
    inside = (F.col("s") < F.col("p")) & (F.col("p") < F.col("e"))
    sums = (
        spans.join(runs, [*keys, "bin"])
        .filter(at_start | inside)
        .groupBy(*keys, "s", "e")
        .agg(F.sum(F.when(at_start, F.col("depth")).otherwise(F.col("born"))).alias(name))
    )
    return a.join(sums, [*keys, "s", "e"], "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def overlapping_rows(df: DataFrame, keys: Sequence[str] = CHROM) -> DataFrame:
    """Rows that share a base with another row of the same table: the violations of disjointness."""
    return overlap_counts(df, df, keys, "_n").filter("_n > 1").drop("_n")


def is_disjoint(df: DataFrame, keys: Sequence[str] = CHROM) -> DataFrame:
    """One row per keys: whether the intervals are disjoint, and how many are not."""
    bad = overlapping_rows(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("violations"))
    return (
        df.select(*keys).distinct().join(bad, list(keys), "left")
        .withColumn("violations", F.coalesce("violations", F.lit(0).cast("bigint")))
        .withColumn("disjoint", F.col("violations") == 0)
    )


def keep_by_id(peaks: DataFrame, bed: DataFrame, peak_id: str = "id", bed_id: str = "name") -> DataFrame:
    """Peaks whose id occurs in the BED table; repeats of a peak are kept, repeats in the BED do not matter."""
    return peaks.join(bed.select(F.col(bed_id).alias(peak_id)).distinct(), peak_id, "left_semi")


def rewrite_header(header: DataFrame, bed: DataFrame, line: int = 4) -> DataFrame:
    """Replaces header line 4 by the number of BED lines, repeats counted."""
    total = bed.agg(F.count(F.lit(1))).scalar()
    counted = F.concat(F.lit(PEAKS_LEFT), total.cast("string"), F.lit(" "))
    return header.select("line_no", F.when(F.col("line_no") == line, counted).otherwise(F.col("text")).alias("text"))


def peaks_to_bed(peaks: DataFrame, score: str | Column = "score") -> DataFrame:
    """1-based closed positions to 0-based half-open BED."""
    return peaks.select(
        "chrom", (F.col("start") - 1).alias("s"), F.col("end").alias("e"), F.col("id").alias("name"), score, "strand"
    )


def region_read_names(regions: DataFrame, alignments: DataFrame) -> DataFrame:
    """Clean names of the reads that touch any region, each once."""
    from .alignments import distinct_names

    return distinct_names(keep_overlaps(alignments, regions))
