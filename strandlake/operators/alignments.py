"""Alignment records: flags, order, duplicates and mate pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import arith as A
from ..functions.names import clean_read_name
from ..sources.genome import chromosome_ordinal, genome_constants, included_chromosomes

# fixed values: (bits required, bits excluded) of the shipped settings
PRUNE_ATAC = (0x3, 0xD0C)
PRUNE_CHIP_PAIRED = (0x3, 0xF0C)
PRUNE_CHIP_SINGLE = (0x0, 0xF04)

MATE_KEY = ["sample", "qname"]


def filter_flags(df: DataFrame, require: int = 0, exclude: int = 0) -> DataFrame:
    return df.filter(A.has_all("flag", require) & ~A.has_any("flag", exclude))


def keep_chromosomes(df: DataFrame, genome: str | None = None) -> DataFrame:
    """Rows on the chromosomes analysed for a genome.

    With one genome the names are literals, so they prune partitions and reach the
    scan. Without it the table's own ``genome`` column decides row by row.
    """
    if genome:
        return df.filter(F.col("chrom").isin(included_chromosomes(genome)))
    kept = genome_constants(df.sparkSession).select("genome", "chrom")
    return df.join(F.broadcast(kept), ["genome", "chrom"], "left_semi")  # under 150 rows, constant


def coordinate_sort(df: DataFrame) -> DataFrame:
    """Global order by chromosome ordinal and position; the name splits a position that is very deep."""
    order = [chromosome_ordinal("chrom"), F.col("chrom"), F.col("s"), F.col("qname")]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def name_sort(df: DataFrame) -> DataFrame:
    return df.repartitionByRange("qname", "mate").sortWithinPartitions("qname", "mate")


def region(df: DataFrame, chrom: str, s: int, e: int) -> DataFrame:
    """Records that touch [s, e); plain predicates, so partitions and row groups are pruned."""
    return df.filter((F.col("chrom") == chrom) & (F.col("s") < e) & (F.col("e") > s))


def _clip_length(cigar: str, side: str) -> Column:
    pattern = r"^(?:(\d+)H)?(?:(\d+)S)?" if side == "left" else r"(?:(\d+)S)?(?:(\d+)H)?$"
    parts = [F.regexp_extract(cigar, pattern, i) for i in (1, 2)]
    return sum((F.when(p == "", 0).otherwise(p.try_cast("bigint")) for p in parts), F.lit(0).cast("bigint"))


def unclipped(df: DataFrame) -> DataFrame:
    """Adds ``us``, ``ue``: the ends with soft and hard clips put back."""
    if "cigar" not in df.columns:
        return df.withColumn("us", F.col("s")).withColumn("ue", F.col("e"))
    return df.withColumn("us", F.col("s") - F.coalesce(_clip_length("cigar", "left"), F.lit(0))).withColumn(
        "ue", F.col("e") + F.coalesce(_clip_length("cigar", "right"), F.lit(0))
    )


def quality_sum(qual: str | Column, floor: int = 15) -> Column:
    """Sum of base qualities of at least ``floor`` (text encoded with offset 33); null counts 0.

    Over the bytes of a whole Arrow batch at once, some ten times faster than a
    lambda per base.
    """

    @F.arrow_udf("bigint")
    def total(q: pa.Array) -> pa.Array:
        _, offsets, data = q.buffers()
        width = np.int64 if pa.types.is_large_string(q.type) else np.int32
        at = np.frombuffer(offsets, dtype=width)[q.offset : q.offset + len(q) + 1]
        value = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]].astype(np.int64) - 33
        value[value < floor] = 0
        upto = np.concatenate([[0], np.cumsum(value)])
        return pa.array(upto[at[1:] - at[0]] - upto[at[:-1] - at[0]])

    return total(A.col(qual))


def is_candidate() -> Column:
    """Mapped, primary, not supplementary."""
    return ~A.has_any("flag", A.UNMAPPED | A.SECONDARY | A.SUPPLEMENTARY)


def mark_duplicates(df: DataFrame) -> DataFrame:
    """Sets bit 0x400 on every copy but the best; keeps all rows.

    Copies share their outer ends and strands. The best copy of a position is a
    partial aggregate, never a window: a position may hold any share of the reads.
    Winners come back by read name, which is also the key of the pair filter, so the
    full records are shuffled once. Several primary records of one mate (a malformed
    name) are judged by the first of them.
    """
    cols = df.columns
    quality = quality_sum("qual") if "qual" in cols else F.lit(0)
    second = F.coalesce(F.col("mate") == 2, F.lit(False))
    record = F.struct("chrom", "us", "ue", "strand", "q")
    by_name = (
        unclipped(df.filter(is_candidate()))
        .withColumn("q", quality.cast("bigint"))
        .groupBy(*MATE_KEY)
        .agg(F.min(F.when(~second, record)).alias("r1"), F.min(F.when(second, record)).alias("r2"))
    )

    def unit(m: int, chrom: Column, us: Column, ue: Column, st: Column, q: Column) -> Column:
        return F.struct(
            F.lit(m).alias("m"), chrom.alias("chrom"), us.alias("us"), ue.alias("ue"), st.alias("st"), q.alias("q")
        )

    def single(m: int) -> Column:
        r = F.col(f"r{m}")
        five_prime = F.when(r["strand"] == "-", r["ue"]).otherwise(r["us"])
        return F.when(
            r.isNotNull(), unit(m, r["chrom"], five_prime, F.lit(-1).cast("bigint"), r["strand"], r["q"])
        )

    r1, r2 = F.col("r1"), F.col("r2")
    def placed(r: Column) -> Column:
        return F.struct(r["us"].alias("us"), r["ue"].alias("ue"), r["strand"].alias("strand"))

    # strands in order of position, whichever mate lies there
    left, right = F.least(placed(r1), placed(r2)), F.greatest(placed(r1), placed(r2))
    pair = unit(
        0, r1["chrom"], F.least(r1["us"], r2["us"]), F.greatest(r1["ue"], r2["ue"]),
        F.concat(left["strand"], right["strand"]), r1["q"] + r2["q"],
    )
    paired = r1.isNotNull() & r2.isNotNull() & (r1["chrom"] == r2["chrom"])
    units = by_name.select(
        *MATE_KEY, F.explode(F.when(paired, F.array(pair)).otherwise(F.array_compact(F.array(single(1), single(2))))).alias("u")
    ).select(*MATE_KEY, "u.*")
    best = units.groupBy("sample", "chrom", "us", "ue", "st").agg(
        F.min(F.struct((-F.col("q")).alias("q"), "qname", "m")).alias("w")
    )
    winners = best.groupBy("sample", F.col("w.qname").alias("qname")).agg(
        *[F.bool_or(F.col("w.m") == i).alias(f"w{i}") for i in (0, 1, 2)]
    )
    own = F.when(second, F.col("w2")).otherwise(F.col("w1"))
    won = F.coalesce(F.col("w0") | own, F.lit(False))
    cleared = F.col("flag").bitwiseAND(F.lit(~A.DUPLICATE))
    marked = F.when(is_candidate() & ~won, cleared.bitwiseOR(F.lit(A.DUPLICATE))).otherwise(cleared)
    return df.join(winners, MATE_KEY, "left").withColumn("flag", marked).select(*cols)


def duplicate_metrics(df: DataFrame) -> DataFrame:
    """Per sample: candidate and duplicate reads, paired and single apart, and their rate."""
    single = ~A.has_any("flag", A.PAIRED) | A.has_any("flag", A.MATE_UNMAPPED)
    dup = A.has_any("flag", A.DUPLICATE)
    return (
        df.filter(is_candidate())
        .groupBy("sample")
        .agg(
            F.count_if(~single).alias("pair_reads"),
            F.count_if(~single & dup).alias("pair_duplicates"),
            F.count_if(single).alias("single_reads"),
            F.count_if(single & dup).alias("single_duplicates"),
            (F.count_if(dup) / F.count(F.lit(1))).alias("duplicate_rate"),
        )
    )


def read_failure(x0: str | Column, threshold: int) -> Column:
    """Reason a read fails the hit-count test, or null."""
    x = A.col(x0)
    return F.when(x.isNull(), F.lit("NO_X0")).when(x > threshold, F.lit("HI_X0"))


def tag_failures(df: DataFrame, threshold: int) -> DataFrame:
    """Writes the reason into tag ``X?`` of a ``tags`` map, or into a column where there is no map."""
    why = read_failure("x0", threshold)
    if "tags" not in df.columns:
        return df.withColumn("x_fail", why)
    kept = F.map_filter("tags", lambda k, _: k != F.lit("X?"))
    return df.withColumn("tags", F.when(why.isNull(), kept).otherwise(F.map_concat(kept, F.create_map(F.lit("X?"), why))))


def _by_name() -> Window:
    return Window.partitionBy(*MATE_KEY).orderBy("mate", "flag", "chrom", "s", "e", F.col("x0").asc_nulls_first())


def consecutive_pairs(df: DataFrame) -> DataFrame:
    """Neighbours of equal name in name order, two by two; adds ``pair`` and ``complete``.

    The group is one read name: the few records of a single template.
    """
    rn = F.row_number().over(_by_name())
    n = F.count(F.lit(1)).over(Window.partitionBy(*MATE_KEY))
    return (
        df.withColumn("rn", rn)
        .withColumn("complete", F.col("rn") <= n - n % 2)
        .withColumn("pair", idiv_pair(F.col("rn")))
        .drop("rn")
    )


def idiv_pair(rn: Column) -> Column:
    return A.idiv(rn - 1, 2)


def orphans(df: DataFrame) -> DataFrame:
    """Records without a partner of equal name, which the pair filter drops."""
    return consecutive_pairs(df).filter(~F.col("complete")).drop("pair", "complete")


def pair_fate(df: DataFrame, mode: str) -> DataFrame:
    """Keeps or drops whole pairs by their number of ``failed`` reads: ``both`` or ``one`` must fail to drop."""
    if mode not in ("both", "one"):
        raise ValueError(f"mode must be 'both' or 'one', not {mode!r}")
    w = Window.partitionBy(*MATE_KEY, "pair")
    allowed = 1 if mode == "both" else 0
    return (
        df.withColumn("n_failed", F.count_if("failed").over(w)).filter(F.col("n_failed") <= allowed).drop("n_failed")
    )


def x0_pair_filter(df: DataFrame, threshold: int = 2, mode: str = "both") -> DataFrame:
    """Complete pairs whose reads pass the hit-count test, failures tagged; one shuffle, by name."""
    cols = df.columns
    kept = consecutive_pairs(df).filter("complete").withColumn("failed", read_failure("x0", threshold).isNotNull())
    out = tag_failures(pair_fate(kept, mode), threshold)
    return out.select(*cols, *([] if "tags" in cols else ["x_fail"]))


def distinct_names(df: DataFrame, name: str = "qname") -> DataFrame:
    """Clean read names, each once in its sample."""
    keys = ["sample"] if "sample" in df.columns else []
    return df.select(*keys, clean_read_name(name).alias(name)).distinct()
