"""Queries on coverage tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import idiv
from ..operators import alignments as al, coverage as cov
from ..operators.intervals import exclude_overlaps
from . import views as v
from .registry import query


@query(v.with_views("select sample, qname, mate, strand, fs as s, fe as e from reads", "reads"))
def extend_reads_paired(spark, sf):
    return cov.extend_reads(v.reads(spark, sf)).select("sample", "qname", "mate", "strand", "s", "e")


@query(v.with_views("""
select sample, qname, mate, case when strand = '+' then s else greatest(e - 150, 0) end as s,
  least(case when strand = '+' then s + 150 else e end, 199900) as e from reads""", "reads"))
def extend_reads_single(spark, sf):
    r = v.reads(spark, sf)
    sizes = r.select("chrom").distinct().withColumn("size", F.lit(199900).cast("bigint"))
    return cov.extend_reads(r, 150, sizes).select("sample", "qname", "mate", "s", "e")


BINS = """
select sample, chrom, bin, count(*) as n from (
  select sample, chrom, unnest(range(s // 25, (e - 1) // 25 + 1)) as bin from fragments)
group by sample, chrom, bin"""
TOTALS = "select sample, count(*) as total from fragments group by sample"


@query(v.with_views(BINS, "fragments"))
def bin_coverage(spark, sf):
    return cov.bin_coverage(v.fragments(spark, sf))


@query(v.with_views("select b.sample, chrom, bin, n, round(n * 1e6 / total, 4) as cpm from bins b "
                    "join totals t on b.sample = t.sample", "fragments", bins=BINS, totals=TOTALS))
def normalise_cpm(spark, sf):
    f = v.fragments(spark, sf)
    return cov.normalise_cpm(cov.bin_coverage(f), cov.sample_totals(f))


OUTSIDE = """
select * from fragments f where not exists (
  select 1 from excluded x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)"""


@query(v.with_views("select b.sample, chrom, bin, n, round(n * 1e6 / total, 4) as cpm from bins b "
                    "join totals t on b.sample = t.sample", "fragments", "excluded", outside=OUTSIDE,
                    bins=BINS.replace("from fragments", "from outside"),
                    totals=TOTALS.replace("from fragments", "from outside")))
def coverage_excluding(spark, sf):
    return cov.coverage_excluding(v.fragments(spark, sf), v.excluded(spark, sf))


RUNS = """
select sample, chrom, p as s, lead(p) over w as e, cast(sum(d) over w as bigint) as depth from (
  select sample, chrom, p, sum(d) as d from (
    select sample, chrom, s as p, 1 as d from fragments union all select sample, chrom, e, -1 from fragments)
  group by sample, chrom, p having sum(d) <> 0)
window w as (partition by sample, chrom order by p)"""


@query(v.with_views("select * from runs where depth > 0", "fragments", runs=RUNS))
def depth(spark, sf):
    return cov.depth(v.fragments(spark, sf))


@query(v.with_views("""
select sample, chrom, bin, round(sum(least(e, (bin + 1) * 25) - greatest(s, bin * 25)) / 25, 4) as mean_depth from (
  select sample, chrom, fs as s, fe as e, unnest(range(fs // 25, (fe - 1) // 25 + 1)) as bin from reads where mate = 1)
group by all""", "reads"))
def window_counts_paired(spark, sf):
    return cov.window_counts(v.reads(spark, sf), 25)


@query(v.with_views("""
select sample, chrom, bin, round(sum(least(e, (bin + 1) * 100) - greatest(s, bin * 100)) / 100, 4) as mean_depth from (
  select *, unnest(range(s // 100, (e - 1) // 100 + 1)) as bin from (
    select sample, chrom, case when strand = '+' then s else greatest(e - 150, 0) end as s,
      case when strand = '+' then s + 150 else e end as e from reads where flag & 1024 = 0))
group by all""", "reads"))
def window_counts_single(spark, sf):
    return cov.window_counts(v.reads(spark, sf), 100, pairs=False, extend=150, include_duplicates=False)


@query(v.with_views("""
select sample, chrom, min(bin) * 25 as s, (max(bin) + 1) * 25 as e, any_value(n) as value from (
  select *, bin - row_number() over (partition by sample, chrom, n order by bin) as g from bins)
group by sample, chrom, n, g""", "fragments", bins=BINS))
def compact_runs(spark, sf):
    return cov.compact_bins(cov.bin_coverage(v.fragments(spark, sf)), 25, "n")


@query(v.with_views("""
select sample, chrom, factor, bin // factor as zbin, round(sum(n) / any_value(factor), 4) as mean, max(n) as max
from bins cross join (select unnest([4::bigint, 16, 64]) as factor)
group by sample, chrom, factor, bin // factor""", "fragments", bins=BINS))
def zoom(spark, sf):
    return cov.zoom(cov.bin_coverage(v.fragments(spark, sf)), [4, 16, 64], "n")


SINGLE = """
select sample, chrom, case when strand = '+' then s else greatest(e - 150, 0) end as s,
  case when strand = '+' then s + 150 else e end as e
from marked where chrom <> 'chrM' and mflag & 3844 = 0 and mate = 1"""


@query(v.with_views("select b.sample, chrom, bin, n, round(n * 1e6 / total, 4) as cpm from bins b "
                    "join totals t on b.sample = t.sample", "marked", "excluded", fragments=SINGLE, outside=OUTSIDE,
                    bins=BINS.replace("from fragments", "from outside"),
                    totals=TOTALS.replace("from fragments", "from outside")))
def clean_single_track(spark, sf):
    """Single reads extended to 150 bases, pruned and outside the excluded regions."""
    from ..functions import arith as A
    from .trunk import prune_chip_single, track

    pruned = prune_chip_single(v.alignments(spark, sf), "mm10").withColumn(
        "flag", F.col("flag").bitwiseAND(F.lit(~(A.PAIRED | A.PROPER | A.MATE_UNMAPPED))))
    return track(pruned, v.excluded(spark, sf), length=150)


GENOMES = """
select *, case sample when 'S1' then 'hg19' else 'mm10' end as genome from marked
where chrom <> 'chrM' and mflag & 3 = 3 and mflag & 3340 = 0 and mate = 1"""


@query(v.with_views("select b.sample, chrom, bin, n, round(n * 1e6 / total, 4) as cpm from bins b "
                    "join totals t on b.sample = t.sample", "marked", "excluded", of_genome=GENOMES,
                    outside="""
select sample, chrom, fs as s, fe as e from of_genome f where not exists (
  select 1 from excluded x where x.chrom = f.chrom and x.s < f.fe and f.fs < x.e
    and (x.bid % 2 = 0 and f.genome = 'hg19' or x.bid % 2 = 1 and f.genome = 'mm10'))""",
                    bins=BINS.replace("from fragments", "from outside"),
                    totals=TOTALS.replace("from fragments", "from outside")))
def clean_track_two_genomes(spark, sf):
    """Samples of two genomes, each against the excluded regions of its own."""
    from .trunk import prune_atac, track, with_genomes

    sheet = v.reads(spark, sf).select("sample").distinct().select(
        "sample", F.when(F.col("sample") == "S1", "hg19").otherwise("mm10").alias("genome"))
    own = v.excluded(spark, sf).withColumn("genome", F.when(F.col("bid") % 2 == 0, "hg19").otherwise("mm10"))
    return track(prune_atac(with_genomes(v.alignments(spark, sf), sheet)), own)
