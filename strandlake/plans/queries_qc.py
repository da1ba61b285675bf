"""Queries on quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignments as al, qc
from . import views as v
from .registry import query

IN = "exists (select 1 from peaks p where p.sample = r.sample and p.chrom = r.chrom and p.s < r.e and r.s < p.e)"


@query(v.with_views("""
select sample, count(*) as total, count(*) filter (where flag & 1 <> 0) as paired, count(*) filter (where flag & 2 <> 0) as proper,
  count(*) filter (where flag & 4 <> 0) as unmapped, count(*) filter (where flag & 8 <> 0) as mate_unmapped,
  count(*) filter (where flag & 256 <> 0) as secondary, count(*) filter (where flag & 2048 <> 0) as supplementary,
  count(*) filter (where flag & 512 <> 0) as qc_fail, count(*) filter (where flag & 1024 <> 0) as duplicate
from reads group by sample""", "reads"))
def read_counts(spark, sf):
    return qc.read_counts(v.reads(spark, sf))


@query(v.with_views("""
select sample, tlen as length, count(*) as n from reads where flag & 2 <> 0 and flag & 4 = 0 and mate = 1 group by all""", "reads"))
def fragment_length_histogram(spark, sf):
    return qc.fragment_lengths(v.reads(spark, sf))


@query(v.with_views("""
select p.id, p.sample, p.chrom, p.s, p.e, count(r.s) as reads from peaks p
left join reads r on p.sample = r.sample and p.chrom = r.chrom and p.s < r.e and r.s < p.e group by all""", "peaks", "reads"))
def peak_reads(spark, sf):
    return qc.peak_reads(v.reads(spark, sf), v.peaks(spark, sf))


@query(v.with_views(f"""
select sample, count(*) as reads, count(*) filter (where {IN}) as in_peaks, round(count(*) filter (where {IN}) / count(*), 4) as fraction
from reads r group by sample""", "peaks", "reads"))
def peak_fractions(spark, sf):
    return qc.peak_fractions(v.reads(spark, sf), v.peaks(spark, sf))


@query(v.with_views("""
select sample, reads, cast(sum(count(*)) over (partition by sample order by reads desc) as bigint) as peaks,
  cast(sum(reads * count(*)) over (partition by sample order by reads desc) as bigint) as cumulative
from (
  select p.id, p.sample, count(r.s) as reads from peaks p
  left join reads r on p.sample = r.sample and p.chrom = r.chrom and p.s < r.e and r.s < p.e group by p.id, p.sample)
group by sample, reads""", "peaks", "reads"))
def ranked_peaks(spark, sf):
    return qc.ranked_peaks(qc.peak_reads(v.reads(spark, sf), v.peaks(spark, sf)))


@query(v.with_views(f"""
select sample, count(*) filter (where {IN}) as reads_in, count(*) filter (where {IN} and mflag & 1024 <> 0) as duplicates_in,
  count(*) filter (where not {IN}) as reads_out, count(*) filter (where not {IN} and mflag & 1024 <> 0) as duplicates_out
from marked r group by sample""", "peaks", "marked"))
def duplicate_split(spark, sf):
    return qc.duplicate_split(al.mark_duplicates(v.alignments(spark, sf)), v.peaks(spark, sf))


PROFILE = """
select sample, g.off as "offset", cast(coalesce(sum(n), 0) as bigint) as depth
from (select sample, unnest(range(-1000, 1001)) as off from (select distinct sample from fragments)) g
left join (
  select smp, off, count(*) as n from (
    select f.sample as smp, unnest(range(
      case when strand = '+' then greatest(f.s - t.s, -1000) else greatest(t.s - f.e + 1, -1000) end,
      case when strand = '+' then least(f.e - t.s, 1001) else least(t.s - f.s + 1, 1001) end)) as off
    from fragments f join tss t on t.chrom = f.chrom and f.s < t.s + 1001 and f.e > t.s - 1000)
  group by smp, off) x on x.smp = g.sample and x.off = g.off
group by sample, g.off"""


@query(v.with_views("select * from profile", "fragments", "tss", profile=PROFILE))
def tss_profile(spark, sf):
    return qc.tss_profile(v.fragments(spark, sf), v.tss(spark, sf))


@query(v.with_views("""
select sample, "offset", depth, round(depth / avg(depth) filter (where abs("offset") > 900) over (partition by sample), 4) as enrichment
from profile""", "fragments", "tss", profile=PROFILE))
def tss_enrichment(spark, sf):
    return qc.tss_enrichment(v.fragments(spark, sf), v.tss(spark, sf))


OWN_POINTS = "select *, case when tid % 3 = 0 then 'hg19' else 'mm10' end as genome from tss"
OWN_FRAGMENTS = "select *, case sample when 'S1' then 'hg19' else 'mm10' end as genome from fragments"


@query(v.with_views("select * from profile", "fragments", "tss", own_points=OWN_POINTS, own_fragments=OWN_FRAGMENTS,
                    profile=PROFILE.replace("from fragments f join tss t on t.chrom", "from own_fragments f join own_points t on t.genome = f.genome and t.chrom")))
def tss_profile_two_genomes(spark, sf):
    """Each sample meets the points of its own genome only."""
    tss = v.tss(spark, sf).withColumn("genome", F.when(F.col("tid") % 3 == 0, "hg19").otherwise("mm10"))
    own = v.fragments(spark, sf).withColumn("genome", F.when(F.col("sample") == "S1", "hg19").otherwise("mm10"))
    return qc.tss_profile(own, tss)


@query(v.with_views("""
select sample, case chrom when 'chrM' then 'mitochondrial' else 'autosomal' end as class, count(*) as reads
from reads group by all""", "reads"))
def chromosome_classes(spark, sf):
    return qc.chromosome_classes(v.reads(spark, sf), "mouse")


@query(v.with_views("""
select sample, case when place = 'chrM' then 'mitochondrial' when sample = 'S1' or place <> 'chr21' then 'autosomal' else 'other' end as class,
  count(*) as reads
from (select sample, case chrom when 'chr5' then 'chr21' else chrom end as place from reads) group by all""", "reads"))
def chromosome_classes_by_genome(spark, sf):
    """A chromosome that one sample's genome has and that of the others has not."""
    place = F.when(F.col("chrom") == "chr5", "chr21").otherwise(F.col("chrom"))
    own = F.when(F.col("sample") == "S1", "hg38").otherwise("mm10")
    return qc.chromosome_classes(v.reads(spark, sf).select("sample", place.alias("chrom"), own.alias("genome")))


@query(v.with_views("""
select qname, mate, chrom, s, e from reads r where not exists (
  select 1 from excluded x where x.chrom = r.chrom and x.s < r.e and r.s < x.e)""", "reads", "excluded"))
def exclude_regions(spark, sf):
    return qc.exclude_regions(v.reads(spark, sf), v.excluded(spark, sf)).select("qname", "mate", "chrom", "s", "e")


ROLLUP = """
select paramset, metric, max(value) filter (where sample = 'S1') as S1, max(value) filter (where sample = 'S2') as S2,
  max(value) filter (where sample = 'S3') as S3
from (
  select sample, ps as paramset, 'total' as metric, cast(count(*) as double) as value from reads cross join (select unnest(['a', 'b']) as ps) group by all
  union all
  select sample, ps, 'duplicate', cast(count(*) filter (where flag & 1024 <> 0) as double) from reads cross join (select unnest(['a', 'b']) as ps) group by all)
group by paramset, metric"""


@query(v.with_views(ROLLUP, "reads"))
def metrics_rollup(spark, sf):
    counts = qc.read_counts(v.reads(spark, sf)).select("sample", "total", "duplicate")
    long = qc.long_metrics(counts).withColumn("paramset", F.explode(F.array(F.lit("a"), F.lit("b"))))
    return qc.metrics_rollup(long, ["S1", "S2", "S3"])


@query(v.with_views("""
select ps as paramset, sample, count(*) filter (where hit) as reads_in, count(*) filter (where hit and mflag & 1024 <> 0) as duplicates_in,
  count(*) filter (where not hit) as reads_out, count(*) filter (where not hit and mflag & 1024 <> 0) as duplicates_out
from (
  select r.sample, r.mflag, p.ps, exists (
    select 1 from peaks k where k.sample = r.sample and k.chrom = r.chrom and k.s < r.e and r.s < k.e
      and (p.ps = 'all' or k.e - k.s > 300)) as hit
  from marked r cross join (select unnest(['all', 'wide']) as ps) p)
group by ps, sample""", "peaks", "marked"))
def duplicate_split_paramsets(spark, sf):
    """Two parameter sets whose peaks differ, each measured for itself."""
    p = v.peaks(spark, sf)
    both = p.withColumn("paramset", F.lit("all")).unionByName(p.filter("e - s > 300").withColumn("paramset", F.lit("wide")))
    return qc.duplicate_split(al.mark_duplicates(v.alignments(spark, sf)), both, ["all", "wide"])
