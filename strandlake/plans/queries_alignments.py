"""Queries on alignment records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arith as A
from ..functions.names import clean_read_name
from ..operators import alignments as al
from ..session import stage_by
from . import views as v
from .registry import query
from .trunk import prune_atac, prune_chip_paired, prune_chip_single, track

KEPT = "chrom in ('chr1','chr2','chr3','chr4','chr5')"  # of the test data; chrM is not kept
READ_COLS = "sample, qname, mate, chrom, s, e, flag, x0"


@query(v.with_views(
    f"select {READ_COLS} from reads where flag & 1 <> 0 and flag & 2 <> 0 and flag & 4 = 0 and flag & 8 = 0 "
    "and flag & 256 = 0 and flag & 1024 = 0 and flag & 2048 = 0", "reads"))
def filter_flags_atac(spark, sf):
    return al.filter_flags(v.reads(spark, sf), *al.PRUNE_ATAC).select(*READ_COLS.split(", "))


@query(v.with_views(
    f"select {READ_COLS} from reads where flag & 1 <> 0 and flag & 2 <> 0 and flag & 4 = 0 and flag & 8 = 0 "
    "and flag & 256 = 0 and flag & 512 = 0 and flag & 1024 = 0 and flag & 2048 = 0", "reads"))
def filter_flags_chip_paired(spark, sf):
    return al.filter_flags(v.reads(spark, sf), *al.PRUNE_CHIP_PAIRED).select(*READ_COLS.split(", "))


@query(v.with_views(
    f"select {READ_COLS} from reads where flag & 4 = 0 and flag & 256 = 0 and flag & 512 = 0 and flag & 1024 = 0 "
    "and flag & 2048 = 0", "reads"))
def filter_flags_chip_single(spark, sf):
    return al.filter_flags(v.reads(spark, sf), *al.PRUNE_CHIP_SINGLE).select(*READ_COLS.split(", "))


@query(v.with_views(f"select {READ_COLS} from reads where {KEPT}", "reads"))
def keep_chromosomes(spark, sf):
    return al.keep_chromosomes(v.reads(spark, sf), "mm10").select(*READ_COLS.split(", "))


@query(v.with_views(f"select {READ_COLS}, case sample when 'S1' then 'hg19' when 'S2' then 'mm10' else 'rn5' end "
                    f"as genome from reads where {KEPT}", "reads"))
def keep_chromosomes_by_genome(spark, sf):
    genome = F.when(F.col("sample") == "S1", "hg19").when(F.col("sample") == "S2", "mm10").otherwise("rn5")
    return al.keep_chromosomes(v.reads(spark, sf).withColumn("genome", genome)).select(*READ_COLS.split(", "), "genome")


@query(v.with_views("""
select sample, chrom, s, qname, mate, case when chrom = 'chrM' then 1002 else cast(substr(chrom, 4) as bigint) end as ordinal
from reads""", "reads"))
def coordinate_sort(spark, sf):
    from ..sources.genome import chromosome_ordinal

    return al.coordinate_sort(v.reads(spark, sf)).select(
        "sample", "chrom", "s", "qname", "mate", chromosome_ordinal("chrom").alias("ordinal"))


@query(v.with_views("select qname, mate, sample, chrom, s from reads", "reads"))
def name_sort(spark, sf):
    return al.name_sort(v.reads(spark, sf)).select("qname", "mate", "sample", "chrom", "s")


@query(v.with_views(f"select {READ_COLS} from reads where chrom = 'chr2' and s < 60000 and e > 20000", "reads"))
def region(spark, sf):
    return al.region(v.reads(spark, sf), "chr2", 20000, 60000).select(*READ_COLS.split(", "))


@query(v.with_views("select sample, qname, mate, chrom, s, e, mflag as flag from marked", "marked"))
def mark_duplicates(spark, sf):
    return al.mark_duplicates(v.alignments(spark, sf)).select("sample", "qname", "mate", "chrom", "s", "e", "flag")


@query(v.with_views("""
select sample, count(*) filter (where pr) as pair_reads, count(*) filter (where pr and d) as pair_duplicates,
  count(*) filter (where not pr) as single_reads, count(*) filter (where not pr and d) as single_duplicates,
  round(count(*) filter (where d) / count(*), 4) as duplicate_rate
from (select sample, mflag & 1 <> 0 and mflag & 8 = 0 as pr, mflag & 1024 <> 0 as d from marked where flag & 2308 = 0)
group by sample""", "marked"))
def duplicate_metrics(spark, sf):
    return al.duplicate_metrics(al.mark_duplicates(v.alignments(spark, sf)))


@query(v.with_views("""
select sample, qname, mate, x0, case when x0 is null then 'NO_X0' when x0 > 2 then 'HI_X0' end as failure
from reads""", "reads"))
def read_failure(spark, sf):
    return v.reads(spark, sf).select("sample", "qname", "mate", "x0", al.read_failure("x0", 2).alias("failure"))


@query(v.with_views("""
select sample, qname, mate, case when x0 is null then 'X?=NO_X0' when x0 > 1 then 'X0=' || x0 || ';X?=HI_X0'
  else 'X0=' || x0 end as tags from reads""", "reads"))
def tag_failures(spark, sf):
    tags = F.when(F.col("x0").isNull(), F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("X0"), F.col("x0").cast("string")))
    tagged = al.tag_failures(v.reads(spark, sf).withColumn("tags", tags), 1)
    text = F.array_join(
        F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.concat(t["key"], F.lit("="), t["value"])), ";")
    return tagged.select("sample", "qname", "mate", text.alias("tags"))


NAMED = """
select sample, 'q' || (fid // 5) as qname, mate, chrom, s, e, flag, x0, fid from reads"""


def _crowded(spark, sf):
    """Reads that share a name by fives, so that odd and larger groups occur."""
    r = v.reads(spark, sf)
    return r.withColumn("fid", F.col("qname").cast("bigint")).withColumn(
        "qname", F.concat(F.lit("q"), A.idiv("fid", 5).cast("string")))


RANKED = """
select *, row_number() over (partition by sample, qname order by mate, flag, chrom, s, e, x0 nulls first) as rn,
  count(*) over (partition by sample, qname) as n from named"""


@query(v.with_views("select sample, qname, mate, chrom, s, (rn - 1) // 2 as pair from ranked where rn <= n - n % 2",
                    "reads", named=NAMED, ranked=RANKED))
def consecutive_pairs(spark, sf):
    return al.consecutive_pairs(_crowded(spark, sf)).filter("complete").select("sample", "qname", "mate", "chrom", "s", "pair")


@query(v.with_views("select sample, qname, mate, chrom, s from ranked where n % 2 = 1 and rn = n",
                    "reads", named=NAMED, ranked=RANKED))
def orphans(spark, sf):
    return al.orphans(_crowded(spark, sf)).select("sample", "qname", "mate", "chrom", "s")


PAIRED = """
select *, count(*) filter (where x0 is null or x0 > {t}) over (partition by sample, qname, (rn - 1) // 2) as bad
from ranked where rn <= n - n % 2"""


@query(v.with_views("select sample, qname, mate, chrom, s from paired where bad = 0",
                    "reads", named=NAMED, ranked=RANKED, paired=PAIRED.format(t=1)))
def pair_fate_one(spark, sf):
    pairs = al.consecutive_pairs(_crowded(spark, sf)).filter("complete")
    failed = pairs.withColumn("failed", al.read_failure("x0", 1).isNotNull())
    return al.pair_fate(failed, "one").select("sample", "qname", "mate", "chrom", "s")


@query(v.with_views("""
select sample, qname, mate, chrom, s, x0, case when x0 is null then 'NO_X0' when x0 > 2 then 'HI_X0' end as x_fail
from paired where bad < 2""", "reads", named="select * from reads", ranked=RANKED, paired=PAIRED.format(t=2)))
def x0_pair_filter(spark, sf):
    return al.x0_pair_filter(v.reads(spark, sf), 2, "both").select("sample", "qname", "mate", "chrom", "s", "x0", "x_fail")


@query(v.with_views("select sample, fid || '/' || mate as raw, cast(fid as varchar) as qname from reads", "reads"))
def clean_read_names(spark, sf):
    raw = F.concat("qname", F.lit("/"), F.col("mate").cast("string"))
    return v.reads(spark, sf).select("sample", raw.alias("raw"), clean_read_name(raw).alias("qname"))


@query(v.with_views("select distinct sample, qname from reads", "reads"))
def distinct_read_names(spark, sf):
    raw = F.concat("qname", F.lit("/"), F.col("mate").cast("string"))
    return al.distinct_names(v.reads(spark, sf).withColumn("qname", raw))


@query(v.with_views(f"select sample, qname, mate, chrom, s, mflag as flag from marked where {KEPT} and mflag & 3 = 3 "
                    "and mflag & 3340 = 0", "marked"))
def prune_atac_alignments(spark, sf):
    return prune_atac(v.alignments(spark, sf), "mm10").select("sample", "qname", "mate", "chrom", "s", "flag")


@query(v.with_views(f"select sample, qname, mate, chrom, s, mflag as flag from marked where {KEPT} and mflag & 3844 = 0",
                    "marked"))
def prune_chip_single_alignments(spark, sf):
    return prune_chip_single(v.alignments(spark, sf), "mm10").select("sample", "qname", "mate", "chrom", "s", "flag")


CLEAN = f"""
select * from (
  select *, count(*) over (partition by sample, qname) as n,
    count(*) filter (where x0 is null or x0 > 2) over (partition by sample, qname) as bad
  from marked where {KEPT} and mflag & 3 = 3 and mflag & 3852 = 0) where n = 2 and bad < 2"""


@query(v.with_views("select sample, qname, mate, chrom, s, mflag as flag from clean", "marked", clean=CLEAN))
def prune_chip_paired_alignments(spark, sf):
    return prune_chip_paired(v.alignments(spark, sf), "mm10").select("sample", "qname", "mate", "chrom", "s", "flag")


@query(v.with_views("select sample, qname, mate, chrom, s, mflag as flag from clean", "marked", clean=CLEAN))
def prune_chip_paired_bucketed(spark, sf):
    """The same from records written in buckets by name: they are not shuffled again."""
    records = stage_by(v.alignments(spark, sf), "records", al.MATE_KEY)
    return prune_chip_paired(records, "mm10").select("sample", "qname", "mate", "chrom", "s", "flag")


@query(v.with_views("""
select sample, chrom, bin, count(*) as n, round(count(*) * 1e6 / any_value(total), 4) as cpm from (
  select u.sample, chrom, unnest(range(fs // 25, (fe - 1) // 25 + 1)) as bin, total
  from used u join (select sample, count(*) as total from used group by sample) t on u.sample = t.sample)
group by sample, chrom, bin""",
    "marked", "excluded", clean=CLEAN, used="""
select * from clean c where mate = 1 and not exists (
  select 1 from excluded x where x.chrom = c.chrom and x.s < c.fe and c.fs < x.e)"""))
def clean_pair_track(spark, sf):
    return track(prune_chip_paired(v.alignments(spark, sf), "mm10"), v.excluded(spark, sf))
