"""Queries on genomic intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from . import views as v
from .registry import query

TOUCH = "exists (select 1 from excluded x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)"


@query(v.with_views("""
select f.fid, f.chrom, f.s, f.e, x.bid as b_bid, x.s as b_s, x.e as b_e from fragments f
join excluded x on x.chrom = f.chrom and x.s < f.e and f.s < x.e""", "fragments", "excluded"))
def overlap_join(spark, sf):
    a = v.fragments(spark, sf).select("fid", "chrom", "s", "e")
    return iv.overlap_join(a, v.excluded(spark, sf).select("bid", "chrom", "s", "e"))


@query(v.with_views(f"select fid, sample, chrom, s, e from fragments f where not {TOUCH}", "fragments", "excluded"))
def exclude_overlaps(spark, sf):
    return iv.exclude_overlaps(v.fragments(spark, sf), v.excluded(spark, sf))


@query(v.with_views(f"select fid, sample, chrom, s, e from fragments f where {TOUCH}", "fragments", "excluded"))
def keep_overlaps(spark, sf):
    return iv.keep_overlaps(v.fragments(spark, sf), v.excluded(spark, sf))


@query(v.with_views("""
select id, chrom, s, e from peaks f where not exists (
  select 1 from long_regions x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)""", "peaks", "excluded",
    long_regions="select chrom, s * 9 as s, s * 9 + 20000 + bid * 11 as e from excluded"))
def exclude_long_overlaps(spark, sf):
    """Regions longer than a look-up bin."""
    x = v.excluded(spark, sf).select(
        "chrom", (F.col("s") * 9).alias("s"), (F.col("s") * 9 + 20000 + F.col("bid") * 11).alias("e"))
    return iv.exclude_overlaps(v.peaks(spark, sf), x).select("id", "chrom", "s", "e")


@query(v.with_views("""
select chrom, s, e, 'x' || bid as what from long_regions f where exists (
  select 1 from peaks x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)""", "peaks", "excluded",
    long_regions="select bid, chrom, s * 9 as s, s * 9 + 20000 + bid * 11 as e from excluded"))
def keep_long_rows(spark, sf):
    """Rows longer than a look-up bin."""
    x = v.excluded(spark, sf).select(
        "chrom", (F.col("s") * 9).alias("s"), (F.col("s") * 9 + 20000 + F.col("bid") * 11).alias("e"),
        F.concat(F.lit("x"), F.col("bid").cast("string")).alias("what"))
    return iv.keep_overlaps(x, v.peaks(spark, sf))


@query(v.with_views("""
select 'peak' as kind, id, s, e from peaks f where not exists (
  select 1 from excluded x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)
union all
select 'summit', id, m, m + 1 from (select *, (s + e) // 2 as m from peaks) f where not exists (
  select 1 from excluded x where x.chrom = f.chrom and x.s < f.m + 1 and f.m < x.e)""", "peaks", "excluded"))
def exclude_peaks_and_summits(spark, sf):
    p = v.peaks(spark, sf)
    middle = F.expr("(s + e) div 2")
    tops = p.select("id", "chrom", middle.alias("s"), (middle + 1).alias("e"))
    kept, kept_tops = iv.exclude_peaks_and_summits(p, tops, v.excluded(spark, sf))
    return kept.select(F.lit("peak").alias("kind"), "id", "s", "e").unionByName(
        kept_tops.select(F.lit("summit").alias("kind"), "id", "s", "e"))


def merged_sql(table: str, keys: str, gap: int = 0) -> str:
    return f"""
select {keys}, min(s) as s, max(e) as e from (
  select *, sum(fresh) over (partition by {keys} order by s, e rows unbounded preceding) as g from (
    select *, case when s > max(e) over (partition by {keys} order by s, e
      rows between unbounded preceding and 1 preceding) + {gap} then 1
      when row_number() over (partition by {keys} order by s, e) = 1 then 1 else 0 end as fresh from {table}))
group by {keys}, g"""


@query(v.with_views(merged_sql("excluded", "chrom"), "excluded"))
def merge_excluded(spark, sf):
    return iv.merge_intervals(v.excluded(spark, sf))


@query(v.with_views(merged_sql("fragments", "sample, chrom"), "fragments"))
def merge_fragments(spark, sf):
    return iv.merge_intervals(v.fragments(spark, sf), ["sample", "chrom"])


@query(v.with_views(merged_sql("peaks", "chrom", 300), "peaks"))
def merge_with_gap(spark, sf):
    return iv.merge_intervals(v.peaks(spark, sf), gap=300)


@query(v.with_views("""
select f.id, f.sample, f.chrom, f.s, f.e, count(x.s) as n from peaks f
left join fragments x on x.sample = f.sample and x.chrom = f.chrom and x.s < f.e and f.s < x.e
group by all""", "peaks", "fragments"))
def overlap_counts(spark, sf):
    return iv.overlap_counts(v.peaks(spark, sf), v.fragments(spark, sf), ["sample", "chrom"])


@query(v.with_views("""
select chrom, sum(bad)::bigint as violations, sum(bad) = 0 as disjoint from (
  select chrom, case when exists (select 1 from excluded b where a.chrom = b.chrom and a.bid <> b.bid and b.s < a.e
    and a.s < b.e) then 1 else 0 end as bad from excluded a)
group by chrom""", "excluded"))
def is_disjoint(spark, sf):
    return iv.is_disjoint(v.excluded(spark, sf))


@query(v.with_views("""
select tid, chrom, s from tss t where exists (select 1 from excluded x where x.chrom = t.chrom and x.s <= t.s and t.s < x.e)""",
                    "tss", "excluded"))
def points_in(spark, sf):
    return iv.points_in(v.tss(spark, sf), v.excluded(spark, sf)).select("tid", "chrom", "s")


@query(v.with_views("""
select p.id, p.chrom, p.s from peaks p cross join (select unnest([1, 2])) where exists (
  select 1 from peaks b where b.id = p.id and b.e - b.s > 200)""", "peaks"))
def keep_by_id(spark, sf):
    """A peak that is listed twice stays listed twice; ids listed twice in the BED change nothing."""
    p = v.peaks(spark, sf).select("id", "chrom", "s", "e")
    bed = p.filter("e - s > 200").select(F.col("id").alias("name"))
    return iv.keep_by_id(p.unionAll(p), bed.unionAll(bed)).select("id", "chrom", "s")


@query(v.with_views("""
select n as line_no, case n when 4 then '# peaks remaining after blacklist filtering ' || (
  select 2 * count(*) from peaks where e - s > 200) || ' ' else '# fact ' || n || ' of ' || (select count(*) from peaks) end as text
from (select unnest(range(1, 9)) as n)""", "peaks"))
def rewrite_header(spark, sf):
    p = v.peaks(spark, sf)
    bed = p.filter("e - s > 200")
    line = F.explode(F.sequence(F.lit(1), F.lit(8)))
    header = p.agg(F.count(F.lit(1)).alias("n")).select(line.alias("line_no"), "n").select(
        "line_no", F.concat(F.lit("# fact "), F.col("line_no").cast("string"), F.lit(" of "), F.col("n").cast("string")).alias("text"))
    return iv.rewrite_header(header, bed.unionAll(bed))


@query(v.with_views("select chrom, s, e, id as name, e - s as score, '+' as strand from peaks", "peaks"))
def peaks_to_bed(spark, sf):
    one_based = v.peaks(spark, sf).select(
        "id", "chrom", (F.col("s") + 1).alias("start"), F.col("e").alias("end"),
        (F.col("e") - F.col("s")).alias("score"), F.lit("+").alias("strand"))
    return iv.peaks_to_bed(one_based)


@query(v.with_views("""
select distinct r.sample, r.qname from reads r join excluded x on x.chrom = r.chrom and x.s < r.e and r.s < x.e""", "reads", "excluded"))
def region_read_names(spark, sf):
    r = v.reads(spark, sf).withColumn("qname", F.concat("qname", F.lit("/"), F.col("mate").cast("string")))
    return iv.region_read_names(v.excluded(spark, sf), r)
