"""Queries on tag directories and control-based peaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tags as tg
from ..operators.intervals import exclude_overlaps, keep_by_id, rewrite_header
from ..session import stage
from . import views as v
from .queries_intervals import merged_sql
from .registry import query

GENOME = 1e6
TAGS = """
select sample, chrom, case when strand = '-' then e - 1 else s end as p, strand, count(*) as n
from reads group by all"""
POS = "select sample, chrom, p, cast(sum(n) as bigint) as n from tags group by sample, chrom, p"
WINDOWS = """
select *, cast(sum(n) over (partition by sample, chrom order by p range between {h} preceding and {h} following) as bigint) as tags
from pos"""
FACTOR = """
select sample, chrom, greatest(p - 100, 0) as s, p + 100 as e, p, tags from (
  select *, max(tags) over (partition by sample, chrom order by p range between 400 preceding and 1 preceding) as l,
    max(tags) over (partition by sample, chrom order by p range between 1 following and 400 following) as r
  from wt) where tags >= {t} and coalesce(l, 0) < tags and coalesce(r, 0) <= tags"""
STEPS = {"tags": TAGS, "pos": POS, "wt": WINDOWS.format(h=100)}


def _tags(spark, sf):
    return tg.tag_directory(v.reads(spark, sf))


@query(v.with_views("select * from tags", "reads", tags=TAGS))
def tag_directory(spark, sf):
    return _tags(spark, sf)


@query(v.with_views("""
select sample, cast(sum(n) as bigint) as tags, count(*) as positions, round(sum(n) / count(*), 4) as tags_per_position
from tags group by sample""", "reads", tags=TAGS))
def tag_totals(spark, sf):
    return tg.tag_totals(_tags(spark, sf))


PAIRS = """
select sample, d.distance, coalesce(cast(sum(same) as bigint), 0) as same, coalesce(cast(sum(opposite) as bigint), 0) as opposite
from (select distinct sample, unnest(range(0, 301)) as distance from tags) d left join (
  select a.sample as smp, b.p - a.p as distance, case when a.strand = b.strand and b.p > a.p then a.n * b.n else 0 end as same,
    case when a.strand = '+' and b.strand = '-' then a.n * b.n else 0 end as opposite
  from tags a join tags b on a.sample = b.sample and a.chrom = b.chrom and b.p between a.p and a.p + 300) x
on x.smp = d.sample and x.distance = d.distance
group by sample, d.distance"""


@query(v.with_views(PAIRS, "reads", tags=TAGS))
def tag_autocorrelation(spark, sf):
    return tg.tag_autocorrelation(_tags(spark, sf), 300)


@query(v.with_views("""
select sample, arg_max(distance, opposite * 1000 - distance) as fragment_length from corr where distance >= 60 group by sample""",
                    "reads", tags=TAGS, corr=PAIRS))
def fragment_length(spark, sf):
    return tg.fragment_length(tg.tag_autocorrelation(_tags(spark, sf), 300), 60)


@query(v.with_views(FACTOR.format(t=8), "reads", **STEPS))
def find_peaks_factor(spark, sf):
    return tg.find_peaks_factor(_tags(spark, sf), 200, 400, 8)


SEEDS = "select sample, chrom, greatest(p - 250, 0) as s, p + 250 as e from wt where tags >= 20"
REGIONS = """
select g.sample, g.chrom, g.s, g.e, cast(coalesce(sum(n), 0) as bigint) as tags from ({merged}) g
left join pos on pos.sample = g.sample and pos.chrom = g.chrom and g.s <= p and p < g.e
group by g.sample, g.chrom, g.s, g.e"""


@query(v.with_views("select * from regions", "reads", tags=TAGS, pos=POS, wt=WINDOWS.format(h=250), seeds=SEEDS,
                    regions=REGIONS.format(merged=merged_sql("seeds", "sample, chrom", 1000))))
def find_peaks_region(spark, sf):
    return tg.find_peaks_region(_tags(spark, sf), 500, 1000, 20)


CONTROLLED = """
select c.sample, c.chrom, c.s, c.e, c.p, c.tags_in as tags, c.control_tags,
  (tags_in / tt.total) / ((control_tags + 1) / ct.total) as fold
from (
  select f.sample, f.chrom, f.s, f.e, f.p,
    (select coalesce(sum(n), 0) from pos x where x.sample = f.sample and x.chrom = f.chrom and f.s <= x.p and x.p < f.e)::bigint as tags_in,
    (select coalesce(sum(n), 0) from pos x where x.sample = 'S3' and x.chrom = f.chrom and f.s <= x.p and x.p < f.e)::bigint as control_tags
  from found f where sample <> 'S3') c
join (select sample, sum(n) as total from tags group by sample) tt on tt.sample = c.sample
cross join (select sum(n) as total from tags where sample = 'S3') ct
where tags_in / tt.total >= {fold} * ((control_tags + 1) / ct.total)"""


def _controlled(spark, sf, fold):
    tags = stage(_tags(spark, sf), "tags")
    control = tags.filter("sample = 'S3'").withColumn("sample", F.explode(F.array(F.lit("S1"), F.lit("S2"))))
    treated = tags.filter("sample <> 'S3'")
    return tg.control_filter(tg.find_peaks_factor(treated, 200, 400, 8), treated, control, fold)


@query(v.with_views("select sample, chrom, s, e, p, tags, control_tags, round(fold, 4) as fold from kept", "reads",
                    **STEPS, found=FACTOR.format(t=8), kept=CONTROLLED.format(fold=1.2)))
def control_filter(spark, sf):
    return _controlled(spark, sf, 1.2)


CUTOFFS = """
select sample, min(tags) as threshold, arg_min(observed, tags) as observed, round(arg_min(ratio, tags), 4) as ratio from (
  select *, 5000 * power(10, -(-(tags * ln(rate) - rate - lgamma(tags + 1.0) + ln(list_sum(list_transform(range(0, 400),
    lambda j: exp(j * ln(rate) - (lgamma(tags + j + 1.0) - lgamma(tags + 1.0))))))) / ln(10))) / observed as ratio
  from (
    select f.sample, tags, cast(sum(count(*)) over (partition by f.sample order by tags desc) as bigint) as observed, any_value(rate) as rate
    from found f join (select sample, sum(n) * 200 / 1e6 as rate from tags group by sample) r on r.sample = f.sample
    group by f.sample, tags) where tags > rate)
where ratio <= 0.001 group by sample"""


@query(v.with_views(CUTOFFS, "reads", **STEPS, found=FACTOR.format(t=1)))
def fdr_cutoff(spark, sf):
    tags = stage(_tags(spark, sf), "tags")
    return tg.fdr_cutoff(tg.find_peaks_factor(tags, 200, 400, 1), tags, GENOME, 200, 0.001)


@query(v.with_views("select f.* from found f join cutoffs c on c.sample = f.sample and f.tags >= c.threshold", "reads", **STEPS,
                    found=FACTOR.format(t=1), cutoffs=CUTOFFS))
def peaks_at_a_rate(spark, sf):
    """Each sample's threshold is the least that keeps to a rate of false peaks."""
    tags = stage(_tags(spark, sf), "tags")
    cutoffs = tg.fdr_cutoff(tg.find_peaks_factor(tags, 200, 400, 1), tags, GENOME, 200, 0.001)
    return tg.find_peaks_factor(tags, 200, 400, stage(cutoffs, "cutoffs"))


@query(v.with_views("""
select sample, chrom || '-' || (s + 1) || '-' || e as id, chrom, s + 1 as start, e as "end", '+' as strand, tags as score
from found""", "reads", **STEPS, found=FACTOR.format(t=8)))
def peak_report_rows(spark, sf):
    return tg.peak_rows(tg.find_peaks_factor(_tags(spark, sf), 200, 400, 8))


@query(v.with_views("""
select sample, line_no, case line_no when 1 then '# sample = ' || sample when 2 then '# total tags = ' || total
  when 3 then '# tags in peaks = ' || inside else '# total peaks = ' || peaks end as text
from (
  select t.sample, total, coalesce(inside, 0) as inside, coalesce(peaks, 0) as peaks, unnest([1::bigint, 2, 3, 4]) as line_no
  from (select sample, cast(sum(n) as bigint) as total from tags group by sample) t
  left join (select sample, count(*) as peaks, cast(sum(tags) as bigint) as inside from found group by sample) f
  on f.sample = t.sample)""", "reads", **STEPS, found=FACTOR.format(t=8)))
def peak_report_header(spark, sf):
    tags = stage(_tags(spark, sf), "tags")
    return tg.report_header(tg.find_peaks_factor(tags, 200, 400, 8), tags)


TWO_SETS = """
select 'loose' as paramset, sample, chrom, s, e, tags from ({loose}) union all
select 'tight', sample, chrom, s, e, tags from ({tight})"""


@query(v.with_views("select * from both_sets", "reads", **STEPS, found=FACTOR.format(t=8), strong=FACTOR.format(t=12),
                    both_sets=TWO_SETS.format(loose=CONTROLLED.format(fold=1.0),
                                              tight=CONTROLLED.format(fold=1.5).replace("from found", "from strong"))))
def tag_peaks_paramsets(spark, sf):
    """Two settings of the same finder, each filtered against the control."""
    from .trunk import tag_peaks

    tags = stage(_tags(spark, sf), "tags")
    return tag_peaks(tags, _sheet(spark, sf), {
        "loose": {"fold": 1.0, "width": 200, "min_dist": 400, "threshold": 8},
        "tight": {"fold": 1.5, "width": 200, "min_dist": 400, "threshold": 12}})


def _sheet(spark, sf):
    """S3 is the control of the other samples."""
    return v.reads(spark, sf).select("sample").distinct().select(
        "sample", F.lit("mm10").alias("genome"), F.when(F.col("sample") != "S3", F.lit("S3")).alias("input"))


LEFT = """
select * from both_sets k where not exists (
  select 1 from excluded x where x.chrom = k.chrom and x.s < k.e and k.s < x.e)"""


@query(v.with_views("""
select paramset, sample, line_no, case line_no when 1 then '# sample = ' || sample when 2 then '# total tags = ' || total
  when 3 then '# tags in peaks = ' || inside
  else '# peaks remaining after blacklist filtering ' || (
    select count(*) from clean c where c.paramset = h.paramset and c.sample = h.sample) || ' ' end as text
from (
  select paramset, f.sample, total, inside, unnest([1::bigint, 2, 3, 4]) as line_no
  from (select paramset, sample, cast(sum(tags) as bigint) as inside from both_sets group by paramset, sample) f
  join (select sample, cast(sum(n) as bigint) as total from tags group by sample) t on t.sample = f.sample) h
union all
select paramset, sample, 0, chrom || '-' || (s + 1) || '-' || e || ' ' || chrom || ' ' || (s + 1) || ' ' || e || ' + ' || tags || '.0' from clean""",
                    "reads", "excluded", **STEPS, found=FACTOR.format(t=8), strong=FACTOR.format(t=12),
                    both_sets=TWO_SETS.format(loose=CONTROLLED.format(fold=1.0),
                                              tight=CONTROLLED.format(fold=1.5).replace("from found", "from strong")), clean=LEFT))
def chip_report(spark, sf):
    """Reports of two parameter sets, written with their headers and read back."""
    from .. import sinks
    from ..session import scratch_path
    from ..sources.genomic import read_hpeaks
    from .trunk import outside, tag_peaks

    tags = stage(_tags(spark, sf), "tags")
    peaks = stage(tag_peaks(tags, _sheet(spark, sf), {
        "loose": {"fold": 1.0, "width": 200, "min_dist": 400, "threshold": 8},
        "tight": {"fold": 1.5, "width": 200, "min_dist": 400, "threshold": 12}}), "peaks")
    rows = stage(outside(tg.peak_rows(peaks, ["paramset"]), v.excluded(spark, sf), ["paramset", "sample"]), "rows")
    header = tg.filtered_header(tg.report_header(peaks, tags, ["paramset"]), rows, ["paramset"])
    label = F.concat_ws(".", "paramset", "sample").alias("sample")
    path = scratch_path(spark, "report")
    sinks.write_peak_report(header.select(label, "line_no", "text"),
                            rows.select(label, "id", "chrom", "start", "end", "strand", "score"), path)
    head, body = read_hpeaks(spark, path)
    at = F.regexp_extract("path", r"/sample=([^/]+)/", 1)
    text = F.concat_ws(" ", "id", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand", F.col("score").cast("string"))
    lines = head.select(at.alias("label"), "line_no", "text").unionByName(
        body.select(F.col("sample").alias("label"), F.lit(0).cast("bigint").alias("line_no"), text.alias("text")))
    return lines.select(F.substring_index("label", ".", 1).alias("paramset"), F.substring_index("label", ".", -1).alias("sample"),
                        "line_no", "text")


@query(v.with_views("""
select sample, chrom || '-' || (s + 1) || '-' || e as id, chrom, s + 1 as start, e as "end", '+' as strand, tags as score
from kept k where not exists (
  select 1 from excluded x where x.chrom = k.chrom and x.s < k.e and k.s < x.e)""", "reads", "excluded",
                    **STEPS, found=FACTOR.format(t=8), kept=CONTROLLED.format(fold=1.2)))
def chip_peaks_against_control(spark, sf):
    """Tag peaks against a control, outside the excluded regions: peak table, BED, anti-join, selection by id."""
    from .trunk import chip_peaks

    # S3 is the control of the other samples
    sheet = v.reads(spark, sf).select("sample").distinct().select(
        "sample", F.lit("hg19").alias("genome"), F.when(F.col("sample") != "S3", F.lit("S3")).alias("input"))
    return chip_peaks(v.reads(spark, sf), sheet, v.excluded(spark, sf), "factor", 1.2, width=200, min_dist=400, threshold=8)
