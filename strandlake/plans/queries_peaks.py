"""Queries on peaks called from pileups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage as cov, peaks as pk
from ..operators.intervals import exclude_overlaps
from ..session import stage
from . import views as v
from .queries_coverage import RUNS
from .registry import query

GENOME = 1e6  # bases of the test data's five chromosomes

PILE = """
select sample, chrom, bin, max(depth) as k,
  cast(sum((least(e, (bin + 1) * 25) - greatest(s, bin * 25)) * depth) as bigint) as bases
from (select *, unnest(range(s // 25, (e - 1) // 25 + 1)) as bin from runs where depth > 0)
group by sample, chrom, bin"""
BG = "select sample, cast(sum(e - s) as bigint) as total_bases, sum(e - s) / 1e6 as lam_bg from fragments group by sample"
LAM = """
select p.*, greatest(lam_bg, sum(bases) over (partition by p.sample, chrom order by bin
  range between 200 preceding and 200 following) / (401 * 25.0)) as lam
from pile p join bg on p.sample = bg.sample"""
TAIL = """-(k * ln(lam) - lam - lgamma(k + 1.0) + ln(list_sum(list_transform(range(0, 400),
  lambda j: exp(j * ln(lam) - (lgamma(k + j + 1.0) - lgamma(k + 1.0))))))) / ln(10)"""
VALS = f"""
select sample, k, lam, weight, case when k > lam then greatest({TAIL}, 0) else 0 end as score
from (select sample, k, lam, count(*) * 25 as weight from lam group by sample, k, lam)"""
QS = """
select sample, k, lam, score, greatest(0, max(t) over (partition by sample order by score)) as qscore from (
  select *, score + log10(sum(weight) over (partition by sample order by score desc))
    - log10(sum(weight) over (partition by sample)) as t from vals)"""
SCORED = "select l.*, score as pscore, qscore from lam l join qs q on l.sample = q.sample and l.k = q.k and l.lam = q.lam"
STEPS = {"runs": RUNS, "pile": PILE, "bg": BG, "lam": LAM, "vals": VALS, "qs": QS, "scored": SCORED}


def steps(upto: str, **extra: str) -> dict[str, str]:
    names = list(STEPS)
    return {n: STEPS[n] for n in names[: names.index(upto) + 1]} | extra


def _scored(spark, sf):
    return pk.scored_pileup(v.fragments(spark, sf), GENOME)


@query(v.with_views("select sample, chrom, fs as s, fe as e from reads where mate = 1", "reads"))
def fragments_all(spark, sf):
    return cov.fragments(cov.extend_reads(v.reads(spark, sf)), "all").select("sample", "chrom", "s", "e")


@query(v.with_views("""
select sample, chrom, s, e, rn as copy from (
  select *, row_number() over (partition by sample, chrom, s, e) as rn
  from (select sample, chrom, s // 50 * 50 as s, s // 50 * 50 + 100 as e from reads where mate = 1))
where rn <= 2""", "reads"))
def fragments_keep_two(spark, sf):
    f = cov.fragments(v.reads(spark, sf)).withColumn("s", F.expr("s div 50 * 50")).withColumn("e", F.col("s") + 100)
    return cov.fragments(f, 2)


@query(v.with_views("select * from pile", "fragments", **steps("pile")))
def pileup_bins(spark, sf):
    return pk.pileup_bins(v.fragments(spark, sf))


@query(v.with_views("select sample, total_bases, round(lam_bg, 4) as lam_bg from bg", "fragments", bg=BG))
def background_rate(spark, sf):
    return pk.background(pk.pileup_bins(v.fragments(spark, sf)), GENOME)


@query(v.with_views("select sample, chrom, bin, k, bases, round(lam, 4) as lam from lam", "fragments", **steps("lam")))
def local_lambda(spark, sf):
    bins = stage(pk.pileup_bins(v.fragments(spark, sf)), "pileup")
    return pk.local_lambda(bins, pk.background(bins, GENOME))


@query(v.with_views("select sample, k, round(lam, 4) as lam, weight, round(score, 4) as score from vals", "fragments", **steps("vals")))
def poisson_scores(spark, sf):
    bins = stage(pk.pileup_bins(v.fragments(spark, sf)), "pileup")
    lam = pk.local_lambda(bins, pk.background(bins, GENOME))
    return pk.score_values(lam)


@query(v.with_views("""
select sample, chrom, bin, k, bases, round(lam, 4) as lam, round(pscore, 4) as pscore, round(qscore, 4) as qscore
from scored""", "fragments", **steps("scored")))
def scored_pileup(spark, sf):
    return _scored(spark, sf)


PEAKS = """
select sample, chrom, min(s) as s, max(e) as e from (
  select *, sum(fresh) over (partition by sample, chrom order by bin) as g from (
    select *, bin * 25 as s, bin * 25 + 25 as e,
      case when bin * 25 - lag(bin * 25 + 25) over (partition by sample, chrom order by bin) <= {gap} then 0 else 1 end as fresh
    from scored where qscore > -log10({q})))
group by sample, chrom, g having max(e) - min(s) >= {length}"""
DEFAULT = PEAKS.format(gap=75, q=0.05, length=100)


@query(v.with_views("select * from called", "fragments", **steps("scored", called=DEFAULT)))
def call_peaks(spark, sf):
    return pk.call_peaks(_scored(spark, sf))


PARAMSETS = {
    "default_params": {},
    "strict": {"q": 0.0001, "min_len": 50, "max_gap": 0},
    "wide": {"q": 0.1, "min_len": 200, "max_gap": 400},
}


@query(v.with_views(f"""
select 'default_params' as paramset, * from ({DEFAULT})
union all select 'strict', * from ({PEAKS.format(gap=0, q=0.0001, length=50)})
union all select 'wide', * from ({PEAKS.format(gap=400, q=0.1, length=200)})""", "fragments", **steps("scored")))
def sweep_paramsets(spark, sf):
    return pk.sweep(_scored(spark, sf), PARAMSETS)


SUMMITS = """
select c.sample, c.chrom, c.s, c.e, arg_max((greatest(c.s, r.s) + least(c.e, r.e)) // 2,
  depth * 1e9 - (greatest(c.s, r.s) + least(c.e, r.e)) // 2) as summit, max(depth) as height
from called c join runs r on r.sample = c.sample and r.chrom = c.chrom and r.s < c.e and c.s < r.e and depth > 0
group by all"""
SUMMITS = SUMMITS.replace("group by all", "group by c.sample, c.chrom, c.s, c.e")


@query(v.with_views("select * from tops", "fragments", **steps("scored", called=DEFAULT, tops=SUMMITS)))
def summits(spark, sf):
    f = v.fragments(spark, sf)
    return pk.summits(stage(pk.call_peaks(_scored(spark, sf)), "peaks"), f)


NARROW = """
select t.sample, t.chrom, t.s, t.e, t.sample || '_peak_' || row_number() over (partition by t.sample order by t.chrom, t.s) as name,
  cast(least(1000, floor(round(qscore * 10, 6))) as bigint) as score, '.' as strand,
  round((k + 1) / (lam + 1), 4) as signal, round(pscore, 4) as pscore, round(qscore, 4) as qscore, summit - t.s as "offset"
from tops t join scored c on c.sample = t.sample and c.chrom = t.chrom and c.bin = t.summit // 25"""


@query(v.with_views(NARROW, "fragments", **steps("scored", called=DEFAULT, tops=SUMMITS)))
def narrowpeak(spark, sf):
    f = v.fragments(spark, sf)
    scored = stage(_scored(spark, sf), "scored")
    peaks = stage(pk.summits(pk.call_peaks(scored), f), "peaks")
    return pk.narrowpeak(peaks, scored)


@query(v.with_views("""
select * from called c where not exists (
  select 1 from excluded x where x.chrom = c.chrom and x.s < c.e and c.s < x.e)""", "fragments", "excluded",
                    **steps("scored", called=DEFAULT)))
def peaks_outside_excluded(spark, sf):
    return exclude_overlaps(pk.call_peaks(_scored(spark, sf)), v.excluded(spark, sf))


def _control_sql(text: str) -> str:
    for name in ("runs", "pile", "bg"):
        text = text.replace(f"from {name}", f"from c{name}")
    return text.replace("from fragments", "from control").replace("from (select sample, chrom, s as p", "from (select sample, chrom, s as p")


CONTROL_LAM = """
select p.sample, p.chrom, p.bin, p.k, p.bases, greatest(any_value(bg.lam_bg),
  coalesce(sum(c.bases), 0) / (401 * 25.0) * any_value(bg.total_bases) / any_value(cbg.total_bases)) as lam
from pile p join bg on bg.sample = p.sample join cbg on cbg.sample = p.sample
left join cpile c on c.sample = p.sample and c.chrom = p.chrom and c.bin between p.bin - 200 and p.bin + 200
where p.sample <> 'S3' group by p.sample, p.chrom, p.bin, p.k, p.bases"""


@query(v.with_views("select sample, chrom, bin, k, bases, round(lam, 4) as lam from clam", "fragments",
                    **steps("bg"), control="""
select t as sample, chrom, s, e from fragments cross join (select unnest(['S1', 'S2']) as t) where sample = 'S3'""",
                    cruns=_control_sql(RUNS), cpile=_control_sql(PILE).replace("from cruns", "from cruns"),
                    cbg=_control_sql(BG), clam=CONTROL_LAM))
def local_lambda_with_control(spark, sf):
    f = v.fragments(spark, sf)
    treated = f.filter("sample <> 'S3'")
    control = f.filter("sample = 'S3'").withColumn("sample", F.explode(F.array(F.lit("S1"), F.lit("S2"))))
    bins, other = stage(pk.pileup_bins(treated), "pileup"), stage(pk.pileup_bins(control), "control")
    return pk.local_lambda(bins, pk.background(bins, GENOME), control=other, control_rates=pk.background(other, GENOME))


PRUNED = """
select qname, sample, chrom, fs as s, fe as e from marked
where chrom <> 'chrM' and mflag & 3 = 3 and mflag & 3340 = 0 and mate = 1"""


@query(v.with_views(f"""
select * from (
  select 'default_params' as paramset, * from ({DEFAULT})
  union all select 'strict', * from ({PEAKS.format(gap=0, q=0.0001, length=50)})
  union all select 'wide', * from ({PEAKS.format(gap=400, q=0.1, length=200)})) f
where not exists (select 1 from excluded x where x.chrom = f.chrom and x.s < f.e and f.s < x.e)""",
                    "excluded", "marked", fragments=PRUNED, **steps("scored")))
def atac_peaks_outside_excluded(spark, sf):
    """From alignments to filtered peaks under three parameter sets."""
    from .trunk import atac_peaks, prune_atac, whole_fragments

    fragments = stage(whole_fragments(prune_atac(v.alignments(spark, sf), "mm10")), "fragments")
    return atac_peaks(fragments, GENOME, PARAMSETS, v.excluded(spark, sf))["peaks"].select("paramset", "sample", "chrom", "s", "e")
