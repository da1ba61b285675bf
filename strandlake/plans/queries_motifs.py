"""Queries on sequence content, words and read placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import idiv
from ..operators import motifs as mo, placement as pl
from . import views as v
from .registry import query

CHUNK = 32
GENOME = "select 'chr' || (1 + sid % 5) as chrom, sid // 5 * 32 as off, seq from seqs"
SPOTS = """
select 'P' || p_partkey as id, 'S' || (1 + p_partkey % 3) as sample, 'chr' || (1 + p_partkey % 5) as chrom,
  (p_partkey * 37) % 6000 as s, (p_partkey * 37) % 6000 + 20 + p_size as e from part"""
CUT = """
select id, sample, p.chrom, p.s, p.e, string_agg(substr(seq, cast(greatest(p.s, off) - off + 1 as bigint),
  cast(least(p.e, off + 32) - greatest(p.s, off) as bigint)), '' order by off) as seq
from spots p join genome g on g.chrom = p.chrom and g.off < p.e and p.s < g.off + 32
group by id, sample, p.chrom, p.s, p.e"""
GC = "(length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')))"


def _genome(spark, sf):
    k = F.col("sid")
    return v.seqs(spark, sf).select(
        F.concat(F.lit("chr"), (k % 5 + 1).cast("string")).alias("chrom"), (idiv(k, 5) * CHUNK).alias("off"), "seq")


def _spots(spark, sf):
    k = F.col("p_partkey")
    s = (k * 37) % 6000
    return v.table(spark, sf, "part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("id"), F.concat(F.lit("S"), (k % 3 + 1).cast("string")).alias("sample"),
        F.concat(F.lit("chr"), (k % 5 + 1).cast("string")).alias("chrom"), s.alias("s"), (s + 20 + F.col("p_size")).alias("e"))


@query(v.with_views("select * from cut", "seqs", genome=GENOME, spots=SPOTS, cut=CUT))
def peak_sequences(spark, sf):
    return mo.peak_sequences(_spots(spark, sf), _genome(spark, sf), CHUNK, ["id", "sample"])


@query(v.with_views(f"""
select sample, {GC} * 20 // length(seq) as gc_bin, count(*) as n from cut group by all""", "seqs", genome=GENOME, spots=SPOTS, cut=CUT))
def gc_profile(spark, sf):
    return mo.gc_profile(_spots(spark, sf), _genome(spark, sf), CHUNK)


@query(v.with_views(f"""
with t as (select {GC} * 20 // length(seq) as gc_bin, 2 * count(*) as need from seqs where sid % 4 = 0 group by 1)
select sid as id, c.gc_bin, rank from (
  select *, row_number() over (partition by gc_bin order by md5('7:' || sid), sid) as rank
  from (select *, {GC} * 20 // length(seq) as gc_bin from seqs where sid % 4 <> 0)) c
join t on t.gc_bin = c.gc_bin where rank <= need""", "seqs").replace("\nwith t as", ", t as", 1))
def background_regions(spark, sf):
    s = v.seqs(spark, sf).withColumnRenamed("sid", "id")
    return mo.background_regions(s.filter("id % 4 = 0"), s.filter("id % 4 <> 0"), 2, seed=7).select("id", "gc_bin", "rank")


WORDS = """
select sid, kmer from (
  select distinct sid, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) as kmer from (
    select sid, substr(seq, unnest(range(1, length(seq) - {k} + 2)), {k}) as w from {table}))"""


@query(v.with_views("select kmer, count(*) as n from words group by kmer", "seqs", words=WORDS.format(k=6, table="seqs")))
def motif_counts(spark, sf):
    return mo.motif_counts(v.seqs(spark, sf), 6)


@query(v.with_views("""
select rank, kmer, hits, background_hits, round(score, 4) as score from (
  select *, row_number() over (order by round(score, 9) desc, kmer) as rank from (
    select kmer, h as hits, b as background_hits, -ln(list_sum(list_transform(range(h, t + 1),
      lambda i: exp(lgamma(t + 1.0) - lgamma(i + 1.0) - lgamma(t - i + 1.0) + i * ln(p) + (t - i) * ln(1 - p))))) / ln(10) as score
    from (
      select x.kmer, h, coalesce(b, 0) as b, (select count(*) from planted) as t,
        (coalesce(b, 0) + 1) / ((select count(*) from other) + 2) as p
      from (select kmer, count(*) as h from tw group by kmer) x left join (select kmer, count(*) as b from bw group by kmer) y
      on x.kmer = y.kmer)
    where h > t * p))""", "seqs", planted="select sid, case when sid % 2 = 0 then 'TTGACTCA' || substr(seq, 9) else seq end as seq from seqs where sid % 3 = 0",
    other="select * from seqs where sid % 3 <> 0", tw=WORDS.format(k=6, table="planted"), bw=WORDS.format(k=6, table="other")))
def motif_enrichment(spark, sf):
    """Half of the targets carry a planted word."""
    s = v.seqs(spark, sf)
    planted = F.when(F.col("sid") % 2 == 0, F.concat(F.lit("TTGACTCA"), F.substring("seq", 9, 32))).otherwise(F.col("seq"))
    return mo.motif_enrichment(s.filter("sid % 3 = 0").withColumn("seq", planted), s.filter("sid % 3 <> 0"), 6)


SCORED = """
select sample, rank, kmer, hits, background_hits, round(score, 4) as score from (
  select *, row_number() over (partition by sample order by round(score, 9) desc, kmer) as rank from (
    select sample, kmer, h as hits, b as background_hits, -ln(list_sum(list_transform(range(h, t + 1),
      lambda i: exp(lgamma(t + 1.0) - lgamma(i + 1.0) - lgamma(t - i + 1.0) + i * ln(p) + (t - i) * ln(1 - p))))) / ln(10) as score
    from (
      select x.sample, x.kmer, h, coalesce(b, 0) as b, t, (coalesce(b, 0) + 1) / (o + 2) as p
      from (select sample, kmer, count(*) as h from tw join seqs using (sid) join of_sample using (sid) group by all) x
      join (select sample, count(*) filter (where sid % 3 = 0) as t, count(*) filter (where sid % 3 <> 0) as o from of_sample group by sample) n
        on n.sample = x.sample
      left join (select sample, kmer, count(*) as b from bw join of_sample using (sid) group by all) y
        on x.kmer = y.kmer and y.sample = x.sample)
    where h > t * p))"""


@query(v.with_views(SCORED, "seqs", of_sample="select sid, 'S' || (1 + sid % 5 // 3) as sample from seqs",
                    planted="select sid, case when sid % 2 = 0 then 'TTGACTCA' || substr(seq, 9) else seq end as seq from seqs where sid % 3 = 0",
                    other="select * from seqs where sid % 3 <> 0", tw=WORDS.format(k=6, table="planted"), bw=WORDS.format(k=6, table="other")))
def motifs_by_sample(spark, sf):
    """Each sample has its own targets, background and ranks."""
    k = F.col("sid")
    s = v.seqs(spark, sf).withColumn("sample", F.concat(F.lit("S"), (1 + F.floor(k % 5 / 3)).cast("string")))
    planted = F.when(k % 2 == 0, F.concat(F.lit("TTGACTCA"), F.substring("seq", 9, 32))).otherwise(F.col("seq"))
    return mo.motif_enrichment(s.filter("sid % 3 = 0").withColumn("seq", planted), s.filter("sid % 3 <> 0"), 6, ["sample"])


GENOMES = "select *, case when off % 64 = 0 then 'hg19' else 'mm10' end as genome from genome"
OWN_CUT = CUT.replace("join genome g on", "join genomes g on g.genome = case p.sample when 'S1' then 'hg19' else 'mm10' end and")


@query(v.with_views("select id, sample, case sample when 'S1' then 'hg19' else 'mm10' end as genome, chrom, s, e, seq from cut", "seqs",
                    genome=GENOME, genomes=GENOMES, spots=SPOTS, cut=OWN_CUT))
def peak_sequences_by_genome(spark, sf):
    """The bases of each peak from its own sample's genome."""
    spots = _spots(spark, sf).withColumn("genome", F.when(F.col("sample") == "S1", "hg19").otherwise("mm10"))
    bases = _genome(spark, sf).withColumn("genome", F.when(F.col("off") % 64 == 0, "hg19").otherwise("mm10"))
    return mo.peak_sequences(spots, bases, CHUNK, ["id", "sample"])


@query(v.with_views("""
select pos, round(a, 4) as A, round(c, 4) as C, round(g, 4) as G, round(t, 4) as T,
  round(2 + case when a > 0 then a * log2(a) else 0 end + case when c > 0 then c * log2(c) else 0 end
    + case when g > 0 then g * log2(g) else 0 end + case when t > 0 then t * log2(t) else 0 end, 4) as bits
from (
  select pos, avg((b = 'A')::int) as a, avg((b = 'C')::int) as c, avg((b = 'G')::int) as g, avg((b = 'T')::int) as t
  from (select i as pos, substr(seq, i + 1, 1) as b from seqs cross join (select unnest(range(0, 32)) as i)) group by pos)""", "seqs"))
def motif_information(spark, sf):
    return mo.motif_information(v.seqs(spark, sf))


# Reads of 18 to 20 bases cut from the sequences, with a base or two changed, every second one turned around; every
# ninth is of a letter that the reference does not hold.
READS = """
select sid, 'S' || (1 + sid % 3) as sample, 'r' || sid as name, mate, case when (sid + mate) % 2 = 0
  then reverse(translate(cut, 'ACGT', 'TGCA')) else cut end as seq
from (select sid, mate, case when sid % 9 = 4 then repeat('N', 20) else substr(raw, 1, 20 - sid % 3) end as cut from (
  select sid, mate, substr(f, 1, 5) || (case when sid % 5 = 0 then 'A' else substr(f, 6, 1) end) || substr(f, 7, 8)
    || (case when sid % 7 = 0 then 'C' else substr(f, 15, 1) end) || substr(f, 16) as raw
  from (select sid, mate, case when mate = 1 then substr(seq, 1 + sid % 3, 20) else substr(seq, 10 + sid % 4, 20) end as f
        from seqs cross join (select unnest([1::bigint, 2]) as mate))))"""
HITS = """
select sample, name, mate, chrom, pos, strand, len, nm from (
  select sample, name, mate, chrom, pos, strand, len,
    cast(list_sum(list_transform(range(1, len + 1), lambda i: case when substr(q, i, 1) = substr(w, i, 1) then 0 else 1 end)) as bigint) as nm
  from (
    select r.*, win.chrom, win.pos, substr(w, 1, len) as w from ori r join win on substr(q, 1, 6) = substr(w, 1, 6) and len <= length(w)
    union select r.*, win.chrom, win.pos, substr(w, 1, len) from ori r join win on substr(q, 7, 6) = substr(w, 7, 6) and len <= length(w)
    union select r.*, win.chrom, win.pos, substr(w, 1, len) from ori r join win on substr(q, 13, 6) = substr(w, 13, 6) and len <= length(w)))
where nm <= 2"""
ORI = """
select sample, name, mate, '+' as strand, seq as q, length(seq) as len from rd
union all select sample, name, mate, '-', reverse(translate(seq, 'ACGT', 'TGCA')), length(seq) from rd"""
WIN = """
select chrom, off + i as pos, substr(seq, i + 1, 20) as w from genome cross join (select unnest(range(0, 15)) as i)"""
BEST = """
select * from (
  select *, count(*) over (partition by name, mate, nm) as x0,
    row_number() over (partition by name, mate order by nm, chrom, pos, strand) as rn from hits) where rn = 1"""
PLACED = {"genome": GENOME, "rd": READS, "ori": ORI, "win": WIN}


def _reads(spark, sf):
    k, m = F.col("sid"), F.col("mate")
    cut = F.when(m == 1, F.substring(F.col("seq"), (k % 3 + 1).cast("int"), F.lit(20))).otherwise(
        F.substring(F.col("seq"), (k % 4 + 10).cast("int"), F.lit(20)))
    f = v.seqs(spark, sf).select("sid", "seq", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate")).withColumn("f", cut)
    raw = F.concat(
        F.substring("f", 1, 5), F.when(k % 5 == 0, "A").otherwise(F.substring("f", 6, 1)), F.substring("f", 7, 8),
        F.when(k % 7 == 0, "C").otherwise(F.substring("f", 15, 1)), F.substring("f", 16, 20))
    raw = F.when(k % 9 == 4, F.repeat(F.lit("N"), F.lit(20))).otherwise(F.substring(raw, F.lit(1), (F.lit(20) - k % 3).cast("int")))
    turned = F.when((k + m) % 2 == 0, F.reverse(F.translate(raw, "ACGT", "TGCA"))).otherwise(raw)
    return f.select(
        F.concat(F.lit("S"), (k % 3 + 1).cast("string")).alias("sample"), F.concat(F.lit("r"), k.cast("string")).alias("name"),
        "mate", turned.alias("seq"))


@query(v.with_views("select * from hits", "seqs", **PLACED, hits=HITS))
def place_reads(spark, sf):
    return pl.place_reads(_reads(spark, sf), _genome(spark, sf), 2)


@query(v.with_views("""
select r.sample, r.name, r.mate, chrom, pos, strand, len, nm, x0 from rd r left join (
  select *, count(*) over (partition by name, mate, nm) as x0,
    row_number() over (partition by name, mate order by nm, chrom, pos, strand) as rn from hits) h
on h.name = r.name and h.mate = r.mate and h.rn = 1""", "seqs", **PLACED, hits=HITS))
def best_hits(spark, sf):
    return pl.best_placements(_reads(spark, sf), _genome(spark, sf), 2)


@query(v.with_views("""
select r.sample, r.name as qname, 1::bigint as mate, case when b.name is null then 4::bigint when b.strand = '-' then 16 else 0 end as flag,
  chrom, pos as s, pos + len as e, strand, 0::bigint as tlen, nm, x0
from rd r left join best b on b.name = r.name and b.mate = 1 where r.mate = 1""", "seqs", **PLACED, hits=HITS, best=BEST))
def single_alignments(spark, sf):
    """Unpaired reads from text to alignment rows, unmapped ones kept."""
    return pl.single_alignments(pl.best_placements(_reads(spark, sf).filter("mate = 1"), _genome(spark, sf), 2))


PROPER = """
select * from (
  select a.sample, a.name, a.chrom, a.pos as s1, b.pos as s2, a.strand as st1, b.strand as st2, a.nm as nm1, b.nm as nm2,
    a.len as len1, b.len as len2, greatest(a.pos + a.len, b.pos + b.len) - least(a.pos, b.pos) as size,
    row_number() over (partition by a.name order by a.nm + b.nm, a.chrom, a.pos, b.pos, a.strand) as rn
  from hits a join hits b on a.name = b.name and a.chrom = b.chrom and a.mate = 1 and b.mate = 2
  where ((a.strand = '+' and b.strand = '-' and a.pos <= b.pos and a.pos + a.len <= b.pos + b.len)
      or (a.strand = '-' and b.strand = '+' and b.pos <= a.pos and b.pos + b.len <= a.pos + a.len))
    and greatest(a.pos + a.len, b.pos + b.len) - least(a.pos, b.pos) <= 40) where rn = 1"""
MATES = """
select sample, qname, mate, 1::bigint + case mate when 1 then 64 else 128 end + case when size is not null then 2 else 0 end
    + case when os is null then 4 else 0 end + case when fs is null then 8 else 0 end
    + case when ost = '-' then 16 else 0 end + case when fst = '-' then 32 else 0 end as flag,
  chrom, os as s, os + olen as e, ost as strand, coalesce(case when ost = '-' then -size else size end, 0) as tlen, nm, x0
from (
  select n.sample, n.name as qname, n.mate, coalesce(p.chrom, o.chrom) as chrom, size, o.x0,
    case when p.name is null then o.pos when n.mate = 1 then s1 else s2 end as os,
    case when p.name is null then f.pos when n.mate = 1 then s2 else s1 end as fs,
    case when p.name is null then o.strand when n.mate = 1 then st1 else st2 end as ost,
    case when p.name is null then f.strand when n.mate = 1 then st2 else st1 end as fst,
    case when p.name is null then o.nm when n.mate = 1 then nm1 else nm2 end as nm,
    case when p.name is null then o.len when n.mate = 1 then len1 else len2 end as olen
  from (select distinct sample, name, unnest([1::bigint, 2]) as mate from rd) n
  left join best o on o.name = n.name and o.mate = n.mate
  left join best f on f.name = n.name and f.mate <> n.mate
  left join proper p on p.name = n.name)"""


@query(v.with_views(MATES, "seqs", **PLACED, hits=HITS, best=BEST, proper=PROPER))
def join_mates(spark, sf):
    return pl.pair_placements(_reads(spark, sf), _genome(spark, sf), 2, 0, 40)
