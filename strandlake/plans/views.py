"""Genomic inputs derived from the given tables, as DataFrames and as SQL text.

Both forms are written separately, so an oracle does not inherit a mistake of the
Spark side. ``SQL`` holds one common table expression per view.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arith import idiv
from ..functions.ranking import row_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def frag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paired-end fragments; a third of them in twenty dense clusters."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        o.alias("fid"),
        "o_custkey",
        _label("S", c % 3 + 1).alias("sample"),
        F.when(c % 50 == 7, F.lit("chrM")).otherwise(_label("chr", c % 5 + 1)).alias("chrom"),
        F.when(o % 3 == 0, (c % 20) * 9000 + 500 + (o * 37) % 300).otherwise((o * 7919 + c * 31) % 200000).alias("pos"),
        (c % 240 + 80).alias("tlen"),
    )


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frag(spark, sf_dir).select(
        "fid", "sample", "chrom", F.col("pos").alias("s"), (F.col("pos") + F.col("tlen")).alias("e")
    )


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment rows: two mates per fragment, either one in front, some missing, hit count nullable."""
    f, c, m = F.col("fid"), F.col("o_custkey"), F.col("mate")
    first = m == 1
    left = first != (f % 7 == 3)  # every seventh template was read from its other end

    def bit(cond: Column, value: int) -> Column:
        return F.when(cond, F.lit(value)).otherwise(F.lit(0))

    flag = (
        F.lit(1)
        + bit(c % 13 != 0, 2)
        + bit(f % 29 == 0, 4)
        + bit(f % 31 == 0, 8)
        + F.when(first, F.lit(64)).otherwise(F.lit(128))
        + bit((f + m) % 37 == 0, 256)
        + bit(f % 41 == 0, 512)
        + bit(f % 17 == 0, 1024)
        + bit((f + m) % 43 == 0, 2048)
    )
    return (
        frag(spark, sf_dir)
        .select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
        .filter(~((m == 2) & (f % 19 == 0)))
        .select(
            "sample",
            f.cast("string").alias("qname"),
            "mate",
            "chrom",
            F.when(left, F.col("pos")).otherwise(F.col("pos") + F.col("tlen") - 50).alias("s"),
            F.when(left, F.col("pos") + 50).otherwise(F.col("pos") + F.col("tlen")).alias("e"),
            "tlen",
            F.when(left, F.lit("+")).otherwise(F.lit("-")).alias("strand"),
            flag.alias("flag"),
            F.when((f + m) % 11 != 0, 1 + (f * m) % 4).cast("int").alias("x0"),
        )
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with clipped ends, base qualities and mapping quality."""
    f = F.col("qname").cast("bigint")
    return reads(spark, sf_dir).select(
        "*",
        F.when(f % 23 == 0, F.lit("5S45M"))
        .when(f % 23 == 1, F.lit("45M5S"))
        .when(f % 23 == 2, F.lit("2H3S45M"))
        .otherwise(F.lit("50M"))
        .alias("cigar"),
        F.repeat(F.char(33 + f % 40), F.lit(50)).alias("qual"),
        F.rpad(F.translate(F.md5(f.cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT"), 50, "ACGTT").alias("seq"),
        (f % 60).cast("int").alias("mapq"),
    )


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excluded regions, overlapping each other on purpose."""
    k = F.col("s_suppkey")
    s = (k * 1013) % 20000
    return table(spark, sf_dir, "supplier").select(
        k.alias("bid"), _label("chr", k % 5 + 1).alias("chrom"), s.alias("s"), (s + 200 + (k % 7) * 300).alias("e")
    )


def tss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point features, start = end."""
    k = F.col("p_partkey")
    s = (k * 3001) % 200000
    return table(spark, sf_dir, "part").select(
        k.alias("tid"),
        _label("chr", k % 5 + 1).alias("chrom"),
        s.alias("s"),
        s.alias("e"),
        F.when(F.col("p_size") % 2 == 0, F.lit("+")).otherwise(F.lit("-")).alias("strand"),
    )


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Called regions of one sample set, each with an id."""
    k = F.col("p_partkey")
    s = (k * 3001) % 200000
    return table(spark, sf_dir, "part").select(
        _label("P", k).alias("id"),
        _label("S", k % 3 + 1).alias("sample"),
        _label("chr", k % 5 + 1).alias("chrom"),
        s.alias("s"),
        (s + 100 + F.col("p_size") * 10).alias("e"),
    )


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32-base sequences."""
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        k.alias("sid"),
        F.translate(F.md5(k.cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"),
    )


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as records of three files per mate, numbered in each file."""
    k, m = F.col("o_orderkey"), F.col("mate")
    file = F.concat(_label("F", F.col("o_custkey") % 3 + 1), F.lit("_R"), m.cast("string"))
    base = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
        .filter(~((m == 2) & (k % 19 == 0)))
        .select(
            file.alias("file"),
            "mate",
            k.alias("key"),
            F.concat(_label("SRR", F.col("o_custkey") % 3 + 1), F.lit("."), k.cast("string")).alias("name"),
            F.translate(
                F.md5(F.concat(k.cast("string"), F.lit("/"), m.cast("string"))), "0123456789abcdef", "ACGTACGTACGTACGT"
            ).alias("seq"),
            F.repeat(F.char(33 + k % 40), F.lit(32)).alias("qual"),
        )
    )
    return row_index(base, ["file"], "key").drop("key")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samplesheet; blank cells are null."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("lib"),
        _label("N", k).alias("sample"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("hg19"))
        .when(F.col("c_nationkey") % 3 == 1, F.lit("hg38"))
        .otherwise(F.lit("mm10"))
        .alias("genome"),
        F.when(k % 4 != 0, _label("N", k - k % 4)).alias("input"),
        F.when(k % 4 == 1, F.lit("hg19r")).alias("homer_fmg_genome"),
        _label("d/N", k).alias("basepath"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat listing: two lanes, two mates and one file without a read number per sample."""
    tails = ["_L001_R1.fastq.gz", "_L001_R2.fastq.gz", "_L002_R1.fastq.gz", "_L002_R2.fastq.gz", ".fastq.gz"]
    return samples(spark, sf_dir).select(
        "sample",
        F.explode(F.array(*[F.concat(F.lit("d/"), F.col("sample"), F.lit(t)) for t in tails])).alias("path"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run table: accession, and the biological sample it belongs to."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _label("SRR", k + 5799000).alias("Run"), _label("SAMN", idiv(k, 3) + 7312000).alias("BioSample"),
        k.alias("ord"),
    )


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of most runs (every seventh run has none), two mates each."""
    r = runs(spark, sf_dir).filter(F.col("ord") % 7 != 0)
    return r.select(
        F.explode(
            F.array(*[F.concat(F.lit("d/"), F.col("Run"), F.lit(f"_{m}.fastq.gz")) for m in (1, 2)])
        ).alias("path")
    )


SQL = {
    "frag": """
select o_orderkey as fid, o_custkey,
  'S' || cast(1 + o_custkey % 3 as varchar) as sample,
  case when o_custkey % 50 = 7 then 'chrM' else 'chr' || cast(1 + o_custkey % 5 as varchar) end as chrom,
  case when o_orderkey % 3 = 0 then (o_custkey % 20) * 9000 + 500 + (o_orderkey * 37) % 300
       else (o_orderkey * 7919 + o_custkey * 31) % 200000 end as pos,
  80 + o_custkey % 240 as tlen
from orders""",
    "fragments": """
select fid, sample, chrom, pos as s, pos + tlen as e from frag""",
    "reads": """
select f.fid, f.sample, cast(f.fid as varchar) as qname, m.mate, f.chrom,
  case when (m.mate = 1) <> (f.fid % 7 = 3) then f.pos else f.pos + f.tlen - 50 end as s,
  case when (m.mate = 1) <> (f.fid % 7 = 3) then f.pos + 50 else f.pos + f.tlen end as e,
  f.pos as fs, f.pos + f.tlen as fe, f.tlen,
  case when (m.mate = 1) <> (f.fid % 7 = 3) then '+' else '-' end as strand,
  1::bigint + (case when f.o_custkey % 13 = 0 then 0 else 2 end)
    + (case when f.fid % 29 = 0 then 4 else 0 end)
    + (case when f.fid % 31 = 0 then 8 else 0 end)
    + (case when m.mate = 1 then 64 else 128 end)
    + (case when (f.fid + m.mate) % 37 = 0 then 256 else 0 end)
    + (case when f.fid % 41 = 0 then 512 else 0 end)
    + (case when f.fid % 17 = 0 then 1024 else 0 end)
    + (case when (f.fid + m.mate) % 43 = 0 then 2048 else 0 end) as flag,
  case when (f.fid + m.mate) % 11 = 0 then null else 1 + (f.fid * m.mate) % 4 end as x0
from frag f cross join (select unnest([1::bigint, 2::bigint]) as mate) m
where not (m.mate = 2 and f.fid % 19 = 0)""",
    "alignments": """
select *, case fid % 23 when 0 then '5S45M' when 1 then '45M5S' when 2 then '2H3S45M' else '50M' end as cigar,
  repeat(chr(cast(33 + fid % 40 as integer)), 50) as qual,
  rpad(translate(md5(qname), '0123456789abcdef', 'ACGTACGTACGTACGT'), 50, 'ACGTT') as seq,
  fid % 60 as mapq
from reads""",
    "marked": """
select r.*, case when fl.cand and not fl.won then (flag & ~1024::bigint) | 1024 else flag & ~1024::bigint end as mflag
from reads r join (
  with c as (
    select sample, qname, mate, fid, chrom, strand,
      s - case fid % 23 when 0 then 5 when 2 then 5 else 0 end as us,
      e + case fid % 23 when 1 then 5 else 0 end as ue,
      case when fid % 40 >= 15 then 50 * (fid % 40) else 0 end as q
    from reads where flag & 2308 = 0),
  u as (
    select *, count(*) over (partition by qname) as nm,
      min(us) over (partition by qname) as ps, max(ue) over (partition by qname) as pe,
      sum(q) over (partition by qname) as pq from c),
  k as (
    select *, case when nm = 2 then 0 else mate end as m,
      case when nm = 2 then ps when strand = '-' then ue else us end as k1,
      case when nm = 2 then pe else -1 end as k2,
      case when nm = 2 then '+-' else strand end as st,
      case when nm = 2 then pq else q end as kq from u),
  v as (
    select *, dense_rank() over (partition by sample, chrom, k1, k2, st order by kq desc, qname, m) = 1 as won from k)
  select qname, mate, true as cand, won from v
  union all
  select qname, mate, false, false from reads where flag & 2308 <> 0) fl
on r.qname = fl.qname and r.mate = fl.mate""",
    "excluded": """
select s_suppkey as bid, 'chr' || cast(1 + s_suppkey % 5 as varchar) as chrom,
  (s_suppkey * 1013) % 20000 as s, (s_suppkey * 1013) % 20000 + 200 + (s_suppkey % 7) * 300 as e
from supplier""",
    "tss": """
select p_partkey as tid, 'chr' || cast(1 + p_partkey % 5 as varchar) as chrom,
  (p_partkey * 3001) % 200000 as s, (p_partkey * 3001) % 200000 as e,
  case when p_size % 2 = 0 then '+' else '-' end as strand
from part""",
    "peaks": """
select 'P' || p_partkey as id, 'S' || (1 + p_partkey % 3) as sample, 'chr' || (1 + p_partkey % 5) as chrom,
  (p_partkey * 3001) % 200000 as s, (p_partkey * 3001) % 200000 + 100 + p_size * 10 as e
from part""",
    "seqs": """
select doc_id as sid, translate(md5(cast(doc_id as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq
from documents""",
    "fastq": """
select *, row_number() over (partition by file order by key) - 1 as idx from (
  select 'F' || (1 + o_custkey % 3) || '_R' || m.mate as file, m.mate, o_orderkey as key,
    'SRR' || (1 + o_custkey % 3) || '.' || o_orderkey as name,
    translate(md5(o_orderkey || '/' || m.mate), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq,
    repeat(chr(cast(33 + o_orderkey % 40 as integer)), 32) as qual
  from orders cross join (select unnest([1::bigint, 2::bigint]) as mate) m
  where not (m.mate = 2 and o_orderkey % 19 = 0))""",
    "samples": """
select cast(c_custkey as varchar) as lib, 'N' || c_custkey as sample,
  case c_nationkey % 3 when 0 then 'hg19' when 1 then 'hg38' else 'mm10' end as genome,
  case when c_custkey % 4 <> 0 then 'N' || (c_custkey - c_custkey % 4) end as input,
  case when c_custkey % 4 = 1 then 'hg19r' end as homer_fmg_genome,
  'd/N' || c_custkey as basepath
from customer""",
    "files": """
select sample, 'd/' || sample || t as path from samples cross join (
  select unnest(['_L001_R1.fastq.gz', '_L001_R2.fastq.gz', '_L002_R1.fastq.gz', '_L002_R2.fastq.gz', '.fastq.gz']) as t)""",
    "runs": """
select 'SRR' || (c_custkey + 5799000) as Run, 'SAMN' || (c_custkey // 3 + 7312000) as BioSample, c_custkey as ord
from customer""",
    "run_files": """
select 'd/' || Run || '_' || m || '.fastq.gz' as path
from runs cross join (select unnest([1, 2]) as m) where ord % 7 <> 0""",
}

_NEEDS = {
    "fragments": ["frag"],
    "reads": ["frag"],
    "alignments": ["reads"],
    "marked": ["reads"],
    "files": ["samples"],
    "run_files": ["runs"],
}


def with_views(sql: str, *names: str, **extra: str) -> str:
    """Puts the named views (and what they need) before a query as common table expressions.

    ``extra`` adds further expressions, in order, after the views.
    """
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} as ({SQL[n].strip()})" for n in order] + [f"{n} as ({q.strip()})" for n, q in extra.items()]
    return "with " + ",\n".join(parts) + "\n" + sql.strip()
