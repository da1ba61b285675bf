"""Queries on sequencing reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import strip_mate_suffix as strip_mate
from ..operators import reads as rd
from . import views as v
from .registry import query


@query(v.with_views("select file, idx, name, seq, qual from fastq", "fastq"))
def assemble_records(spark, sf):
    """Numbered lines back to records."""
    f = v.fastq(spark, sf)
    text = F.posexplode(F.array(F.concat(F.lit("@"), "name"), F.col("seq"), F.lit("+"), F.col("qual")))
    lines = f.select("file", "idx", text.alias("i", "value")).select(
        "file", (F.col("idx") * 4 + F.col("i")).alias("line_no"), "value")
    return rd.assemble_records(lines)


@query(v.with_views("""
select 'T' || substr(file, 2, 1) || (case when file like 'F3%' then 'b' else 'a' end) as sample, mate as read,
  0::bigint as ordinal, idx, name from fastq where file like 'F3%'
union all
select 'TA', mate, cast(substr(file, 2, 1) as bigint) - 1, idx, name from fastq where file not like 'F3%'""".replace(
    "'T' || substr(file, 2, 1) || (case when file like 'F3%' then 'b' else 'a' end)", "'TB'"), "fastq"))
def concat_reads(spark, sf):
    """Files F1 and F2 are two lanes of sample TA, F3 is sample TB."""
    f = v.fastq(spark, sf)
    manifest = (
        f.select("file", F.col("mate").alias("read")).distinct()
        .withColumn("sample", F.when(F.col("file").startswith("F3"), "TB").otherwise("TA"))
        .groupBy("sample", "read").agg(F.sort_array(F.collect_list("file")).alias("paths")))
    return rd.concat_reads(f, manifest).select("sample", "read", "ordinal", "idx", "name")


@query(v.with_views("select file, count(*) as reads from fastq group by file", "fastq"))
def count_reads(spark, sf):
    return rd.count_reads(v.fastq(spark, sf))


CHUNKS = """
select file, idx, name, lane, format('s1_L{{:03d}}_R1.fastq', lane) as out_file from (
  select file, idx, name, {lane} - 1 + cast(sum(opens) over (partition by file order by idx) as bigint) as lane from (
    select *, case when (idx + 1) % d = 1 and n - (idx + 1) >= d then 1 else 0 end as opens from (
      select *, {d} as d from (select *, count(*) over (partition by file) as n from fastq))))"""


@query(v.with_views(CHUNKS.format(lane=1, d="n // 4"), "fastq"))
def split_reads_into_files(spark, sf):
    return rd.split_reads(v.fastq(spark, sf), "s1", 1, 1, files=4).select("file", "idx", "name", "lane", "out_file")


@query(v.with_views(CHUNKS.format(lane=5, d="700"), "fastq"))
def split_reads_by_count(spark, sf):
    return rd.split_reads(v.fastq(spark, sf), "s1", 1, 5, per_file=700).select("file", "idx", "name", "lane", "out_file")


# Every template under the same name in two samples; in the second one the first mate of each fifth is missing.
SHARED = """
select 'S' || s.k as sample, file, mate, idx, 'T.' || split_part(name, '.', 2) as name, seq from fastq
cross join (select unnest([1, 2]) as k) s where not (s.k = 2 and mate = 1 and key % 5 = 0)"""


def _shared(spark, sf):
    key = F.substring_index("name", ".", -1)
    return v.fastq(spark, sf).select(
        F.explode(F.array(F.lit("S1"), F.lit("S2"))).alias("sample"), "file", "mate", "idx",
        F.concat(F.lit("T."), key).alias("name"), "seq"
    ).filter(~((F.col("sample") == "S2") & (F.col("mate") == 1) & (F.substring_index("name", ".", -1).cast("bigint") % 5 == 0)))


@query(v.with_views("""
select file, idx, name, seq from shared f where exists (
  select 1 from reads r join excluded x on x.chrom = r.chrom and x.s < r.e and r.s < x.e
  where r.sample = f.sample and 'T.' || r.qname = f.name)""",
                    "fastq", "reads", "excluded", shared=SHARED))
def subset_reads(spark, sf):
    """Reads of the templates that touch a region; every name occurs in two samples."""
    from ..operators.intervals import region_read_names

    names = region_read_names(v.excluded(spark, sf), v.reads(spark, sf))
    named = names.select("sample", F.concat(F.lit("T."), "qname").alias("name"))
    return rd.subset_reads(_shared(spark, sf), named).select("file", "idx", "name", "seq")


@query(v.with_views("""
select substr(a.file, 2, 1) as sample, a.idx, a.name, a.seq, b.name as name_2, b.seq as seq_2, a.name = b.name as same_name
from fastq a join fastq b on substr(a.file, 2, 1) = substr(b.file, 2, 1) and a.idx = b.idx where a.mate = 1 and b.mate = 2""", "fastq"))
def pair_mates(spark, sf):
    f = v.fastq(spark, sf).withColumn("sample", F.substring("file", 2, 1)).withColumn("ordinal", F.lit(0))
    pairs = rd.pair_mates(f.filter("mate = 1"), f.filter("mate = 2"))
    return pairs.select("sample", "idx", "name", "seq", "name_2", "seq_2", "same_name")


@query(v.with_views("select file, idx, name from fastq where idx between 99 and 1498", "fastq"))
def slice_reads(spark, sf):
    return rd.slice_reads(v.fastq(spark, sf), 100, 1499).select("file", "idx", "name")


@query(v.with_views("""
select sample, file, idx, name,
  case when count(*) over (partition by sample, name) = 2 then cast(mate as varchar) else 'single' end as part
from shared""", "fastq", shared=SHARED))
def split_mates(spark, sf):
    return rd.split_mates(_shared(spark, sf)).select("sample", "file", "idx", "name", "part")


@query(v.with_views("select name || '.' || mate as raw, name from fastq", "fastq"))
def strip_mate_suffix(spark, sf):
    raw = F.concat("name", F.lit("."), F.col("mate").cast("string"))
    return v.fastq(spark, sf).select(raw.alias("raw"), strip_mate(raw).alias("name"))
