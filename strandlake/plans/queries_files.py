"""Queries that write the derived tables as files and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..functions.arith import idiv
from ..operators import alignments as al, coverage as cov, qc, tags as tg
from ..session import scratch_path, stage
from ..sources import genomic as gs, tables as ts
from ..sources.text import numbered_lines
from . import views as v
from .queries_coverage import BINS
from .queries_motifs import GENOME, _genome
from .registry import query


@query(v.with_views("select * from samples", "samples"))
def read_samplesheet(spark, sf):
    path = scratch_path(spark, "samplesheet")
    v.samples(spark, sf).write.option("header", True).csv(path)
    return ts.read_samplesheet(spark, path)


@query(v.with_views("""
select Run, BioSample, case when ord % 4 = 0 then null else 'H3K27ac (' || ord || ', Active Motif)' end as antibody, ord * 1000 as Bases
from runs""", "runs"))
def read_run_table(spark, sf):
    """Commas stand in quotes, some behind a backslash; NA is a blank cell."""
    path = scratch_path(spark, "runs")
    antibody = F.when(F.col("ord") % 4 == 0, F.lit("NA")).otherwise(F.concat(
        F.lit('"H3K27ac ('), F.col("ord").cast("string"), F.when(F.col("ord") % 2 == 0, F.lit("\\,")).otherwise(","),
        F.lit(' Active Motif)"')))
    line = F.concat_ws(",", "Run", "BioSample", antibody, (F.col("ord") * 1000).cast("string"))
    # the header line is the first of its file, as Spark expects it of each
    rows = v.runs(spark, sf).select(F.spark_partition_id().alias("part"), line.alias("value"))
    head = rows.select("part").distinct().select("part", F.lit(0).alias("n"), F.lit("Run,BioSample,antibody,Bases").alias("value"))
    text = rows.select("part", F.lit(1).alias("n"), "value").unionByName(head)
    text.repartition("part").sortWithinPartitions("part", "n").select("part", "value").write.partitionBy("part").text(path + "/t")
    return ts.read_run_table(spark, path + "/t/*", "Run string, BioSample string, antibody string, Bases bigint")


@query(v.with_views("select Run as accession from runs", "runs"))
def read_accessions(spark, sf):
    path = scratch_path(spark, "accessions")
    comment = F.when(F.col("ord") % 2 == 0, " # input").otherwise("")
    v.runs(spark, sf).select(F.concat("Run", comment).alias("value")).write.text(path)
    return ts.read_accessions(spark, path)


@query(v.with_views("select distinct file from fastq", "fastq"))
def list_reads(spark, sf):
    path = scratch_path(spark, "listing")
    sinks.write_fastq(v.fastq(spark, sf), path)
    found = ts.list_reads(spark, path, "file=*/*.txt.gz")
    return found.select(F.regexp_extract("path", r"/file=([^/]+)/", 1).alias("file")).distinct()


@query(v.with_views("select file, idx, name, seq, qual from fastq", "fastq"))
def fastq_round_trip(spark, sf):
    path = scratch_path(spark, "fastq")
    sinks.write_fastq(v.fastq(spark, sf), path)
    return gs.read_fastq(spark, path, F.regexp_extract("path", r"/file=([^/]+)/", 1))


@query(v.with_views("""
select sample, qname, mate, chrom, s, s + case when fid % 23 < 3 then 45 else 50 end as e, strand,
  flag | case strand when '-' then 16 else 0 end as flag, mapq, cigar, tlen, seq, qual, x0, null::varchar as reject,
  case when mate = 1 then chrom else 'chrX' end as mate_chrom, s + 100 as mate_s,
  'RG=g' || mate || case when x0 is null then ';X?=NO_X0' else ';X0=' || x0 || case when x0 > 2 then ';X?=HI_X0' else '' end end
    || ';XF=1.5' as tags
from alignments""", "alignments"))
def sam_round_trip(spark, sf):
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.concat_ws("=", t["key"], t["value"])), ";")
    return gs.read_alignments(spark, _sam(spark, sf)).select(
        "sample", "qname", "mate", "chrom", "s", "e", "strand", "flag", "mapq", "cigar", "tlen", "seq", "qual", "x0", "reject",
        "mate_chrom", "mate_s", tags.alias("tags"))


def _sam(spark, sf):
    path = scratch_path(spark, "sam")
    a = v.alignments(spark, sf).withColumns({
        "mate_chrom": F.when(F.col("mate") == 1, F.col("chrom")).otherwise("chrX"), "mate_s": F.col("s") + 100,
        "tags": F.create_map(F.lit("RG"), F.concat(F.lit("g"), F.col("mate").cast("string")), F.lit("XF"), F.lit("1.5"))})
    a = al.tag_failures(a, 2).withColumn("flag", F.when(F.col("strand") == "-", F.col("flag").bitwiseOR(F.lit(16))).otherwise(F.col("flag")))
    sinks.write_sam(stage(a, "records"), path)
    return path


SQ = """
select sample, chrom, max(e) as length,
  case when chrom = 'chrM' then 1002 else cast(substr(chrom, 4) as bigint) end as ordinal
from alignments group by sample, chrom"""


@query(v.with_views("""
select sample, row_number() over (partition by sample order by part, ordinal, id) - 1 as line_no, kind, text from (
  select distinct sample, 0 as part, 0 as ordinal, '' as id, 'HD' as kind, '@HD' || chr(9) || 'VN:1.6' || chr(9) || 'SO:coordinate' as text from alignments
  union all select sample, 1, ordinal, '', 'SQ', '@SQ' || chr(9) || 'SN:' || chrom || chr(9) || 'LN:' || length from sq
  union all select distinct sample, 2, 0, 'g' || mate, 'RG', '@RG' || chr(9) || 'ID:g' || mate || chr(9) || 'SM:' || sample from alignments)""",
                    "alignments", sq=SQ))
def sam_header_round_trip(spark, sf):
    """Header lines as read back: order, sequence dictionary, read groups."""
    return gs.read_sam_header(spark, _sam(spark, sf)).select("sample", "line_no", "kind", "text")


@query(v.with_views("""
select a.sample, qname, mate, a.chrom, s, row_number() over (partition by a.sample order by ordinal, s, qname, mate,
  flag | case strand when '-' then 16 else 0 end) - 1 as place
from alignments a join sq on sq.sample = a.sample and sq.chrom = a.chrom""", "alignments", sq=SQ))
def sam_order(spark, sf):
    """Place of each record in its sample's file, which is that of the dictionary and the position."""
    sample = F.regexp_extract("path", r"/sample=([^/]+)/", 1)
    lines = numbered_lines(spark, _sam(spark, sf) + "/*", sample)
    f = F.split("value", "\t")
    heads = lines.filter(F.col("value").startswith("@")).groupBy("path").agg(F.count("*").alias("heads"))
    return lines.filter(~F.col("value").startswith("@")).join(heads, "path").select(
        F.col("path").alias("sample"), f[0].alias("qname"), F.when(f[1].cast("int").bitwiseAND(F.lit(128)) != 0, 2).otherwise(1).alias("mate"),
        f[2].alias("chrom"), (f[3].cast("bigint") - 1).alias("s"), (F.col("line_no") - F.col("heads")).alias("place"))


@query(v.with_views("""
select sample, qname, mate, chrom, s, e, flag from reads where chrom = 'chr3' and s < 90000 and e > 30000""", "reads"))
def alignments_by_region(spark, sf):
    """Written by sample and chromosome; the region is read from one folder per sample."""
    path = scratch_path(spark, "alignments")
    sinks.write_alignments(v.reads(spark, sf), path)
    return al.region(spark.read.parquet(path), "chr3", 30000, 90000).select("sample", "qname", "mate", "chrom", "s", "e", "flag")


@query(v.with_views("""
select paramset, sample, chrom, s, e, id as name from peaks cross join (select unnest(['a', 'b.c']) as paramset)""", "peaks"))
def intervals_round_trip(spark, sf):
    path = scratch_path(spark, "intervals")
    p = v.peaks(spark, sf).withColumn("paramset", F.explode(F.array(F.lit("a"), F.lit("b.c"))))
    sinks.write_intervals(p.select("paramset", "sample", "chrom", "s", "e", F.col("id").alias("name")), path)
    return gs.read_table(spark, path, gs.BED + ", name string, paramset string, sample string")


@query(v.with_views("select chrom, s, e from excluded", "excluded"))
def bed_round_trip(spark, sf):
    """Gzipped, with a label in the fourth column."""
    path = scratch_path(spark, "bed")
    b = v.excluded(spark, sf).select("chrom", "s", "e", F.lit("High Signal Region"))
    b.write.option("sep", "\t").option("compression", "gzip").csv(path)
    return gs.read_bed(spark, path)


@query(v.with_views("""
select chrom, s, e, id as name, e - s as score, '.' as strand, round((e - s) / 7, 4) as signal, round((e - s) / 9, 4) as pscore,
  round((e - s) / 11, 4) as qscore, (e - s) // 2 as "offset" from peaks""", "peaks"))
def narrowpeak_round_trip(spark, sf):
    path = scratch_path(spark, "narrowpeak")
    n = F.col("e") - F.col("s")
    v.peaks(spark, sf).select(
        "chrom", "s", "e", F.col("id").alias("name"), n.alias("score"), F.lit(".").alias("strand"), (n / 7).alias("signal"),
        (n / 9).alias("pscore"), (n / 11).alias("qscore"), idiv(n, 2).alias("offset")).write.option("sep", "\t").csv(path)
    return gs.read_narrowpeak(spark, path)


@query(v.with_views("""
select sample, 0::bigint as line_no, id || ' ' || chrom || ' ' || (s + 1) || ' ' || e || ' + ' || (e - s) || '.0' as text from peaks
union all
select sample, 2, '# total peaks = ' || count(*) from peaks group by sample
union all
select sample, 1, '# sample = ' || sample from peaks group by sample""", "peaks"))
def hpeaks_round_trip(spark, sf):
    path = scratch_path(spark, "hpeaks")
    p = v.peaks(spark, sf)
    rows = p.select("sample", "id", "chrom", (F.col("s") + 1).alias("start"), F.col("e").alias("end"), F.lit("+").alias("strand"),
                    (F.col("e") - F.col("s")).alias("score"))
    facts = p.groupBy("sample").agg(F.count(F.lit(1)).alias("n")).select("sample", F.posexplode(F.array(
        F.concat(F.lit("# sample = "), "sample"), F.concat(F.lit("# total peaks = "), F.col("n").cast("string")))).alias("i", "text"))
    sinks.write_peak_report(facts.select("sample", (F.col("i") + 1).alias("line_no"), "text"), rows, path)
    header, back = gs.read_hpeaks(spark, path)
    sample = F.regexp_extract("path", r"/sample=([^/]+)/", 1)
    text = F.concat_ws(" ", "id", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand", F.col("score").cast("string"))
    return header.select(sample.alias("sample"), "line_no", "text").unionByName(
        back.select("sample", F.lit(0).cast("bigint").alias("line_no"), text.alias("text")))


@query(v.with_views("select sample, chrom, bin * 25 as s, bin * 25 + 25 as e, cast(n as double) as value from bins", "fragments", bins=BINS))
def track_round_trip(spark, sf):
    path = scratch_path(spark, "track")
    bins = cov.bin_coverage(v.fragments(spark, sf))
    sinks.write_track(bins.select("sample", "chrom", (F.col("bin") * 25).alias("s"), (F.col("bin") * 25 + 25).alias("e"),
                                  F.col("n").cast("double").alias("value")), path)
    return gs.read_table(spark, path, gs.BEDGRAPH + ", sample string")


@query(v.with_views("""
select 'a' as paramset, sample, count(*) as total, count(*) filter (where flag & 1 <> 0) as paired,
  count(*) filter (where flag & 2 <> 0) as proper, count(*) filter (where flag & 4 <> 0) as unmapped,
  count(*) filter (where flag & 8 <> 0) as mate_unmapped, count(*) filter (where flag & 256 <> 0) as secondary,
  count(*) filter (where flag & 2048 <> 0) as supplementary, count(*) filter (where flag & 512 <> 0) as qc_fail,
  count(*) filter (where flag & 1024 <> 0) as duplicate
from reads group by sample""", "reads"))
def metrics_round_trip(spark, sf):
    path = scratch_path(spark, "metrics")
    counts = qc.read_counts(v.reads(spark, sf)).withColumn("paramset", F.lit("a"))
    sinks.write_metrics(counts, path)
    return ts.read_metrics(spark, path, "paramset string, sample string, " + ", ".join(
        f"{c} bigint" for c in counts.columns if c not in ("paramset", "sample")))


@query(v.with_views("""
select sample || chr(9) || metric || chr(9) || n || '.0' as line from (
  unpivot (
    select sample, count(*) as total, count(*) filter (where flag & 1 <> 0) as paired,
      count(*) filter (where flag & 2 <> 0) as proper, count(*) filter (where flag & 4 <> 0) as unmapped,
      count(*) filter (where flag & 8 <> 0) as mate_unmapped, count(*) filter (where flag & 256 <> 0) as secondary,
      count(*) filter (where flag & 2048 <> 0) as supplementary, count(*) filter (where flag & 512 <> 0) as qc_fail,
      count(*) filter (where flag & 1024 <> 0) as duplicate
    from reads group by sample) on columns(* exclude (sample)) into name metric value n)""", "reads"))
def metrics_summary(spark, sf):
    path = scratch_path(spark, "summary")
    sinks.write_summary(qc.long_metrics(qc.read_counts(v.reads(spark, sf))), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(v.with_views("""
select sample, cast(count(*) filter (where mflag & 1024 <> 0) as varchar) as duplicates from marked where flag & 2308 = 0 group by sample""", "marked"))
def duplicate_metrics_file(spark, sf):
    path = scratch_path(spark, "duplicates")
    m = al.duplicate_metrics(al.mark_duplicates(v.alignments(spark, sf)))
    sinks.write_table(m.select("sample", (F.col("pair_duplicates") + F.col("single_duplicates")).alias("duplicates")), path)
    return spark.read.option("sep", "\t").option("header", True).csv(path)


@query(v.with_views("select sample, id, chrom, cast(s + 1 as varchar) as start, cast(e as varchar) as \"end\" from peaks", "peaks"))
def peak_table_file(spark, sf):
    path = scratch_path(spark, "xls")
    p = v.peaks(spark, sf).select("sample", "id", "chrom", (F.col("s") + 1).alias("start"), F.col("e").alias("end"))
    sinks.write_table(p, path, ["sample"])
    return spark.read.option("sep", "\t").option("header", True).csv(path).select("sample", "id", "chrom", "start", "end")


FASTA = """
select chrom, off, substr(whole, off + 1, 107) as seq from (
  select chrom, whole, unnest(range(0, length(whole), 100)) as off from (
    select chrom, string_agg(seq, '' order by off) as whole from genome group by chrom))"""


@query(v.with_views(FASTA, "seqs", genome=GENOME))
def read_sequences(spark, sf):
    """One text line per 32 bases; chunks of 100 bases with 7 of the next."""
    path = scratch_path(spark, "fasta")
    g = _genome(spark, sf)
    heads = g.select("chrom").distinct().select("chrom", F.lit(-1).cast("bigint").alias("off"), F.concat(F.lit(">"), "chrom", F.lit(" test")).alias("value"))
    lines = heads.unionByName(g.select("chrom", "off", F.col("seq").alias("value")))
    lines.repartition("chrom").sortWithinPartitions("chrom", "off").select("chrom", "value").write.partitionBy("chrom").text(path)
    return gs.read_sequences(spark, path + "/*", 100, 7)
