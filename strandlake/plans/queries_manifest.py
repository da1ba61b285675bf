"""Queries on samplesheets, run tables and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import manifest as mf
from ..sources.genome import genome_constants as constants
from . import views as v
from .registry import query


@query(v.with_views("""
select sample, genome, case when genome in ('hg19', 'hg38') then 'human' else 'mouse' end as organism,
  case when genome in ('hg19', 'hg38') then 'hs' else 'mm' end as size_code,
  case when genome in ('hg19', 'hg38') then 24::bigint else 21::bigint end as chromosomes from samples""", "samples"))
def genome_constants(spark, sf):
    per_genome = constants(spark).groupBy("genome", "organism", "size_code").agg(F.count(F.lit(1)).alias("chromosomes"))
    return v.samples(spark, sf).join(per_genome, "genome").select("sample", "genome", "organism", "size_code", "chromosomes")


@query(v.with_views("select sample from samples", "samples"))
def require_columns(spark, sf):
    return mf.require_columns(v.samples(spark, sf)).select("sample")


NAMES = "select c_custkey, case when c_custkey % 11 = 0 then null else c_name || case when c_custkey % 3 = 0 then '_x' else '' end end as sample from customer"


@query("select sample from (" + NAMES + ") where sample is null or not regexp_matches(sample, '^[a-zA-Z0-9_]+$')")
def invalid_samples(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 11 != 0, F.concat("c_name", F.when(k % 3 == 0, "_x").otherwise("")))
    return mf.invalid_samples(v.table(spark, sf, "customer").select(name.alias("sample")))


@query(v.with_views("""
select 'M' || (cast(lib as bigint) % 400) as sample, key, arg_max(value, cast(lib as bigint)) as value from (
  select lib, 'sample_genome' as key, genome as value from samples
  union all select lib, 'sample_input', input from samples
  union all select lib, 'sample_homer_fmg_genome', homer_fmg_genome from samples)
where value is not null group by 1, key""", "samples"))
def sample_attributes(spark, sf):
    """Samples are listed several times; the last row that fills a cell wins."""
    s = v.samples(spark, sf)
    ord_ = F.col("lib").cast("bigint")
    again = s.withColumn("sample", F.concat(F.lit("M"), (ord_ % 400).cast("string"))).withColumn("ord", ord_)
    return mf.sample_attributes(again, "ord").select("sample", "key", "value")


CAPTURE = """
select sample, path, regexp_extract(split_part(path, '/', -1), '^(.*_R([12])(?:[_.].*)?\\.fastq\\.gz)', 1) as whole,
  regexp_extract(split_part(path, '/', -1), '^.*_R([12])(?:[_.].*)?\\.fastq\\.gz', 1) as rd, split_part(path, '/', -1) as name from (
  select sample, path from files
  union all select sample, replace(path, '.fastq.gz', '_x.fastq.gz') from files where path like '%_R%'
  union all select sample, path || '.md5' from files where path like '%_R1%')"""


@query(v.with_views("""
select sample, path, case when whole = '' then 'no match' when whole <> name then 'skipped' else 'read' end as status,
  case when whole <> '' and whole = name then rd end as read from captured""", "files", captured=CAPTURE))
def capture_read(spark, sf):
    f = v.files(spark, sf)
    numbered = f.filter(F.col("path").contains("_R"))
    more = numbered.withColumn("path", F.replace("path", F.lit(".fastq.gz"), F.lit("_x.fastq.gz")))
    sums = f.filter(F.col("path").contains("_R1")).withColumn("path", F.concat("path", F.lit(".md5")))
    return mf.capture_read(f.unionByName(more).unionByName(sums), strict=False)


@query(v.with_views("""
select sample, regexp_extract(path, '_R([12])[_.]', 1) as read, string_agg(path, ',' order by path) as paths
from files where path like '%_R%' group by all""", "files"))
def reads_by_sample(spark, sf):
    f = v.files(spark, sf).filter(F.col("path").contains("_R"))
    return mf.reads_by_sample(mf.capture_read(f)).withColumn("paths", F.array_join("paths", ","))


@query(v.with_views("""
select sample, '1' as read, string_agg(path, ',' order by path) as paths from files group by sample""", "files"))
def no_capture(spark, sf):
    return mf.reads_by_sample(mf.no_capture(v.files(spark, sf))).withColumn("paths", F.array_join("paths", ","))


@query(v.with_views("select sample from samples where cast(lib as bigint) % 10 = 3", "samples"))
def missing_samples(spark, sf):
    found = v.files(spark, sf).filter(F.substring_index("sample", "N", -1).cast("bigint") % 10 != 3)
    return mf.missing_samples(v.samples(spark, sf), found)


@query(v.with_views("""
select path, regexp_replace(split_part(path, '/', -1), '_R?[12]_?[0-9]{0,3}\\.fastq\\.gz$', '') as stripped from (
  select path from files union all select path from run_files)""", "files", "run_files"))
def strip_suffix(spark, sf):
    from ..functions.names import base_name, strip_suffix as strip

    paths = v.files(spark, sf).select("path").unionByName(v.run_files(spark, sf))
    return paths.select("path", strip(base_name("path")).alias("stripped"))


@query(v.with_views("""
select BioSample as "group", coalesce(string_agg(name, ',' order by name), '') as files from runs
left join (select split_part(path, '/', -1) as name from run_files) f on regexp_replace(name, '_[12].fastq.gz', '') = Run
group by BioSample""", "runs", "run_files"))
def group_files(spark, sf):
    g = mf.group_files(v.run_files(spark, sf), v.runs(spark, sf))
    return g.withColumn("files", F.array_join("files", ","))


@query(v.with_views("select distinct BioSample as \"group\" from runs", "runs"))
def unique_groups(spark, sf):
    return mf.unique_groups(v.runs(spark, sf))


@query(v.with_views("""
select name as file, case when regexp_matches(name, '_[12]\\.fastq\\.gz') then regexp_replace(name, '_([12])\\.fastq\\.gz', '_R\\1.fastq.gz')
  else replace(name, '.fastq.gz', '_R1.fastq.gz') end as renamed, regexp_matches(name, '_R[12][_.].*fastq\\.gz') or regexp_matches(name, '_R[12]\\.fastq\\.gz') as warning
from (select split_part(path, '/', -1) as name from files union all select split_part(path, '/', -1) from run_files)""",
                    "files", "run_files"))
def add_read_number(spark, sf):
    from ..functions.names import base_name

    paths = v.files(spark, sf).select("path").unionByName(v.run_files(spark, sf))
    return mf.add_read_numbers(paths.select(base_name("path").alias("file")))


@query(v.with_views("""
select 'd/' || name as source, 'd/' || BioSample || '/' || replace(replace(name, '_1.f', '_R1.f'), '_2.f', '_R2.f') as destination
from runs join (select split_part(path, '/', -1) as name from run_files) f on regexp_replace(name, '_[12].fastq.gz', '') = Run""",
                    "runs", "run_files"))
def regroup_plan(spark, sf):
    return mf.regroup_plan(mf.group_files(v.run_files(spark, sf), v.runs(spark, sf)), "d", add_read=True)


@query("""
select 'f' || c_custkey as file, 'SRR' || c_custkey || '.5.' || (1 + c_custkey % 2) as name from customer where c_custkey % 3 = 0""")
def check_read_names(spark, sf):
    """The first record of each file; every third file has mate numbers on its names."""
    k = F.col("c_custkey")
    suffix = F.when(k % 3 == 0, F.concat(F.lit("."), (1 + k % 2).cast("string"))).otherwise("")
    reads = v.table(spark, sf, "customer").select(
        F.concat(F.lit("f"), k.cast("string")).alias("file"), F.explode(F.array(F.lit(0), F.lit(1))).alias("idx"),
        F.concat(F.lit("SRR"), k.cast("string"), F.lit(".5"), suffix, F.lit(" length=50")).alias("name"))
    return mf.check_read_names(reads)


@query(v.with_views("""
select 'runs' as listing, bool_or(regexp_matches(split_part(path, '/', -1), '^SRR[0-9]+_[0-9]\\.(fastq|fq)')) as sra from run_files
union all select 'files', bool_or(regexp_matches(split_part(path, '/', -1), '^SRR[0-9]+_[0-9]\\.(fastq|fq)')) from files""",
                    "files", "run_files"))
def looks_like_sra(spark, sf):
    a = mf.looks_like_sra(v.run_files(spark, sf)).select(F.lit("runs").alias("listing"), "sra")
    return a.unionByName(mf.looks_like_sra(v.files(spark, sf)).select(F.lit("files").alias("listing"), "sra"))


SETTINGS = {
    "blacklist": {g: f"ref/{g}-blacklist.bed.gz" for g in ("hg19", "hg38", "mm10")},
    "bwa_index": {g: f"ref/{g}.fa" for g in ("hg19", "hg38", "mm10")},
    "tss": {g: f"ref/{g}.tss.bed.gz" for g in ("hg19", "hg38", "mm10")},
    "motif": {"hg19r": "motif/hg19r"},
}


@query(v.with_views("""
select sample, genome, 'ref/' || genome || '-blacklist.bed.gz' as path from samples""", "samples"))
def resolve_reference(spark, sf):
    return mf.resolve_reference(v.samples(spark, sf), mf.reference_table(spark, SETTINGS), "blacklist")


@query(v.with_views("""
select sample, 'hg19r' as genome, 'motif/hg19r' as path from samples where homer_fmg_genome is not null""", "samples"))
def resolve_motif_genome(spark, sf):
    return mf.resolve_reference(v.samples(spark, sf), mf.reference_table(spark, SETTINGS), "motif", "homer_fmg_genome")


@query(v.with_views("""
select sample, genome, paramset from samples cross join (select unnest(['default_params', 'strict', 'wide']) as paramset)""", "samples"))
def expand_paramsets(spark, sf):
    return mf.expand(v.samples(spark, sf).select("sample", "genome"), ["default_params", "strict", "wide"])


@query(v.with_views("""
select sample, unnest(['tdf', 'bigwig']) as kind, null::varchar as paramset from samples
union all select sample, 'peaks', unnest(['a', 'b']) from samples where input is not null
union all select sample, 'motifs', unnest(['a', 'b']) from samples where homer_fmg_genome is not null""", "samples"))
def planned_outputs(spark, sf):
    return mf.planned_outputs(v.samples(spark, sf), ["a", "b"])


@query(v.with_views("""
select sample, kind, unnest(['a', 'b']) as paramset
from samples cross join (select unnest(['peaks', 'motifs']) as kind) where input is not null""", "samples"))
def planned_outputs_peaks_only(spark, sf):
    return mf.planned_outputs_peaks_only(v.samples(spark, sf), ["a", "b"])


@query(v.with_views("""
select a.sample, b.sample as control, a.genome, b.genome as control_genome from samples a join samples b on a.input = b.sample""", "samples"))
def pair_controls(spark, sf):
    return mf.pair_controls(v.samples(spark, sf))


@query(v.with_views("""
select a.sample, f.path from samples a join files f on f.sample = a.input""", "samples", "files"))
def label_controls(spark, sf):
    return mf.label_controls(v.files(spark, sf), mf.pair_controls(v.samples(spark, sf))).select("sample", "path")


@query(v.with_views("""
select file, replace(file, '.fq.gz', '.fastq.gz') as renamed, file like '%.gz' as gzipped from (
  select split_part(replace(path, '.fastq.gz', case when cast(substr(sample, 2) as bigint) % 3 = 0 then '.fq.gz'
    when cast(substr(sample, 2) as bigint) % 3 = 1 then '.fastq' else '.fastq.gz' end), '/', -1) as file from files)""", "files"))
def normalise_extensions(spark, sf):
    from ..functions.names import base_name

    n = F.substring_index("sample", "N", -1).cast("bigint") % 3
    tail = F.when(n == 0, ".fq.gz").when(n == 1, ".fastq").otherwise(".fastq.gz")
    renamed = F.replace("path", F.lit(".fastq.gz"), tail)
    return mf.normalise_extensions(v.files(spark, sf).select(base_name(renamed).alias("file")))
