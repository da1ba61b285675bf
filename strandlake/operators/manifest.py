"""Samplesheets, run tables and file listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import names as N

# fixed values: columns every samplesheet has, and those that are not attributes
REQUIRED = ("lib", "sample", "basepath")
REQUIRED_PEAKS_ONLY = ("sample",)
RESERVED = ("lib", "sample", "basepath")


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def invalid_samples(df: DataFrame) -> DataFrame:
    """Names with anything but letters, digits and underscores; a blank name is invalid too."""
    return df.filter(~F.coalesce(F.col("sample").rlike(N.SAMPLE_REGEX), F.lit(False))).select("sample")


def sample_attributes(df: DataFrame, order: str | None = None) -> DataFrame:
    """Every further column in long form (sample, key, value), blanks left out.

    With ``order`` (a column that gives the order of rows), the last row of a sample
    that fills a cell wins.
    """
    extra = [c for c in df.columns if c not in RESERVED and c != order]
    ids = ["sample"] + ([order] if order else [])
    long = (
        df.select(*ids, *[F.col(c).cast("string").alias(c) for c in extra])
        .unpivot(ids, extra, "key", "value")
        .filter(F.col("value").isNotNull())
        .withColumn("key", F.concat(F.lit("sample_"), F.col("key")))
    )
    if not order:
        return long
    return long.groupBy("sample", "key").agg(F.max_by("value", order).alias("value"))


def capture_read(files: DataFrame, regex: str = N.CAPTURE_REGEX, strict: bool = True) -> DataFrame:
    """Adds ``read`` from the first group of a match at the start of the base name.

    A name that does not match is an error (at run time); a match that does not span
    the name drops the file without a word. ``strict=False`` keeps all rows, with the
    outcome in ``status``.
    """
    name = N.base_name("path")
    whole = F.regexp_extract(name, f"^(?:{regex})", 0)
    matched = name.rlike(f"^(?:{regex})")
    read = F.regexp_extract(name, f"^(?:{regex})", 1)
    if not strict:
        status = F.when(~matched, "no match").when(whole != name, "skipped").otherwise("read")
        return files.withColumn("status", status).withColumn("read", F.when(status == "read", read))
    failed = F.raise_error(F.concat(F.lit("file name does not match the capture pattern: "), name))
    return files.withColumn("read", F.when(~matched, failed.cast("string")).when(whole == name, read)).filter(
        "read is not null"
    )


def no_capture(files: DataFrame) -> DataFrame:
    return files.withColumn("read", F.lit("1"))


def reads_by_sample(files: DataFrame) -> DataFrame:
    """(sample, read, paths): the sorted files of each read number."""
    return files.groupBy("sample", "read").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def missing_samples(samples: DataFrame, files: DataFrame) -> DataFrame:
    """Samples whose folder holds no file."""
    return samples.select("sample").join(files.select("sample").distinct(), "sample", "left_anti")


def group_files(files: DataFrame, meta: DataFrame, indiv_col: str = "Run", group_col: str = "BioSample",
                strip_regex: str = N.STRIP_REGEX) -> DataFrame:
    """(group, files): sorted names of all runs of a group; a group without files has an empty list."""
    named = files.select(N.base_name("path").alias("file")).withColumn("id", N.strip_suffix("file", strip_regex))
    runs = meta.select(F.col(indiv_col).alias("id"), F.col(group_col).alias("grp"))
    return (
        runs.join(named, "id", "left")
        .groupBy(F.col("grp").alias("group"))
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
    )


def unique_groups(meta: DataFrame, group_col: str = "BioSample") -> DataFrame:
    return meta.select(F.col(group_col).alias("group")).distinct()


def add_read_numbers(files: DataFrame, name: str = "file") -> DataFrame:
    """Adds ``renamed``, and ``warning`` where the name already holds a read number."""
    return files.withColumn("renamed", N.add_read_number(name)).withColumn("warning", N.has_read_number(name))


def regroup_plan(groups: DataFrame, folder: str, add_read: bool = False) -> DataFrame:
    """(source, destination) of every file; the caller links or prints them."""
    each = groups.select("group", F.explode("files").alias("file"))
    target = N.add_read_number("file") if add_read else F.col("file")
    return each.select(
        F.concat_ws("/", F.lit(folder), "file").alias("source"),
        F.concat_ws("/", F.lit(folder), "group", target).alias("destination"),
    )


def check_read_names(reads: DataFrame) -> DataFrame:
    """Files whose first record is named with a .1 or .2 at the end, which parts the mates."""
    first = F.split(F.col("name"), " ")[0]
    return reads.filter((F.col("idx") == 0) & first.rlike(r"\.[12]$")).select("file", first.alias("name"))


def looks_like_sra(files: DataFrame) -> DataFrame:
    """One row: whether any base name looks like an archive accession with a read number."""
    hit = N.base_name("path").rlike(N.ARCHIVE_FILE)
    return files.agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("sra"))


def reference_table(spark: SparkSession, settings: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """(kind, genome, path) from settings such as {"blacklist": {"hg19": path}}."""
    rows = [(kind, g, path) for kind, by_genome in settings.items() for g, path in by_genome.items()]
    return spark.createDataFrame(rows, "kind string, genome string, path string")


def resolve_reference(samples: DataFrame, refs: DataFrame, kind: str, genome_col: str = "genome",
                      strict: bool = True) -> DataFrame:
    """(sample, genome, path) of one kind of reference file; a genome without one is an error."""
    known = refs.filter(F.col("kind") == kind).select("genome", "path")
    found = samples.select("sample", F.col(genome_col).alias("genome")).filter("genome is not null").join(known, "genome", "left")
    if strict:
        lost = F.raise_error(F.concat(F.lit(f"no {kind} for genome "), F.col("genome"))).cast("string")
        found = found.withColumn("path", F.when(F.col("path").isNull(), lost).otherwise(F.col("path")))
    return found.select("sample", "genome", "path")


def expand(samples: DataFrame, paramsets: Sequence[str]) -> DataFrame:
    """Every sample with every parameter set; the sets are literals, so there is no join."""
    return samples.select("*", F.explode(F.array(*[F.lit(p) for p in paramsets])).alias("paramset"))


def _outputs(kinds: Column) -> Column:
    return F.explode(kinds).alias("kind")


def planned_outputs(samples: DataFrame, paramsets: Sequence[str]) -> DataFrame:
    """(sample, kind, paramset): tracks for all, peaks with a control, motifs with a motif genome.

    Motifs are planned only if the sheet has controls at all, peaks only with a control.
    """
    has = samples.columns
    no_set = F.lit(None).cast("string").alias("paramset")
    plan = samples.select("sample", _outputs(F.array(F.lit("tdf"), F.lit("bigwig"))), no_set)
    if "input" in has:
        peaks = expand(samples.filter("input is not null").select("sample"), paramsets)
        plan = plan.unionByName(peaks.select("sample", F.lit("peaks").alias("kind"), "paramset"))
        if "homer_fmg_genome" in has:
            controls = samples.filter("input is not null").agg(F.count(F.lit(1))).scalar()
            wanted = samples.filter(F.col("homer_fmg_genome").isNotNull() & (controls > 0))
            motifs = expand(wanted.select("sample"), paramsets)
            plan = plan.unionByName(motifs.select("sample", F.lit("motifs").alias("kind"), "paramset"))
    return plan


def planned_outputs_peaks_only(samples: DataFrame, paramsets: Sequence[str]) -> DataFrame:
    """Peaks and motifs for every sample with a control; the sheet must name controls and motif genomes."""
    require_columns(samples, ["input", "homer_fmg_genome"])
    treated = expand(samples.filter("input is not null").select("sample"), paramsets)
    return treated.select("sample", _outputs(F.array(F.lit("peaks"), F.lit("motifs"))), "paramset")


def pair_controls(samples: DataFrame) -> DataFrame:
    """(sample, control, genome, control_genome); one control may serve many samples."""
    controls = samples.select(F.col("sample").alias("input"), F.col("genome").alias("control_genome"))
    return samples.select("sample", "genome", "input").join(controls, "input").select(
        "sample", F.col("input").alias("control"), "genome", "control_genome"
    )


def label_controls(data: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the controls under the name of each sample they serve."""
    return data.withColumnRenamed("sample", "control").join(pairs.select("sample", "control"), "control").drop("control")


def normalise_extensions(files: DataFrame, name: str = "file") -> DataFrame:
    """Adds ``renamed`` (.fq.gz -> .fastq.gz) and ``gzipped``."""
    return files.withColumn("renamed", N.normalise_extension(name)).withColumn("gzipped", F.col(name).endswith(".gz"))
