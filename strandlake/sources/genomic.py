"""FASTQ, SAM, BED-like and FASTA text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import arith as A
from ..functions.arith import idiv
from ..operators.reads import assemble_records
from ..session import stage
from .text import numbered_lines

# fixed values: column names and types of the formats
BED = "chrom string, s bigint, e bigint"
BED6 = BED + ", name string, score double, strand string"
NARROWPEAK = BED + ", name string, score bigint, strand string, signal double, pscore double, qscore double, offset bigint"
BEDGRAPH = BED + ", value double"


def read_fastq(spark: SparkSession, paths: str | Sequence[str], label: Column | None = None) -> DataFrame:
    """(file, idx, name, seq, qual); gzipped files are one task each, plain ones are split.

    ``label`` names the file from its ``path`` (default: the last part of it). Parts with
    the same name are one file, whose records are numbered on in order of the parts.
    """
    file = F.substring_index("path", "/", -1) if label is None else label
    return assemble_records(numbered_lines(spark, paths, file).withColumnRenamed("path", "file")).select(
        "file", "idx", "name", "seq", "qual"
    )


def reference_span(cigar: str | Column) -> Column:
    """Reference bases an alignment covers."""
    parts = F.regexp_extract_all(A.col(cigar), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, x: n + x.cast("bigint"))


def read_alignments(spark: SparkSession, path: str, sample: str | Column | None = None) -> DataFrame:
    """SAM text to alignment records, 0-based; a folder named sample=... gives the sample.

    A malformed record is kept with its fault in ``reject`` and null where it could
    not be read.
    """
    lines = spark.read.text(path).filter(~F.col("value").startswith("@"))
    if sample is not None:
        lines = lines.withColumn("sample", F.lit(sample) if isinstance(sample, str) else sample)
    f = F.split("value", "\t")
    extra = F.transform(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.split(t, ":", 3))
    entries = F.transform(
        F.filter(extra, lambda t: F.size(t) == 3), lambda t: F.struct(t[0].alias("key"), t[2].alias("value"))
    )
    # columns of their own, so that the fields and tags of a line are taken apart once
    raw = lines.select("sample", f.alias("f")).withColumns({"n_fields": F.size("f"), "entries": entries}).withColumn(
        "names", F.transform("entries", lambda t: t["key"]))

    def field(i: int) -> Column:
        text = F.get("f", F.lit(i))
        return F.when(text != "*", text)

    repeated = F.size(F.array_distinct("names")) < F.size("names")
    first = F.filter("entries", lambda t, i: F.array_position(F.col("names"), t["key"]) == i + 1)
    df = raw.select(
        "sample", "n_fields",
        field(0).alias("qname"),
        F.get("f", F.lit(1)).try_cast("int").alias("flag"),
        field(2).alias("chrom"),
        (F.get("f", F.lit(3)).try_cast("bigint") - 1).alias("s"),
        F.get("f", F.lit(4)).try_cast("int").alias("mapq"),
        field(5).alias("cigar"),
        F.when(field(6) == "=", field(2)).otherwise(field(6)).alias("mate_chrom"),
        (F.get("f", F.lit(7)).try_cast("bigint") - 1).alias("mate_s"),
        F.get("f", F.lit(8)).try_cast("bigint").alias("tlen"),
        field(9).alias("seq"),
        field(10).alias("qual"),
        F.map_from_entries(F.when(repeated, first).otherwise(F.col("entries"))).alias("tags"),
    )
    reject = (
        F.when(F.col("n_fields") < 11, "too few fields")
        .when(F.col("flag").isNull(), "bad flag")
        .when(F.col("s").isNull(), "bad position")
    )
    return df.select(
        "sample", "qname",
        F.when(A.has_any("flag", A.MATE_2), 2).otherwise(1).alias("mate"),
        "chrom", "s", (F.col("s") + F.coalesce(reference_span("cigar"), F.lit(0))).alias("e"),
        F.when(A.has_any("flag", A.REVERSE), "-").otherwise("+").alias("strand"),
        "flag", "mapq", "cigar", "mate_chrom", "mate_s", "tlen", "seq", "qual", "tags",
        F.col("tags")["X0"].try_cast("int").alias("x0"),
        reject.alias("reject"),
    )


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """Header lines of SAM text: sample, line_no (from 0), kind (HD, SQ, RG, PG, CO), fields (a map), text.

    A folder named sample=... gives the sample; its parts are one file.
    """
    sample = F.regexp_extract("path", r"/sample=([^/]+)/", 1)
    lines = numbered_lines(spark, path + "/*", sample).filter(F.col("value").startswith("@"))
    parts = F.filter(F.split("value", "\t"), lambda t: t.contains(":"))
    fields = F.transform(parts, lambda t: F.struct(F.substring_index(t, ":", 1).alias("key"), F.substr(t, F.instr(t, ":") + 1).alias("value")))
    kind = F.substring("value", 2, 2)
    free = F.create_map().cast("map<string,string>")  # a comment has no fields
    return lines.select(
        F.col("path").alias("sample"), "line_no", kind.alias("kind"),
        F.when(kind == "CO", free).otherwise(F.map_from_entries(fields)).alias("fields"), F.col("value").alias("text"))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headerless tab-separated text, plain or gzipped; folders of the form key=value add their keys."""
    return spark.read.option("sep", "\t").option("comment", "#").schema(schema).csv(path)


def read_bed(spark: SparkSession, path: str, columns: int = 3) -> DataFrame:
    """The first ``columns`` (3 to 6) of BED text."""
    return read_table(spark, path, ", ".join(BED6.split(", ")[:columns]))


def read_narrowpeak(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, NARROWPEAK)


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BEDGRAPH)


def read_hpeaks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(header, rows): (path, line_no, text) of the # lines, from 1, and the tab-separated rows."""
    lines = numbered_lines(spark, path)
    header = lines.filter(F.col("value").startswith("#")).select(
        "path", (F.col("line_no") + 1).alias("line_no"), F.col("value").alias("text")
    )
    f = F.split("value", "\t")
    text = spark.read.text(path).filter(~F.col("value").startswith("#"))
    keys = [c for c in text.columns if c != "value"]
    rows = text.select(
        *keys, F.get(f, F.lit(0)).alias("id"), F.get(f, F.lit(1)).alias("chrom"),
        F.get(f, F.lit(2)).try_cast("bigint").alias("start"), F.get(f, F.lit(3)).try_cast("bigint").alias("end"),
        F.get(f, F.lit(4)).alias("strand"), F.get(f, F.lit(5)).try_cast("double").alias("score"),
    )
    return header, rows


def read_sequences(spark: SparkSession, path: str, chunk: int = 1 << 16, overlap: int = 0) -> DataFrame:
    """FASTA to (chrom, off, seq): chunks of fixed size, each with the first ``overlap`` bases of the next.

    The text is read once and its lines are written as a table. Within a split, lines are numbered by the headers before them and
    get their place from a running length; the totals of these stretches (a row each) are
    then summed along the file, which gives each stretch its sequence and its begin. A chunk
    gathers its own bases and no more. Lines before the first header belong to nothing.
    """
    along = Window.partitionBy("path", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.col("value").startswith(">")
    lines = (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("row"))
        .select("path", "split", "row", F.when(head, F.regexp_extract("value", r"^>(\S+)", 1)).alias("name"),
                F.when(head, "").otherwise(F.trim("value")).alias("bases"))
        .withColumns({"stretch": F.count("name").over(along), "read": F.sum(F.length("bases")).over(along)})
    )
    lines = stage(lines, "fasta")
    stretches = lines.groupBy("path", "split", "stretch").agg(F.max("name").alias("name"), F.sum(F.length("bases")).alias("size"))
    on = Window.partitionBy("path").orderBy("split", "stretch")
    numbered = stretches.withColumn("number", F.count("name").over(on))
    sequence, inside = Window.partitionBy("path", "number"), Window.partitionBy("path", "split").orderBy("stretch")
    begins = numbered.select(
        "path", "split", "stretch", F.max("name").over(sequence).alias("chrom"),
        # where the stretch begins in its sequence, less what the split held before it
        (F.sum("size").over(sequence.orderBy("split", "stretch")) - F.sum("size").over(inside)).alias("shift"),
    ).filter("chrom is not null")
    placed = lines.join(begins, ["path", "split", "stretch"]).select(
        "chrom", "bases", (F.col("read") + F.col("shift")).alias("upto")).withColumn("at", F.col("upto") - F.length("bases"))
    first = F.greatest(idiv(F.col("at") - overlap, chunk), F.lit(0))
    parts = placed.filter("bases <> ''").select(
        "chrom", "at", "upto", "bases", F.explode(F.sequence(first, idiv(F.col("upto") - 1, chunk))).alias("piece")
    )
    lo = F.greatest(F.col("at"), F.col("piece") * chunk)
    hi = F.least(F.col("upto"), (F.col("piece") + 1) * chunk + overlap)
    cut = F.substring(F.col("bases"), (lo - F.col("at") + 1).cast("int"), (hi - lo).cast("int"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bases"]), "")
    return (
        parts.filter(hi > lo).select("chrom", "piece", F.struct(lo.alias("lo"), cut.alias("bases")).alias("x"))
        .groupBy("chrom", "piece").agg(text.alias("seq"))
        .select("chrom", (F.col("piece") * chunk).alias("off"), "seq")
    )
