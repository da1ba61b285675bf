"""Writers. Files are split by sample and parameter set, which stand in their paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.genome import chromosome_ordinal


def _in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global order without a single task; rows that share a long prefix may still be split."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_intervals(df: DataFrame, path: str, keys: Sequence[str] = ("paramset", "sample"), mode: str = "error") -> None:
    """Headerless tab-separated text under key=value folders, in coordinate order."""
    order = [*keys, chromosome_ordinal("chrom"), "chrom", "s", "e"]
    _in_order(df, *order).write.mode(mode).partitionBy(*keys).option("sep", "\t").option("emptyValue", "").csv(path)


def write_track(df: DataFrame, path: str, text: bool = True, mode: str = "error") -> None:
    """(sample, chrom, s, e, value) as bedGraph text or Parquet per sample."""
    ordered = _in_order(df.select("sample", "chrom", "s", "e", "value"), "sample", chromosome_ordinal("chrom"), "chrom", "s")
    out = ordered.write.mode(mode).partitionBy("sample")
    out.option("sep", "\t").csv(path) if text else out.parquet(path)


def write_metrics(df: DataFrame, path: str, keys: Sequence[str] = ("paramset", "sample"), mode: str = "error") -> None:
    """Gzipped JSON per sample and parameter set."""
    df.write.mode(mode).partitionBy(*keys).option("compression", "gzip").json(path)


def write_summary(df: DataFrame, path: str, mode: str = "error") -> None:
    """The same metrics as text, one ``sample metric value`` per line."""
    line = F.concat_ws("\t", "sample", "metric", F.col("value").cast("string"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "error") -> None:
    """Tab-separated text with a header: duplicate metrics, unfiltered peak tables."""
    out = df.write.mode(mode).option("sep", "\t").option("header", True)
    (out.partitionBy(*keys) if keys else out).csv(path)


def write_fastq(df: DataFrame, path: str, mode: str = "error") -> None:
    """(file, idx, name, seq, qual) as gzipped text, one folder per file, records in order."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual")
    ordered = _in_order(df.select("file", "idx", record.alias("value")), "file", "idx").drop("idx")
    ordered.write.mode(mode).partitionBy("file").option("compression", "gzip").text(path)


def write_alignments(df: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet by sample and chromosome in coordinate order, so a region prunes folders and row groups."""
    order = ["sample", chromosome_ordinal("chrom"), "chrom", "s", "qname"]
    _in_order(df, *order).write.mode(mode).partitionBy("sample", "chrom").parquet(path)


def sam_lines(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(sample, value): SAM text of alignment records, 1-based, with all tags in order of their names; other columns on request."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("*")) if c in df.columns else F.lit("*")

    def one_based(c: str) -> Column:
        return F.coalesce((F.col(c) + 1).cast("string"), F.lit("0")) if c in df.columns else F.lit("0")

    number = F.coalesce(F.col("mapq"), F.lit(255)).cast("string") if "mapq" in df.columns else F.lit("255")
    tags = F.col("tags") if "tags" in df.columns else F.lit(None).cast("map<string,string>")
    kept = F.coalesce(tags, F.create_map().cast("map<string,string>"))
    if "x0" in df.columns:
        kept = F.when(F.col("x0").isNotNull(), F.map_concat(
            F.map_filter(kept, lambda k, _: k != "X0"), F.create_map(F.lit("X0"), F.col("x0").cast("string")))).otherwise(kept)
    if "x_fail" in df.columns:
        kept = F.when(F.col("x_fail").isNotNull(), F.map_concat(
            F.map_filter(kept, lambda k, _: k != "X?"), F.create_map(F.lit("X?"), F.col("x_fail")))).otherwise(kept)
    # the type letter is told from the value, as the map does not hold it
    fields = F.transform(F.array_sort(F.map_entries(kept)), lambda t: F.concat_ws(
        ":", t["key"], F.when(t["value"].rlike(r"^[-+]?\d+$"), "i").when(t["value"].rlike(r"^[-+]?\d*\.\d+([eE][-+]?\d+)?$"), "f")
        .otherwise("Z"), t["value"]))
    line = F.concat_ws(
        "\t", "qname", F.col("flag").cast("string"), text("chrom"), one_based("s"), number, text("cigar"),
        text("mate_chrom"), one_based("mate_s"), F.coalesce(F.col("tlen"), F.lit(0)).cast("string"),
        text("seq"), text("qual"), F.array_join(fields, "\t"),
    )
    line = F.regexp_replace(line, "\t$", "")
    return df.select("sample", line.alias("value"), *keep)


def sam_dictionary(df: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """(sample, chrom, place, length): the sequences of each sample in karyotype order, by their number from 0.

    ``lengths`` (chrom, length, and genome where both tables name it) lists them; without it
    those that alignments lie on count, as long as the last base covered.
    """
    if lengths is None:
        found = df.filter("chrom is not null").groupBy("sample", "chrom").agg(F.max("e").alias("length"))
    else:
        own = [c for c in ("genome",) if c in df.columns and c in lengths.columns]
        samples = df.select("sample", *own).distinct()
        listed = F.collect_list(F.struct("chrom", "length")).alias("listed")  # as many as sequences
        if own:
            found = samples.join(lengths.groupBy(*own).agg(listed), own).select("sample", F.inline("listed"))
        else:
            found = samples.withColumn("listed", lengths.agg(listed).scalar()).select("sample", F.inline("listed"))
    order = Window.partitionBy("sample").orderBy(chromosome_ordinal("chrom"), "chrom")  # as many rows as sequences
    return found.withColumn("place", F.row_number().over(order) - 1)


def sam_header(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(sample, line_no, text): version and order, the sequence dictionary, and the read groups that the tags name."""
    samples = df.select("sample").distinct()
    lines = samples.select("sample", F.lit(0).alias("part"), F.lit(0).alias("at"), F.lit("").alias("id"), F.lit("@HD\tVN:1.6\tSO:coordinate").alias("text"))
    names = F.concat(F.lit("@SQ\tSN:"), "chrom", F.lit("\tLN:"), F.col("length").cast("string"))
    lines = lines.unionByName(dictionary.select("sample", F.lit(1).alias("part"), F.col("place").alias("at"), F.lit("").alias("id"), names.alias("text")))
    if "tags" in df.columns:
        groups = df.select("sample", F.col("tags")["RG"].alias("id")).filter("id is not null").distinct()
        text = F.concat(F.lit("@RG\tID:"), "id", F.lit("\tSM:"), "sample")
        lines = lines.unionByName(groups.select("sample", F.lit(2).alias("part"), F.lit(0).alias("at"), "id", text.alias("text")))
    order = Window.partitionBy("sample").orderBy("part", "at", "id")  # as many rows as sequences and read groups
    return lines.select("sample", (F.row_number().over(order) - 1).cast("bigint").alias("line_no"), "text")


def write_sam(df: DataFrame, path: str, mode: str = "error", lengths: DataFrame | None = None) -> None:
    """SAM text per sample: header with the sequence dictionary, then records in the dictionary's order.

    Ends of the order: position, name, mate and flag; records without a place come last.
    ``df`` is read several times, so write from a stored table.
    """
    dictionary = sam_dictionary(df, lengths)
    place = dictionary.select("sample", "chrom", "place")
    ranked = df.join(place, ["sample", "chrom"], "left")
    last = (1 << 31) - 1
    keys = {"part": F.lit(1), "at": F.coalesce("place", F.lit(last)), "pos": F.coalesce("s", F.lit(0).cast("bigint")),
            "name": F.col("qname"), "second": F.col("mate").cast("int"), "bits": F.col("flag").cast("int")}
    body = sam_lines(ranked.withColumns({f"_{k}": c for k, c in keys.items()}), [f"_{k}" for k in keys])
    top = sam_header(df, dictionary).select(
        "sample", F.col("text").alias("value"), F.lit(0).alias("_part"), F.col("line_no").cast("int").alias("_at"),
        F.lit(0).cast("bigint").alias("_pos"), F.lit("").alias("_name"), F.lit(0).alias("_second"), F.lit(0).alias("_bits"))
    ordered = _in_order(body.unionByName(top), "sample", *[f"_{k}" for k in keys]).select("sample", "value")
    ordered.write.mode(mode).partitionBy("sample").text(path)


def write_peak_report(header: DataFrame, rows: DataFrame, path: str, mode: str = "error") -> None:
    """Peak reports, one folder per sample: header lines (sample, line_no, text), then rows in coordinate order."""
    body = F.concat_ws("\t", "id", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "strand",
                       F.col("score").cast("string"))
    lines = header.select("sample", F.lit(0).alias("part"), F.col("line_no").cast("bigint").alias("at"),
                          F.lit("").alias("chrom"), F.lit(0).cast("bigint").alias("start"), F.col("text").alias("value"))
    lines = lines.unionByName(rows.select(
        "sample", F.lit(1).alias("part"), chromosome_ordinal("chrom").cast("bigint").alias("at"), "chrom", "start",
        body.alias("value")))
    ordered = _in_order(lines, "sample", "part", "at", "chrom", "start").select("sample", "value")
    ordered.write.mode(mode).partitionBy("sample").text(path)
