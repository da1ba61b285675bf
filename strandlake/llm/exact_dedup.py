"""Exact duplicates by content sort (operator 10), with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .textkit import whole_texts

#: fixed values: the characters [\x20\x09-\x0D], which do not count
BLANK = "\t\n\x0b\x0c\r "
#: characters of a content that splitters hold
BEGIN = 48
#: copies of one content that a task orders together: so many, or this part of all rows where that is more
ORDERED_COPIES = 256
ORDERED_PART = 1 << 16


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", copies: int = ORDERED_COPIES,
                part: int = ORDERED_PART) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without blanks. The longest original (code points)
    stays, of equally long ones the smallest id.

    The normalised texts are range-partitioned by their beginning and a hash of the whole
    (as many may begin alike), with splitters that Spark samples, and sorted on disk; equal
    contents are then neighbours, compared in full, and of each run the best row and the
    number of copies remain. This is the only shuffle of texts.

    A content with more than ``copies`` rows, or one in ``part`` of all rows where that is
    more, is sorted in shares of that size, dealt by id. Less than ``part`` contents can be
    that frequent; their table (12 bytes each) is staged, and by its measured size Spark
    sends it to the texts. The runs of the shares, told by their SHA-256, are put together
    after the sort. Only the digest of each content goes back to the documents; that join is on a skewed key
    and left to adaptive execution, which splits it.

    Null and blank texts are one group (empty content). Rows with a null id come last: they
    are dropped unless their group has no id at all; then keep_id is null and the longest
    ones are kept, which nothing tells apart. A row that repeats a kept id and text is
    kept as well. Empty table: no rows. Other columns of ``docs`` are not read.
    """
    norm = F.translate(F.coalesce(F.col("text"), F.lit("")), BLANK, "")
    # never null, and seen to be: else the join puts a filter on the digest below every read of the texts
    sha = F.coalesce(F.unhex(F.sha2("norm", 256)), F.lit(b""))
    rows = whole_texts(docs, id_col, text_col).select(
        "doc_id", norm.alias("norm"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("len"))
    marked = rows.withColumn("mark", F.xxhash64("norm"))
    share = max(copies, docs.count() // part)
    frequent = stage(
        marked.groupBy("mark").agg(F.count("*").alias("n")).filter(F.col("n") > share)
        .select("mark", F.ceil(F.col("n") / share).cast("int").alias("shares")), "frequent_contents")
    keyed = marked.join(frequent, "mark", "left").select(
        F.substring("norm", 1, BEGIN).alias("begin"), "mark",
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("shares")), F.lit(0)).cast("int").alias("share"), "norm",
        F.struct(F.col("doc_id").isNull().alias("no_id"), (-F.col("len")).alias("less"), "doc_id").alias("row"))
    content = ["begin", "mark", "share", "norm"]
    runs = (
        keyed.repartitionByRange("begin", "mark", "share").sortWithinPartitions(*content)
        .groupBy(*content).agg(F.min("row").alias("row"), F.count("*").alias("n"))
        .select("mark", sha.alias("sha"), "row", "n")
    )
    heads = (
        runs.groupBy("mark", "sha").agg(F.min("row").alias("row"), F.sum("n").alias("group_size"))
        .select("sha", F.col("row.doc_id").alias("keep_id"), (-F.col("row.less")).alias("keep_len"), "group_size")
    )
    return (
        rows.select("doc_id", "len", sha.alias("sha"))
        .join(heads, "sha")
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("len") == F.col("keep_len"))).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"))
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; a row that repeats an id and text stays once."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    norm = F.translate(F.coalesce(docs[text_col].cast("string"), F.lit("")), BLANK, "")
    same = docs[id_col].cast("long").eqNullSafe(kept["_id"]) & (F.sha2(norm, 256) == kept["_sha"])
    return docs.join(kept, same, "left_semi").dropDuplicates([id_col, text_col])
