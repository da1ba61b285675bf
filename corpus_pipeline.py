"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm.exact_dedup import keep_distinct
from strandlake.llm.mixing import mixed_documents
from strandlake.llm.ngram_jaccard import keep_one_of_each
from strandlake.llm.packing import pack_documents
from strandlake.llm.queries import table, vocabulary
from strandlake.llm.textkit import small_batches
from strandlake.llm.toxicity import drop_toxic
from strandlake.session import stage


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on their labels, does not call toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest, then first document of each group of equal texts."""
    small_batches(spark)
    return keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that links of similarity 0.8 hold together."""
    small_batches(spark)
    return keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: its place decides the file and the place in it."""
    small_batches(spark)
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and place. By sequence_id the sequences follow the mix."""
    small_batches(spark)
    return pack_documents(docs, vocabulary(), in_order=True)


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: classifier, tokenizer and best-fit are beyond SQL; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. Every stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
