"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before it wrote and keeps its decisions; all but the last return the
columns of ``documents``.

Cases: rows with null, empty or very long texts pass all stages like others, unless a copy of them stays. Rows
without an id, or with an id that other rows have too, are judged by their own text: a clean row never goes because
of another one. Equal rows leave one. Extra columns are carried to the last stage, whatever their names; an
empty table gives no rows. Without usable labels nothing is called toxic, and null or empty benchmark items reject nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuadra.llm.common import prepared, table
from cuadra.llm.decontaminate import drop_contaminated_texts
from cuadra.llm.exact_dedup import DigestIndex, drop_copies
from cuadra.llm.ngram_join import drop_near_copies_rows
from cuadra.llm.packing import pack_documents
from cuadra.llm.toxicity import reject, train
from cuadra.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression model calls toxic go; it learns from the labelled ones among them."""
    prepared(spark)
    return reject(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space stays."""
    prepared(spark)
    return drop_copies(docs, DigestIndex(spark, scratch_path(spark, "digests")))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 75 % of common shingles, the document with the smallest id stays."""
    prepared(spark)
    return drop_near_copies_rows(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepared(spark)
    return drop_contaminated_texts(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place."""
    import public_tokenizers

    prepared(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_similar),
    ("decontaminate", drop_benchmark_passages),
    ("packing", pack),
]

# SQL has no model scoring and no best-fit packing; the tests check the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
