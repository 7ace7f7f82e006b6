"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch is first reduced to one row per
digest, then compared with the index by a sort-merge anti-join that does not move the index, and what
is new is appended. A digest that is in the index already has its keeper; otherwise the longest
original text of the batch stays, then the smallest id. Adding a batch twice appends nothing.

Cases: null text counts as empty, and all texts without a visible character are equal. Null ids come
after all others. Repeated rows are members of their group like any other row. Extra columns are
ignored, an empty batch appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.llm.common import query, table, text_of, without
from cuadra.session import scratch_path, written_once

SPACES = r"[\x20\x09-\x0D]+"
_ENTRY = "digest binary, keep_id bigint, keep_chars int, group_size bigint"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without white space, as hex; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256)


class DigestIndex:
    """The digests of everything that was kept so far, in a folder that all executors can reach.

    ``buckets`` is fixed when the folder is first used; at 32 bytes a digest, 8192 buckets hold
    10^11 digests in files below 1 GB.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path = spark, path
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} ({_ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path.replace(chr(39), '')}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame) -> None:
        """Append the groups whose digest is new."""
        new = groups.hint("merge").join(self.table().select("digest"), "digest", "left_anti")
        new.select("digest", "keep_id", F.col("keep_chars").cast("int").alias("keep_chars"), "group_size").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forget the name; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, digest and number of code points of each row. The texts are read here and nowhere else."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(digest_of(F.col("text"))).alias("digest"),
        F.length(text_of()).alias("n_chars"),
    )


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest: who stays, and how many there are. Combined before the shuffle."""
    # The largest of (length, -id); a null id is smaller than any number.
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("minus_id")))
    return rows.groupBy("digest").agg(best.alias("_best"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", (-F.col("_best.minus_id")).alias("keep_id"), F.col("_best.n_chars").alias("keep_chars"), "group_size"
    )


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Judge a batch against the index and add it: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true for the one row that entered the index with this batch. The decision of a digest
    is joined to its rows by an ordinary shuffle join, whose hot partitions adaptive execution splits.
    """
    rows = written_once(digest_rows(docs))
    groups = written_once(groups_of(rows))
    earlier = written_once(groups.select("digest").hint("merge").join(index.table().select("digest"), "digest", "left_semi"))
    index.add(groups)
    owner = index.table().select("digest", "keep_id")
    decided = groups.select("digest", "group_size").hint("merge").join(owner, "digest").join(
        earlier.withColumn("_old", F.lit(True)), "digest", "left"
    )
    # Written, so that the join below shuffles both sides and can be split.
    decided = written_once(decided.select("digest", "keep_id", "group_size", F.coalesce("_old", F.lit(False)).alias("_old")))
    return rows.hint("merge").join(decided, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("_old")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    A row is told by (doc_id, digest). Where several rows share both, the longest original stays.
    """
    verdict = written_once(deduplicate(docs, index))
    names = docs.columns
    marked = docs.withColumn("_sha", digest_of(F.col("text")))
    keyed = verdict.withColumnRenamed("text_sha256", "_sha")
    left = without(marked, keyed.filter("not kept"), ("doc_id", "_sha"))
    again = written_once(keyed.filter("kept").groupBy("doc_id", "_sha").count().filter("count > 1"))
    if again.isEmpty():
        return left.select(*names)
    single = without(left, again, ("doc_id", "_sha"))
    same = left.join(again.select(F.col("doc_id").alias("_id"), F.col("_sha").alias("_s")),
                     F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_s")), "left_semi")
    order = Window.partitionBy("doc_id", "_sha").orderBy(F.length("text").desc(), F.xxhash64(*names))
    one = same.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return single.select(*names).unionByName(one.select(*names))


OP3_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), judged AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
  FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM judged
"""


@query("op3_exact_dedup", OP3_SQL)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = DigestIndex(spark, scratch_path(spark, "digests"))
    return deduplicate(table(spark, folder, "documents"), index)
