"""Fixity of web archives: hash trees over records, compared between replicas.

Records lie in archives at byte offsets. Each record has a SHA-256; records of one range of offsets are
hashed in order into a leaf, and ``FANOUT`` neighbours into a node above, up to one root per archive.
Replicas are compared from the root down: only children of nodes that differ are looked at, and only in
ranges that differ the records themselves, so an intact replica costs one comparison of roots.

Every group is bounded: a node has at most ``FANOUT`` children, a leaf the distinct offsets of its range.
An archive of any size is spread over its ranges.

Cases: null url or html counts as empty, so every row makes a record. Repeated rows are records of their
own. Rows of a replica that claim one offset together are one entry with a digest over all of them. An
archive or record that only one replica has is reported as missing or extra. Extra columns are ignored,
and empty tables have no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.operators.position import with_running_sums
from cuadra.session import broadcast_if_small, written_once

RANGE = 1 << 16  # bytes of an archive that one leaf covers
FANOUT = 16
ARCHIVE_PAGES = 1000


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as a WARC response record."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def archive_records(pages: DataFrame) -> DataFrame:
    """page_id, archive, offset, length, digest of the records, in the order of ``page_id``."""
    text = pages.select("page_id", F.coalesce(F.floor(F.col("page_id") / ARCHIVE_PAGES), F.lit(-1)).alias("archive"),
                        record(F.col("page_id"), F.col("url"), F.col("html")).alias("_record"))
    sized = text.select("page_id", "archive", F.octet_length("_record").cast("bigint").alias("length"), F.sha2("_record", 256).alias("digest"))
    placed = with_running_sums(sized, ["page_id", "digest"], {"_end": "length"}, ["archive"])
    return placed.select("page_id", "archive", (F.col("_end") - F.col("length")).alias("offset"), "length", "digest")


def _entries(records: DataFrame) -> DataFrame:
    """One entry for each (archive, offset); where several rows claim an offset, they are hashed together in order."""
    same = records.groupBy("archive", "offset").agg(
        F.min("digest").alias("digest"), F.max("digest").alias("_last"), F.min("length").alias("length"), F.max("length").alias("_long"),
        F.count(F.lit(1)).alias("_n"), F.sum(F.xxhash64("length", "digest").cast("decimal(20,0)")).alias("_sum"))
    several = F.sha2(F.concat_ws(",", "digest", "_last", "_long", "_n", F.col("_sum").cast("string")), 256)
    return same.select("archive", "offset", "length", F.when(F.col("_n") == 1, F.col("digest")).otherwise(several).alias("digest"))


def _hashed(children: DataFrame, order: str, value: Column) -> DataFrame:
    """One row per (archive, node): SHA-256 over the children's values in order."""
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_o"), value.alias("_v"))))
    return children.groupBy("archive", "node").agg(listed.alias("_c")).select(
        "archive", "node", F.sha2(F.array_join(F.col("_c._v"), "\n"), 256).alias("hash"))


def tree(entries: DataFrame, levels: int) -> list[DataFrame]:
    """The levels from the leaves to the roots, each (archive, node, hash)."""
    leaf = entries.withColumn("node", F.floor(F.col("offset") / RANGE))
    out = [written_once(_hashed(leaf, "offset", F.concat_ws(" ", "offset", "length", "digest")))]
    for _ in range(levels):
        below = out[-1].select("archive", F.col("node").alias("_child"), F.floor(F.col("node") / FANOUT).alias("node"), "hash")
        out.append(written_once(_hashed(below, "_child", F.concat_ws(" ", "_child", "hash"))))
    return out


def _unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    """(archive, node) at which the two sides differ or only one has anything."""
    other = b.select(F.col("archive").alias("_a"), F.col("node").alias("_n"), F.col("hash").alias("_h"))
    both = a.join(other, (F.col("archive") == F.col("_a")) & (F.col("node") == F.col("_n")), "full")
    return both.filter(~F.col("hash").eqNullSafe(F.col("_h"))).select(
        F.coalesce("archive", "_a").alias("archive"), F.coalesce("node", "_n").alias("node"))


def audit(records: DataFrame, replica: DataFrame) -> DataFrame:
    """archive, offset, length, expected, found and status of each entry that differs.

    Both sides have archive, offset, length and digest. ``status`` is changed, missing or extra.
    """
    one, two = written_once(_entries(records)), written_once(_entries(replica))
    top = one.select("offset").unionByName(two.select("offset")).agg(F.max("offset")).first()[0]
    if top is None:
        levels = 0
    else:
        levels, nodes = 0, top // RANGE + 1
        while nodes > 1:
            levels, nodes = levels + 1, -(-nodes // FANOUT)
    left, right = tree(one, levels), tree(two, levels)
    wrong = written_once(_unequal(left[-1], right[-1]))
    for a, b in zip(left[-2::-1], right[-2::-1]):
        above = broadcast_if_small(wrong.select("archive", F.col("node").alias("_up")))
        inside = [x.withColumn("_up", F.floor(F.col("node") / FANOUT)).join(above, ["archive", "_up"], "left_semi") for x in (a, b)]
        wrong = written_once(_unequal(*inside))
    ranges = broadcast_if_small(wrong)
    near = [x.withColumn("node", F.floor(F.col("offset") / RANGE)).join(ranges, ["archive", "node"], "left_semi") for x in (one, two)]
    other = near[1].select(F.col("archive").alias("_a"), F.col("offset").alias("_o"), F.col("length").alias("_l"), F.col("digest").alias("found"))
    both = near[0].join(other, (F.col("archive") == F.col("_a")) & (F.col("offset") == F.col("_o")), "full")
    same = F.col("digest").eqNullSafe(F.col("found")) & F.col("length").eqNullSafe(F.col("_l"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return both.filter(~same).select(
        F.coalesce("archive", "_a").alias("archive"), F.coalesce("offset", "_o").alias("offset"), F.coalesce("length", "_l").alias("length"),
        F.col("digest").alias("expected"), "found", status.alias("status"))


OP8_SQL = r"""
WITH body AS (
  SELECT page_id, coalesce(page_id // 1000, -1) AS archive, coalesce(html, '') AS html,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(CAST(page_id AS VARCHAR), 'none') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
         || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS tail
  FROM pages
), records AS (
  SELECT page_id, archive, strlen(head || html || tail) AS length, sha256(head || html || tail) AS digest,
         sha256(head || chr(88) || substr(html, 2) || tail) AS flipped
  FROM body
), placed AS (
  SELECT *, CAST(sum(length) OVER (PARTITION BY archive ORDER BY page_id, digest) - length AS BIGINT) AS "offset" FROM records
)
SELECT archive, "offset", length, digest AS expected,
       CASE WHEN page_id % 211 = 7 THEN NULL ELSE flipped END AS found,
       CASE WHEN page_id % 211 = 7 THEN 'missing' ELSE 'changed' END AS status
FROM placed WHERE page_id % 211 = 7 OR page_id % 101 = 5
"""


@query("op8_warc_fixity", OP8_SQL)
def op8_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of ``pages`` against a replica in which some pages begin with another byte and some are lost."""
    pages = table(spark, folder, "pages")
    good = written_once(archive_records(pages))
    bad = F.concat(F.lit("X"), F.expr("substring(html, 2)"))
    flipped = pages.filter(F.col("page_id") % 101 == 5).select(
        F.col("page_id").alias("_p"), F.sha2(record(F.col("page_id"), F.col("url"), bad), 256).alias("_d"))
    replica = good.filter("page_id % 211 != 7").join(flipped, F.col("page_id") == F.col("_p"), "left").select(
        "archive", "offset", "length", F.coalesce("_d", "digest").alias("digest"))
    return audit(good, replica)
