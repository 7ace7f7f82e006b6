"""URL filters: sort-merge range join of urls and nested rules.

A rule is (host, path, verdict). It fits its host and all subdomains if the url's path starts with
the rule's path, and the longest fitting rule decides. Host labels are reversed (``org.example.``),
so "this host and its subdomains" is one interval of sorted keys, and so is "this path and what
follows it". Rules that fit one url are nested intervals. Urls and interval bounds are sorted
together over range partitions; every bound carries the stack of rules that are active behind it,
and an url takes the stack of the last bound before it.

Two sweeps are made: over hosts, which gives the rule hosts an url lies under, then over
(rule host, path), which gives the longest path rule of each of these hosts.

Cases: a null url or one without ``://`` has empty host and path and fits no rule. Repeated rows are
judged alike and all returned. Of two rules with the same host and path, ``block`` counts. Rules with
null host, path or verdict, or an empty host, fit nothing. No rules, or no urls: the result is the
default for each row. Columns other than ``page_id`` and ``url`` are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.session import written_once

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of an url; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    pattern = r"^([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(rest, pattern, 1)), F.regexp_extract(rest, pattern, 2)


def host_key(host: Column) -> Column:
    """Labels from the right, each closed by a dot: ``a.example.org`` becomes ``org.example.a.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(keys: DataFrame) -> DataFrame:
    """For each distinct ``key``, the keys that are prefixes of it, itself last, as ``stack``."""
    prefixes = keys.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("_n")).select(
        "key", F.expr("substring(key, 1, _n)").alias("_prefix")
    )
    active = prefixes.join(keys.select(F.col("key").alias("_prefix")), "_prefix")
    # Prefixes of one key sort by length.
    return active.groupBy("key").agg(F.sort_array(F.collect_list("_prefix")).alias("stack"))


def _bounds(keys: DataFrame) -> DataFrame:
    """Both ends of each rule's interval with the stack that holds behind that end."""
    stacks = _stacks(keys)
    # No UTF-8 text has the byte FF, so this lies behind every key that starts with ``key``.
    end = F.concat(F.col("key").cast("binary"), F.unhex(F.lit("FF")))
    opened = stacks.select(F.col("key").cast("binary").alias("_at"), F.lit(0).alias("_kind"), "stack")
    closed = stacks.select(
        end.alias("_at"), F.lit(2).alias("_kind"), F.expr("slice(stack, 1, size(stack) - 1)").alias("stack")
    )
    return opened.unionByName(closed)


def sweep(points: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Add ``stack``, the rule keys that are prefixes of ``key``, shortest first, and ``row``, a number.

    ``keys`` has the distinct rule keys in a column ``key``. Points and interval ends are sorted over
    range partitions, equal keys being told apart by a random number so that a hot key can be split.
    The stack at the end of a partition is handed to the next one: one row for each partition.
    """
    ends = _bounds(keys)
    rows = points.select(
        F.col(key).cast("binary").alias("_at"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_point")
    )
    merged = rows.unionByName(ends, allowMissingColumns=True).withColumn("_tie", F.xxhash64("_at", "_point"))
    order = ["_at", "_kind", "_tie"]
    # The range bounds come from a sample; the written copy fixes the partitions for both uses below.
    laid = written_once(
        merged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("row", 33))
    last = laid.filter("_kind != 1").groupBy("_part").agg(F.max_by("stack", "row").alias("_last"))
    # One row for each range partition.
    numbers = laid.select("_part").distinct().join(last, "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = laid.withColumn("_own", F.last("stack", ignorenulls=True).over(inside)).filter("_kind = 1")
    empty = F.array().cast("array<string>")
    return swept.join(F.broadcast(carried), "_part").select(
        "_point.*", F.coalesce("_own", "_carried", empty).alias("stack"), "row"
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (as ``host/path`` text, or null) and verdict of each row of ``pages``."""
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    known = (
        rules.select("host", "path", "verdict").dropna().filter("host != ''")
        .withColumn("host", ascii_lower(F.col("host")))
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' sorts behind 'allow'
        .withColumn("_host_key", host_key(F.col("host")))
    )
    hosts = known.select(F.col("_host_key").alias("key")).distinct()
    under = sweep(urls.withColumn("_key", host_key(F.col("host"))), hosts, "_key")
    # One row for each rule host above the url: as many as the rules are nested.
    split = under.select(
        F.col("row").alias("_row"), "page_id", "host", "path", F.explode_outer("stack").alias("_under")
    )
    # A zero byte parts host and path, so that no path can look like a longer host.
    join = lambda h, p: F.concat_ws("\x00", h, p)
    full = known.withColumn("key", join(F.col("_host_key"), F.col("path")))
    by_path = sweep(
        split.filter("_under is not null").withColumn("_key", join(F.col("_under"), F.col("path"))),
        full.select("key"), "_key",
    ).filter("size(stack) > 0")
    best = by_path.select("_row", F.try_element_at("stack", F.lit(-1)).alias("key"))
    named = best.join(full.select("key", F.concat("host", "path").alias("rule"), "verdict"), "key")
    chosen = named.groupBy("_row").agg(F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("_best"))
    return (
        under.join(chosen, under["row"] == chosen["_row"], "left")
        .select("page_id", "host", "path", F.col("_best.rule").alias("rule"),
                F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
    )


OP9_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host, coalesce(rest, '') AS rest FROM parts
), split AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path, row_number() OVER () AS r
  FROM urls
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (r)
"""


@query("op9_url_rules", OP9_SQL)
def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)
