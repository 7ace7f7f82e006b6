"""Mixing sources to target weights.

The budget is a share of all words and is dealt to the sources by weight; a source that would have to be
repeated more than ``epochs`` times gets that much, and the rest goes to the others by weight. Where the
level lies at which this comes to rest follows from running sums over the sources in the order of
size / weight, so that even a table of very many sources is never in one task.

Each document gets a random key, the md5 of its id and text. Within each source the documents are
range-sorted by that key, so that a large source lies in many partitions, and distributed prefix sums tell
how many words stand before each document. A source is taken whole as often as it fits into its budget; the
last epoch takes the documents in the order of the keys and is cut at the exact budget, inside the document that
crosses it. So ``taken`` sums to the budget of each source, rounded down, and the same input gives the same mix.

Cases: null text has no words, and a document without words takes nothing. Null is a source of its own, behind all others. Null ids are
ids like others. Repeated rows are documents of their own; which of several equal ones the cut falls into cannot be
told from the rows. A source without words has the target 0. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.operators.position import with_position, with_running_sums
from cuadra.session import broadcast_if_small, written_once

WEIGHTS = (5, 2, 1)  # of the sources in the order of their names, over and over
SHARE = (3, 2)  # of all words, as a fraction
EPOCHS = 2


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (in words) and key of each document, written once: the only pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return written_once(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)).alias("key")))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target, and the whole words of the target as ``budget``.

    ``share`` over all words is at most ``epochs``, so that the budget can be spent.
    """
    if share[0] > share[1] * epochs:
        raise ValueError("the mix is larger than all sources repeated as often as allowed")
    whole = math.lcm(*weights)
    big = lambda c: c.cast("decimal(38,0)")
    # Null stands behind all names.
    sums = written_once(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_none", F.col("source").isNull().cast("int")))
    numbered = with_position(sums, ["_none", "source"], name="nth")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    # A source is full at the level cap / weight; the levels are compared in whole numbers.
    levels = numbered.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * epochs).withColumn(
        "_level", F.col("_cap") * F.expr(f"{whole} div _w"))
    run = with_running_sums(levels, ["_level", "nth"], {"_caps": "_cap", "_ws": "_w"}, totals={"_all_caps": "_cap", "_all_w": "_w"})
    # What all sources get at the level of this one, times its weight and ``epochs`` times the denominator of the share.
    budget = big(F.col("_all_caps")) * share[0]
    at_level = big(F.col("_caps")) * F.col("_w") + big(F.col("_cap")) * (F.col("_all_w") - F.col("_ws"))
    marked = written_once(run.withColumn("_full", at_level * (share[1] * epochs) <= budget * F.col("_w")))
    # Three numbers: the words of the full sources, the weights of the others, and the most that could be taken.
    full, open_weight, most = marked.agg(
        F.sum(F.when(F.col("_full"), big(F.col("_cap"))).otherwise(0)), F.sum(F.when(~F.col("_full"), F.col("_w")).otherwise(0)), F.max("_all_caps")).first()
    under = share[1] * epochs
    left = int(most or 0) * share[0] - int(full or 0) * under  # words left for the open sources, times ``under``
    parts = max(int(open_weight or 0), 1) * under
    target = F.col("_w").cast("double") * F.lit(float(left)) / F.lit(float(parts))
    words = F.expr(f"cast(_w as decimal(38,0)) * {left}BD div {parts}BD")
    return marked.select("source", "source_size", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(target).alias("target"),
                         F.when(F.col("_full"), F.col("_cap")).otherwise(words).alias("budget"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and epochs: how often the document is taken whole.

    The words beyond ``epochs`` times ``size`` are the first words of the document.
    """
    sizes = document_sizes(docs)
    targets = source_targets(sizes, weights, share, epochs)
    run = with_running_sums(sizes, ["key", "doc_id"], {"_run": "size"}, keys=["source"])
    named = broadcast_if_small(targets.withColumnRenamed("source", "_source"))
    joined = run.join(named, F.col("source").eqNullSafe(F.col("_source")))
    times = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    part = F.expr("least(greatest(_last - (_run - size), 0L), size)")
    return joined.withColumn("epochs", times).withColumn("_last", F.col("budget") - F.col("epochs") * F.col("source_size")).withColumn(
        "taken", F.col("epochs") * F.col("size") + part).select("doc_id", "source", "size", "source_size", "target", "taken", "epochs")


OP13_SQL = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint size,
         md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) key from documents),
s as (
  select source, sum(size)::bigint n, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end::bigint w
  from d group by 1),
-- The level at which one more source is full: all full ones at twice their size, the rest by weight.
l as (
  select *, sum(2 * n) over o full_words, sum(w) over () - sum(w) over o open_w, sum(n) over () total
  from s window o as (order by n * 10 // w, source nulls last rows unbounded preceding)),
m as (select *, (full_words::hugeint * w + 2 * n::hugeint * open_w) * 2 <= 3 * total::hugeint * w is_full from l),
r as (select 3 * max(total)::hugeint - 2 * coalesce(sum(2 * n) filter (is_full), 0)::hugeint left2, coalesce(sum(w) filter (not is_full), 0)::hugeint open from m),
t as (
  select source, n, case when is_full then 2.0::double * n else w::double * (2 * left2)::double / (4 * open)::double end target,
         case when is_full then 2 * n else (w * left2 // (2 * open)) end::bigint budget from m, r),
k as (
  select d.doc_id, d.size, t.n, t.target, t.budget, sum(d.size) over (partition by d.source order by d.key, d.doc_id rows unbounded preceding) run,
         case when t.n > 0 then t.budget // t.n else 0 end times
  from d join t on d.source is not distinct from t.source)
select doc_id, size, n source_size, target, (times * size + least(greatest(budget - times * n - (run - size), 0), size))::bigint taken from k
"""


@query("op13_mix", OP13_SQL)
def op13_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
