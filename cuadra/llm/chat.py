"""Chat logs: only maximal conversations are kept and rendered.

A service logs a conversation again at every turn, so most logs are the beginning of longer ones. Each
turn is hashed with its position, role and text, and the running sum of these hashes names the prefix
that ends there. A conversation whose last name occurs as an inner name of another one is a prefix of
it and goes by an anti-join; of equal conversations the smallest id stays. The rest is rendered turn by
turn, with the place of each turn in the conversation's text, so a conversation of any length is never
put into one row.

Cases: turns are ordered by number, then role and text; gaps in the numbers do not matter and a turn
that is repeated counts twice. A null role is rendered as ``unknown`` and a null text as empty. Rows
without an id form one conversation. Marks of the format inside a text are broken by a space. Extra
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.operators.position import with_position, with_running_sums
from cuadra.session import broadcast_if_small, written_once

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_KEY = ["position", "name1", "name2"]


def rendered(role, text):
    """One turn in the chat format."""
    plain = lambda c: F.replace(F.replace(c, F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))
    return F.concat(F.lit(OPEN), plain(role), F.lit("\n"), plain(text), F.lit(CLOSE + "\n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, position, n_turns, role, text, segment, start, and the name of the prefix that ends there."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # The last key keeps equal turns of a long conversation apart, so that they can be spread.
    placed = with_position(rows.withColumn("_tie", F.rand(5)), ["turn", "role", "text", "_tie"], ["conv_id"], "position", "n_turns")
    wide = lambda *c: F.xxhash64(*c).cast("decimal(20,0)")
    hashed = placed.select(
        "conv_id", "position", "n_turns", rendered(F.col("role"), F.col("text")).alias("segment"),
        wide("position", "role", "text").alias("_h1"), wide(F.lit("second"), "text", "position", "role").alias("_h2"),
    ).withColumn("_chars", F.length("segment"))
    summed = with_running_sums(hashed, ["position"], {"name1": "_h1", "name2": "_h2", "_upto": "_chars"}, ["conv_id"])
    return summed.withColumn("start", F.col("_upto") - F.col("_chars")).drop("_h1", "_h2", "_upto", "_chars")


def maximal(named: DataFrame) -> DataFrame:
    """conv_id of the conversations to keep, with ``logs``, how many equal ones there are."""
    last = F.col("position") == F.col("n_turns") - 1
    inner = named.filter(~last).select(*_KEY).distinct()
    # Equal conversations are one row before the join.
    whole = named.filter(last).groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("logs"))
    return whole.join(inner, _KEY, "left_anti").select("conv_id", "logs")


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, position, n_turns, logs, start and rendered: the turns of the maximal conversations."""
    named = written_once(prefixes(turns))
    kept = broadcast_if_small(maximal(named).withColumnRenamed("conv_id", "_id"))
    rows = named.join(kept, F.col("conv_id").eqNullSafe(F.col("_id")))
    return rows.select("conv_id", "position", "n_turns", "logs", "start", F.col("segment").alias("rendered"))


OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS position,
         '<|im_start|>' || replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || chr(10)
         || replace(replace(text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || '<|im_end|>' || chr(10) AS rendered,
         md5(role || chr(0) || text) AS h
  FROM rows
), logged AS (
  SELECT conv_id, count(*) AS n_turns, list(h ORDER BY position) AS hs FROM placed GROUP BY conv_id
), inner_ones AS (
  SELECT DISTINCT array_to_string(hs[1:k], ',') AS p FROM logged, unnest(range(1, n_turns)) AS u(k)
), kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS logs FROM logged
  WHERE array_to_string(hs, ',') NOT IN (SELECT p FROM inner_ones) GROUP BY hs, n_turns
)
SELECT conv_id, position, n_turns, logs, rendered,
       CAST(sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY position) - length(rendered) AS BIGINT) AS start
FROM placed JOIN kept USING (conv_id)
"""


@query("op7_chat_collapse", OP7_SQL)
def op7_chat_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return collapse(table(spark, folder, "conversations"))
