"""Session defaults, and the one place that knows where intermediate data may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution re-plans from real sizes: it turns a join into a broadcast only when the
# measured side is small, merges small shuffle partitions and splits skewed ones. The last option
# lets it split a hot key even where a later join on the same key then needs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

DEFAULTS = {
    **ADAPTIVE,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "cuadra", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` keys use ``__`` in place of a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def adapt(spark: SparkSession) -> SparkSession:
    """Turn the adaptive options on in a session that was built elsewhere."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names. Only a local master, where
    every task runs on this machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        configured = tempfile.mkdtemp(prefix="cuadra-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and go on from the written copy.

    The copy cuts the lineage and outlives lost executors, and every later use sees the same rows
    and reads only the columns it needs. The folder may be emptied when the job is over.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A table whose files hold more than this is shuffled, not broadcast. Parquet packs tables of ids and
# counts two to five times, so what is sent stays far below the memory of one executor.
BROADCAST_BYTES = 8 << 20


def stored_bytes(written: DataFrame) -> int:
    """The size of the files behind a table that was just read from its folder."""
    return int(written._jdf.queryExecution().analyzed().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A summary table as the small side of a join, after its bytes have been measured.

    Adaptive execution learns a size only when both sides are already shuffled. Writing the summary
    first saves that shuffle of the large side. Beyond ``limit`` bytes of files the summary is
    returned without a hint and the join shuffles; the rows of the join are the same.
    """
    written = written_once(df)
    return F.broadcast(written) if stored_bytes(written) <= limit else written
