"""Session settings that the plans of this package rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Adaptive execution decides broadcasts and splits skewed join partitions at run
# time, from measured sizes.  No size threshold is raised here: a dimension is
# broadcast only while Spark's own limit says it is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "starloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session,
    where driver and executors share one disk, may fall back to a new scratch
    folder, which goes away with the process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    context.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back.

    Unlike a checkpointed frame the written table has known sizes, so joins with
    it are planned from facts, and it is read by column.  A lost executor costs
    nothing, as the files are on shared storage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def loaded_bytes(table: DataFrame) -> int:
    """What the rows of a stored table take in memory, by their number, their types and the length of their texts.

    A file of repeated values can be a hundred times smaller than its rows, and the planner goes by files.  Without
    texts only file footers are read; the lengths are summed up in the tasks.
    """
    slot, entry, short = 8, 32, 20  # bytes of a column's slot in a row, of a row's place in a hash table, of a text by its type
    texts = [f"`{f.name}`" for f in table.schema.fields if isinstance(f.dataType, StringType)]
    beyond = [F.sum(F.greatest(F.octet_length(c) - short, F.lit(0))) for c in texts]
    rows, *longer = table.agg(F.count("*"), *beyond).first()
    return rows * (table._jdf.schema().defaultSize() + slot * len(table.columns) + entry) + sum(n or 0 for n in longer)


def by_loaded_size(table: DataFrame) -> DataFrame:
    """A stored table as the right side of a join: broadcast only if its rows, not just its files, are below Spark's limit."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return table.hint("merge") if loaded_bytes(table) > limit else table
