"""Bucketed key registry: several key lookups of one wide fact in one narrow join.

A chain of lookups beyond broadcast size moves the whole fact once for each key.  Here the fact is stored once with
a row number and only (row, name of the lookup, key) rows meet the keys, without the rows that have none.  Both sides
are written bucketed by the same column into as many buckets, so their join needs no exchange; the keys
found are brought together by row and meet the stored fact, which is bucketed by row as well.

A key with more than one ``HOT``-th of all (row, key) rows is dealt over parts, and its registry row is written once
for each part, so no bucket holds a hot key whole.  There are less than ``HOT`` such keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookup import attach_key
from starloom.session import ensure_checkpoint_dir, stored

HOT = 1024


def bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in ``buckets`` sorted buckets of ``column``, one file each, and read back."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    dealt = df.repartition(buckets, column)
    dealt.write.bucketBy(buckets, column).sortBy(column).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame as Spark's planner knows it; exact for stored tables that are read whole."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by its measured size."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return measured_bytes(df) <= limit


def lookup_many(fact: DataFrame, lookups: Mapping[str, tuple[Column, DataFrame]], buckets: int | None = None) -> DataFrame:
    """``fact`` with one surrogate key for each target: {target: (key of a fact row, key table (``_key``, ``_sk``))}.

    A missing key or a miss gives 0; keys meet as text.  While every key table is small, the lookups are broadcast
    joins in turn and nothing moves; otherwise they go through the registry.
    """
    if not lookups:
        return fact
    if all(small(keys) for _, keys in lookups.values()):
        for target, (key, keys) in lookups.items():
            fact = attach_key(fact, keys, key, target)
        return fact
    return _through_registry(fact, lookups, buckets)


def _through_registry(fact: DataFrame, lookups: Mapping[str, tuple[Column, DataFrame]], buckets: int | None) -> DataFrame:
    spark = fact.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row, names = "_row", list(lookups)
    kept = [c for c in fact.columns if c not in lookups]
    wanted = F.array(*[
        F.when(key.isNotNull(), F.concat(F.lit(f"{i}|"), key.cast("string"))) for i, (key, _) in enumerate(lookups.values())
    ])
    # numbered and stored once: a row keeps its number whatever is lost later
    numbered = bucketed(
        stored(fact.select(*kept, F.filter(wanted, lambda k: k.isNotNull()).alias("_wanted")).withColumn(row, F.monotonically_increasing_id())),
        row, buckets,
    )
    asked = numbered.select(row, F.explode("_wanted").alias("_key"))
    counts = asked.groupBy("_key").agg(F.count("*").alias("_rows"))
    hot = stored(
        counts.select("_key", F.ceil(F.col("_rows") * HOT / asked.agg(F.count("*")).scalar()).alias("_parts")).filter("_parts > 1")
    )
    keys = None
    for i, (_, table) in enumerate(lookups.values()):
        part = table.select(F.concat(F.lit(f"{i}|"), F.col("_key").cast("string")).alias("_key"), "_sk")
        keys = part if keys is None else keys.unionByName(part)
    place = F.concat("_key", F.lit("|"), F.col("_part").cast("string"))
    parts = F.coalesce("_parts", F.lit(1))
    # broadcast: less than HOT rows
    registry = bucketed(
        keys.join(F.broadcast(hot), "_key", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).select(place.alias("_place"), "_sk"),
        "_place", buckets,
    )
    dealt = bucketed(
        asked.join(F.broadcast(hot), "_key", "left")
        .withColumn("_part", F.pmod(F.xxhash64(row), parts)).select(place.alias("_place"), row), "_place", buckets,
    )
    found = dealt.join(registry, "_place").select(row, F.substring_index("_place", "|", 1).cast("int").alias("_name"), "_sk")
    by_row = found.groupBy(row).agg(*[F.max(F.when(F.col("_name") == i, F.col("_sk"))).alias(f"_sk{i}") for i in range(len(names))])
    joined = numbered.join(by_row, row, "left")
    return joined.select(*kept, *[F.coalesce(f"_sk{i}", F.lit(0)).alias(n) for i, n in enumerate(names)])
