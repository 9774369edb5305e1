"""Business key to surrogate key (J1-J3, J6) and attribute lookups.

No lookup table gets a broadcast hint: its size grows with the data.  Spark
broadcasts it when its measured size is below the session limit, and otherwise
joins by shuffle.  For that case facts without a key (often most of them: each
authorship row names one of four roles) are spread over many partitions instead
of piling up in the partition of the null key.  A hot key that does exist is
split by adaptive skew-join, as the lookup side is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import INTEGRAL, as_column, identifier, identifier_of, match_name
from starloom.operators.dedup import one_per_key
from starloom.operators.shape import present


def _cleaned(df: DataFrame, key: Column | str, clean) -> Column:
    if clean is None:
        return as_column(key)
    # a column known by name is cleaned according to its type
    return identifier_of(df, key) if clean is identifier and isinstance(key, str) else clean(key)


def key_table(dim: DataFrame, key: Column | str, sk: str, clean=identifier) -> DataFrame:
    """Unique cleaned key with its largest surrogate key (the last one loaded)."""
    return (
        dim.filter(F.col(sk) > 0)
        .select(_cleaned(dim, key, clean).alias("_key"), F.col(sk).alias("_sk"))
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.max("_sk").alias("_sk"))
    )


def spread_join(left: DataFrame, right: DataFrame, given: Column) -> DataFrame:
    """Left join with ``right`` on its column ``_key``; rows without a key are spread.

    Rows whose key is null get a hash of the row as filler to join on; the extra
    condition keeps a filler from ever matching.  Whole numbers join as bigint,
    anything else as text.
    """
    keyed = left.withColumn("_given", given)
    bucket = F.xxhash64(*left.columns)
    if dict(keyed.dtypes)["_given"] in INTEGRAL and dict(right.dtypes)["_key"] in INTEGRAL:
        kind, filler = "bigint", bucket
    else:
        kind, filler = "string", F.concat(F.lit("\u0000"), bucket.cast("string"))
    keyed = keyed.withColumn("_lookup", F.coalesce(F.col("_given").cast(kind), filler))
    side = right.withColumn("_key", F.col("_key").cast(kind))
    joined = keyed.join(side, (F.col("_lookup") == F.col("_key")) & F.col("_given").isNotNull(), "left")
    return joined.drop("_given", "_lookup", "_key")


def attach_key(fact: DataFrame, keys: DataFrame, key: Column, target: str) -> DataFrame:
    """Surrogate key from a key table; a miss or a missing key gives 0."""
    kept = [c for c in fact.columns if c != target]
    return spread_join(fact, keys, key).select(*kept, F.coalesce(F.col("_sk"), F.lit(0)).alias(target))


def lookup_sk(
    fact: DataFrame, dim: DataFrame, fact_key: Column | str, dim_key: Column | str, sk: str,
    target: str | None = None, clean=identifier,
) -> DataFrame:
    """Surrogate key of a business key; the row count of the fact is kept."""
    key = _cleaned(fact, fact_key, clean)
    return attach_key(fact, key_table(dim, dim_key, sk, clean), key, target or sk)


def lookup_sk_fallback(
    fact: DataFrame, dim: DataFrame, fact_key: str | None, dim_keys: Sequence[str], sk: str,
    target: str | None = None, probe: DataFrame | None = None,
) -> DataFrame:
    """Try the lookup columns in order, use the first that hits at all; none gives 0.

    Which columns hit is one pass over the distinct keys, with a flag for each
    column; the fact is then joined once.  A single column needs no look.
    ``probe`` is a cheaper frame with the same keys to look at, such as the
    fact before earlier joins.
    """
    target = target or sk
    chosen = chosen_lookup(fact, dim, fact_key, dim_keys, sk, probe)
    return fact.withColumn(target, F.lit(0)) if chosen is None else attach_key(fact, chosen[1], chosen[0], target)


def chosen_lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str | None, dim_keys: Sequence[str], sk: str, probe: DataFrame | None = None,
) -> tuple[Column, DataFrame] | None:
    """Key of a fact row and key table of the first column of ``dim_keys`` that hits; see :func:`lookup_sk_fallback`."""
    if fact_key is None or fact_key not in fact.columns:
        return None
    key = identifier_of(fact, fact_key)
    candidates = present(dim, dim_keys)
    if not candidates:
        return None
    name = candidates[0] if len(candidates) == 1 else _first_hit(
        (fact if probe is None else probe).select(key.alias("_key")), dim, candidates, sk
    )
    return None if name is None else (key, key_table(dim, name, sk))


def _first_hit(keys: DataFrame, dim: DataFrame, candidates: Sequence[str], sk: str) -> str | None:
    """The first of ``candidates`` that holds any key of ``keys`` (``_key``)."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("rank"), identifier_of(dim, name).alias("_key")) for i, name in enumerate(candidates)
    ])
    searched = dim.filter(F.col(sk) > 0).select(F.explode(pairs).alias("_pair")).select("_pair.rank", "_pair._key")
    held = searched.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("rank").alias("rank"))
    best = keys.filter(F.col("_key").isNotNull()).distinct().join(held, "_key").agg(F.min("rank")).first()[0]
    return None if best is None else candidates[best]


def priority_key_table(dim: DataFrame, keys: Sequence[str], sk: str, clean) -> DataFrame:
    """Keys of several columns in one table; an earlier column wins, then the smaller key."""
    pairs = F.array(*[
        F.struct(F.lit(rank).alias("rank"), clean(name).alias("_key")) for rank, name in enumerate(keys)
    ])
    return (
        dim.filter(F.col(sk) > 0)
        .select(F.col(sk).alias("_sk"), F.explode(pairs).alias("_pair"))
        .select("_sk", "_pair.rank", "_pair._key")
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min(F.struct("rank", "_sk"))["_sk"].alias("_sk"))
    )


def lookup_sk_priority(
    fact: DataFrame, dim: DataFrame | None, fact_key: Column | str, dim_keys: Sequence[str], sk: str,
    target: str | None = None, status: str = "match_status",
) -> DataFrame:
    """One key searched in several columns, the first in priority wins, with match status."""
    target = target or sk
    found = present(dim, dim_keys) if dim is not None else []
    if not found:
        label = "DIM_ABSENT" if dim is None else "UNMATCHED"
        return fact.withColumns({target: F.lit(0), status: F.lit(label)})
    matched = attach_key(fact, priority_key_table(dim, found, sk, match_name), match_name(fact_key), target)
    return matched.withColumn(status, F.when(F.col(target) > 0, "MATCHED").otherwise("UNMATCHED"))


def enrich_unique(left: DataFrame, right: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Left join after the right side is cut to one row per key."""
    single = one_per_key(right.filter(F.col(key).isNotNull()), [key], order)
    return spread_join(left, single.withColumnRenamed(key, "_key"), F.col(key))


def enrich_by_name(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, order: Sequence[Column | str]
) -> DataFrame:
    """Left join on the normalised name; one right row per name, so no fan-out (Q24)."""
    named = right.withColumn("_key", match_name(right_name)).filter(F.col("_key").isNotNull())
    return spread_join(left, one_per_key(named, ["_key"], order), match_name(left_name))


def attach_bridge(fact: DataFrame, bridge: DataFrame, key: str, target: str) -> DataFrame:
    """Left join with the distinct pairs of a bridge; several pairs fan out, none gives 0.

    The unknown member (key 0), often a large part of a fact, has no pairs and
    is spread like a missing key.
    """
    pairs = bridge.filter(F.col(key) > 0).select(F.col(key).alias("_key"), F.col(target).alias("_sk")).distinct()
    return attach_key(fact, pairs, F.when(F.col(key) > 0, F.col(key)), target)


def backfill(df: DataFrame, table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of ``columns`` from a table that is unique per key."""
    side = table.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns]
    )
    joined = spread_join(df, side, F.col(key))
    filled = {
        c: F.coalesce(F.col(c), F.col(f"_{c}")) if c in df.columns else F.col(f"_{c}") for c in columns
    }
    return joined.withColumns(filled).drop(*[f"_{c}" for c in columns])
