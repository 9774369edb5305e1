"""Bloom filters as columns: bits in an array of longs, tested inside a projection or filter.

The array is a scalar of fixed width (``BITS``, 128 KB in each task, if nothing else is said), built by a partial aggregate.  A fuller filter lets
more rows through, it never keeps one out, so what it saves depends on the data and what it answers does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20


def _places(value: Column, hashes: int, width: int) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(width)) for i in range(hashes)]


def bloom(rows: DataFrame, value: str, hashes: int = 3, width: int = BITS) -> Column:
    """Bits of all values of a column, ``width`` of them, as a scalar; null values are hashed as well."""
    place = F.explode(F.array(*_places(F.col(value), hashes, width))).alias("_place")
    words = rows.select(place).groupBy(F.shiftright("_place", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_place % 64 AS INT))")).alias("bits")
    )
    filled = rows.sparkSession.range(width // 64).join(words, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"])
    return filled.agg(listed.alias("bits")).scalar()


def might_hold(bits: Column, value: Column, hashes: int = 3, width: int = BITS) -> Column:
    """Whether a value can be one of those that ``bits``, of the same ``hashes`` and ``width``, were made of."""
    hit = F.lit(True)
    for place in _places(value, hashes, width):
        hit = hit & (F.getbit(F.get(bits, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1)
    return hit
