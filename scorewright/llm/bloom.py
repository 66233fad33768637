"""Bloom filters made of DataFrame operations.

The bits are an ``array<bigint>`` that a scalar subquery brings to the expression
which tests them: nothing is joined and no Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 26     # 8 MB: the most that a test ships to a task
BITS_PER_KEY = 16
PROBES = 5


def bits_for(keys: int) -> int:
    """Bits for that many keys: a power of two from 64 to MAX_BITS."""
    n = 64
    while n < min(MAX_BITS, keys * BITS_PER_KEY):
        n *= 2
    return n


def _positions(key: Column, n_bits: int, seed: int) -> list[Column]:
    """PROBES bit positions."""
    return [F.xxhash64(key, F.lit(seed + i)).bitwiseAND(F.lit(n_bits - 1)) for i in range(PROBES)]


def build(keys: DataFrame, key: str, n_bits: int, seed: int = 0) -> Column:
    """The filter over column ``key`` as a scalar subquery of n_bits / 64 words."""
    spark = keys.sparkSession
    at = keys.select(F.explode(F.array(*_positions(F.col(key), n_bits, seed))).alias("p"))
    words = at.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, int(p & 63))").alias("v"))
    every = spark.range(0, n_bits // 64, 1, 1).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v"))
    packed = words.groupBy("w").agg(F.bit_or("v").alias("v")).unionByName(every).groupBy("w").agg(F.bit_or("v").alias("v"))
    return packed.agg(F.expr("transform(array_sort(collect_list(struct(w, v))), x -> x.v)").alias("bits")).scalar()


def test(bits: Column, key: Column, n_bits: int, seed: int = 0) -> Column:
    """True for every key of the filter, and for few others."""
    out = F.lit(True)
    for p in _positions(key, n_bits, seed):
        out = out & (F.getbit(F.get(bits, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out
