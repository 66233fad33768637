"""Exact global ranks without a single-partition window.

``row_number() over (partition by label order by h)`` puts a whole class in one
task.  Instead, rows are ordered by a 60-bit hash key ``h`` whose top bits form
``2**bits`` buckets.  md5 is uniform, so every class is spread evenly over the
buckets however skewed the classes are.  Per-(class, bucket) counts form a small
table (``classes x 2**bits`` rows; bits grow with the counted rows), a running sum over it gives each bucket's
offset, and a window partitioned by (class, bucket) adds the local row number.
The result equals the global per-class rank ordered by (h, tie).

``first_in_order`` finds the one key of a given rank in each class from the same counts, so a
split compares each row with it and moves none.  ``running_sums`` orders any values, not
only hashes: range partitions, and one offset for each class and partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

HASH_HEX = 15          # 15 hex digits = 60 bits, fits a positive bigint
HASH_BITS = 4 * HASH_HEX
OFFSET_TABLE_LIMIT = 1_000_000   # rows of the offset table that may be broadcast
BUCKET_ROWS = 1_000_000          # rows of a (class, bucket) window; more buckets beyond it


def hash_key(key: str | Column, seed: int) -> Column:
    """Seeded 60-bit hash of a key: first 15 hex digits of md5(key || '|' || seed).
    A NULL key hashes as one NUL character, so its rows take part in ranks and splits."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.coalesce(k.cast("string"), F.lit("\0")), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, HASH_HEX), 16, 10).cast("bigint")


def _bucket_counts(hashed: DataFrame, by: Sequence[str], bits: int) -> tuple[DataFrame, int, int]:
    """Rows of each (by, bucket) as ``_cnt``, those of the buckets before as ``_offset``, those of
    the class as ``_gn``; how many such lines there are; and the bits of a bucket's number,
    raised until no bucket of a class is expected to hold over ``BUCKET_ROWS`` rows."""
    w = Window.partitionBy(*by).orderBy("_bucket")
    while True:
        work = hashed.withColumn("_bucket", F.shiftright(F.col("_h"), HASH_BITS - bits))
        counts = work.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
        # (#classes x 2**bits) lines, stored so that the size check and the joins share one pass
        offsets = materialize(counts.select(
            *by, "_bucket", "_cnt",
            (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_cnt")).alias("_offset"),
            F.sum("_cnt").over(Window.partitionBy(*by)).alias("_gn")))
        size = offsets.agg(F.count(F.lit(1)).alias("n"), F.max("_gn").alias("largest")).first()
        wanted = ((size["largest"] or 0) // BUCKET_ROWS).bit_length()   # bits that the largest class needs
        if wanted <= bits:
            return offsets, size["n"], bits
        bits = wanted


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality, so rows with a NULL class or hash keep their place."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys], F.lit(True))


def hashed_rank(df: DataFrame, by: Sequence[str], h: Column, tie: Column, *, bits: int = 10,
                rank_col: str = "_rank", size_col: str | None = "_group_n") -> DataFrame:
    """Append the 0-based rank of each row within ``by`` ordered by (h, tie), and
    optionally the group size."""
    by = list(by)
    hashed = df.withColumn("_h", h)
    offsets, n_off, bits = _bucket_counts(hashed, by, bits)
    work = hashed.withColumn("_bucket", F.shiftright(F.col("_h"), HASH_BITS - bits))
    offsets = F.broadcast(offsets) if n_off <= OFFSET_TABLE_LIMIT else offsets
    keys = [*by, "_bucket"]
    right = offsets.drop("_cnt").withColumnsRenamed({k: f"_o_{k}" for k in keys})
    joined = work.join(right, _same(keys, "_o_")).drop(*[f"_o_{k}" for k in keys])
    local = Window.partitionBy(*by, "_bucket").orderBy("_h", tie)
    out = joined.withColumn(rank_col, F.row_number().over(local) - 1 + F.col("_offset"))
    if size_col:
        out = out.withColumnRenamed("_gn", size_col)
    else:
        out = out.drop("_gn")
    return out.drop("_h", "_bucket", "_offset")


def first_in_order(df: DataFrame, by: Sequence[str], h: Column, tie: Column, share: float, col: str, *, bits: int = 10) -> DataFrame:
    """Append ``col``: 1 for the first ``round(share * n)`` rows of each class in the order of
    (h, tie), else 0.  The rows are compared with their class's cut and not exchanged; only
    those of one bucket a class are sorted.  Rows equal in h and tie share a side."""
    by = list(by)
    hashed = df.withColumn("_h", h).withColumn("_tie", tie)
    offsets, _, bits = _bucket_counts(hashed, by, bits)
    wanted = F.round(F.col("_gn") * F.lit(share)).cast("long")
    picked = offsets.withColumn("_want", wanted - F.col("_offset")).where("_want between 1 and _cnt").select(*by, "_bucket", "_want")
    picked = materialize(picked)  # one line a class
    hint = F.broadcast if picked.count() <= OFFSET_TABLE_LIMIT else lambda x: x
    keys = [*by, "_bucket"]
    inside = hashed.select(*by, "_h", "_tie", F.shiftright(F.col("_h"), HASH_BITS - bits).alias("_bucket"))
    inside = inside.join(hint(picked.withColumnsRenamed({k: f"_p_{k}" for k in keys})), _same(keys, "_p_")).drop(*[f"_p_{k}" for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_h", "_tie"))
    cuts = inside.withColumn("_place", place).where("_place = _want").select(*[F.col(b).alias(f"_c_{b}") for b in by], F.struct("_h", "_tie").alias("_cut"))
    out = hashed.join(hint(materialize(cuts)), _same(by, "_c_"), "left")
    before = F.coalesce(F.struct("_h", "_tie") <= F.col("_cut"), F.lit(False))
    return out.withColumn(col, before.cast("int")).drop("_h", "_tie", "_cut", *[f"_c_{b}" for b in by])


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: Column) -> DataFrame:
    """Append ``_before``, the sum of ``weight`` over the rows of the class that come before in
    ``order``, and ``_total``, the class's sum.  Rows are distinct in (by, order).

    Range partitions cut a class of any size into even parts; the sums of each class and
    partition are a small table, and the window inside runs over one part of one class."""
    by, order = list(by), list(order)
    cut = df.withColumn("_w", weight).repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    stored = materialize(cut)
    classes = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.sum("_s").over(classes.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = materialize(stored.groupBy(*by, "_part").agg(F.sum("_w").alias("_s")).select(
        *[F.col(b).alias(f"_s_{b}") for b in by], F.col("_part").alias("_s__part"), F.coalesce(before, F.lit(0)).alias("_base"), F.sum("_s").over(classes).alias("_total")))
    hint = F.broadcast if sums.count() <= OFFSET_TABLE_LIMIT else lambda x: x
    keys = [*by, "_part"]
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = stored.withColumn("_own", F.coalesce(F.sum("_w").over(local), F.lit(0)))
    out = own.join(hint(sums), _same(keys, "_s_")).withColumn("_before", F.col("_base") + F.col("_own"))
    return out.drop("_w", "_own", "_base", "_part", *[f"_s_{k}" for k in keys])
