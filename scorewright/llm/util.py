"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` stored with a unique number of each row, and that column's name."""
    name = "_row"
    while name in {c.lower() for c in df.columns}:
        name = "_" + name
    return materialize(df.withColumn(name, F.monotonically_increasing_id())), name


class BoundedCache(dict):
    """``key -> make(key)`` that holds at most ``2 * limit`` entries.

    Two generations: when the young one is full it becomes the old one, and keys
    that are used again move back.  Looked up as ``cache[key]``, so a hit costs one
    dictionary access.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self):
        """Call between rows (never while a lookup loop runs)."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and UTF-8 bytes of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes sum to at most ``limit`` (a longer row stands alone)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64 (wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FEW_ROWS = 65_536  # rows of a table that is broadcast once it is counted


def few(stored: DataFrame, limit: int = FEW_ROWS) -> DataFrame:
    """A stored table with a broadcast hint where its counted rows are few; else as it is."""
    return F.broadcast(stored) if stored.count() <= limit else stored


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` stored in the order of ``group``, then ``order``, with ``i``, a row's place in
    its group, and ``n``, the group's size.  Nulls come first; ``group`` has none.

    Range partitions cut a large group anywhere, also among equal rows, and a table of
    one row for each group and partition gives their first places."""
    cut = rows.withColumn("_tie", F.monotonically_increasing_id())
    cut = cut.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie").drop("_tie")
    stored = materialize(cut.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    counts = stored.groupBy(group, part).agg(F.count("*").alias("_c"), F.min("_at").alias("_first"))
    places = Window.partitionBy(group)
    before = F.sum("_c").over(places.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = materialize(counts.select(group, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                                       F.sum("_c").over(places).alias("n")))
    out = stored.withColumn("_part", part).join(few(counts), [group, "_part"])
    return out.withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


HOT = 4096  # keys of more than one row in so many are joined apart


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """Inner or left join with a stored ``table`` of one line a key, whose ``count`` says how many rows have it.

    At most ``HOT`` keys have over ``total / HOT`` rows; their lines are broadcast, so the
    rows of a hot key are not shuffled into one task.  ``keys`` are not null."""
    large = table.where(F.col(count) * HOT > total)
    return rows.join(F.broadcast(large), keys).unionByName(
        rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(table, keys, how))
