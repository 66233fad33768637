"""Exact stratified hold-out, plain hold-out and stratified k-fold.

Rows are ordered by a seeded md5 hash of the key; within each class the first
``round(test_size * n_class)`` rows form the test part, and fold = rank mod k.
Class shares are therefore exact (within one row, and the rows that repeat the cut's
key), membership is a pure
function of (key, seed), and re-running after a lost executor gives the same
split.  ``DataFrame.sampleBy`` / ``randomSplit`` are only approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import first_in_order, hash_key, hashed_rank

SEED = 42


def stratified_split(df: DataFrame, label: str, key: str = "id", test_size: float = 0.2,
                     seed: int = SEED, col: str = "is_test") -> DataFrame:
    """Each row is compared with its class's cut key, so no row moves; rows that repeat a key
    share a side."""
    return first_in_order(df, [label], hash_key(key, seed), F.col(key), test_size, col)


def random_split(df: DataFrame, key: str = "id", test_size: float = 0.2, seed: int = SEED,
                 col: str = "is_test") -> DataFrame:
    return first_in_order(df, [], hash_key(key, seed), F.col(key), test_size, col)


def stratified_kfold(df: DataFrame, label: str, key: str = "id", k: int = 5, seed: int = SEED,
                     col: str = "fold") -> DataFrame:
    r = hashed_rank(df, [label], hash_key(key, seed), F.col(key), size_col=None)
    return r.withColumn(col, (F.col("_rank") % k).cast("int")).drop("_rank")


def train_test(df: DataFrame, label: str, key: str = "id", test_size: float = 0.2, seed: int = SEED):
    s = stratified_split(df, label, key, test_size, seed)
    return s.where(F.col("is_test") == 0).drop("is_test"), s.where(F.col("is_test") == 1).drop("is_test")
