"""Feature selection: ANOVA F (closed form), importance >= median, recursive
elimination (plain and cross-validated)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def anova_f(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """One-way ANOVA F statistic of each column against the class (``f_classif``).

    One aggregate: per class n, sum and sum of squares of every column (two rows
    for a binary label), then F = (SSB / (k - 1)) / (SSW / (n - k)) per column.
    Rows with NULL in a column are left out of that column's test."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}")]
    per_class = df.groupBy(label).agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        rows.append(F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"),
                             F.col(f"n{i}").cast("double").alias("n"), F.col(f"s{i}").alias("s"),
                             F.col(f"q{i}").alias("q")))
    long = per_class.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    g = long.groupBy("feature", "position").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"), F.count(F.lit(1)).alias("k"))
    ss_total = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    ssb = F.col("between") - F.col("s") * F.col("s") / F.col("n")
    ssw = ss_total - ssb
    f = F.when((F.col("k") > 1) & (ssw > 0), (ssb / (F.col("k") - 1)) / (ssw / (F.col("n") - F.col("k"))))
    return g.select("feature", "position", f.alias("f_stat"))


def select_k_best(df: DataFrame, label: str, cols: Sequence[str], k: int) -> DataFrame:
    """``SelectKBest(f_classif, k=min(k, ncol))``: rank by F (NULL last), ties by position."""
    f = anova_f(df, label, cols)
    # one row per feature: the ranking window runs over the (small) feature list
    w = Window.orderBy(F.desc_nulls_last("f_stat"), F.asc("position"))
    return f.withColumn("rank", F.row_number().over(w)).withColumn(
        "selected", F.col("rank") <= F.lit(min(k, len(cols))))


def keep_above_median(names: Sequence[str], importances: Sequence[float]) -> list[str]:
    """``SelectFromModel(threshold='median')``: importance >= median importance."""
    vals = sorted(importances)
    n = len(vals)
    med = (vals[(n - 1) // 2] + vals[n // 2]) / 2
    return [nm for nm, v in zip(names, importances) if v >= med]


def _step_size(step, n_features: int) -> int:
    """scikit-learn semantics: an int removes that many, a float in (0, 1) that
    share of the *initial* feature count (at least one)."""
    if isinstance(step, float) and 0 < step < 1:
        return max(1, int(step * n_features))
    return max(1, int(step))


def path_sizes(n_features: int, n_select: int, step=1) -> list[int]:
    """Feature counts of an elimination path, from all features down to ``n_select``."""
    drop, out = _step_size(step, n_features), [n_features]
    while out[-1] > n_select:
        out.append(max(n_select, out[-1] - drop))
    return out


def rfe_path(train: DataFrame, n_features: int, fit, sizes: Sequence[int], features: str = "features",
             on_model=None) -> list[int]:
    """Recursive elimination: fit, drop the least important down to the next of the
    falling ``sizes``, repeat.

    ``fit(df) -> model`` with ``importances(n)``; the vector is narrowed with
    ``VectorSlicer`` each round.  ``on_model(keep, model)`` sees every fitted
    size (RFECV scores them).  Returns the kept positions."""
    keep = list(range(n_features))
    data = materialize(train)
    while True:
        model = fit(slice_features(data, keep, features))
        if on_model:
            on_model(list(keep), model)
        target = max((size for size in sizes if size < len(keep)), default=None)
        if target is None:
            return keep
        imp = model.importances(len(keep))
        gone = set(sorted(range(len(keep)), key=lambda i: (imp[i], -i))[:len(keep) - target])
        keep = [p for i, p in enumerate(keep) if i not in gone]


def rfe(train: DataFrame, names: Sequence[str], fit, n_select: int, step=1,
        features: str = "features") -> list[int]:
    return rfe_path(train, len(names), fit, path_sizes(len(names), n_select, step), features)


def slice_features(df: DataFrame, keep: Sequence[int], features: str = "features") -> DataFrame:
    return VectorSlicer(inputCol=features, outputCol="_sel", indices=list(keep)).transform(df) \
        .drop(features).withColumnRenamed("_sel", features)
