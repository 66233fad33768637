"""Profiling aggregates (shape, class balance, nulls, describe, correlation,
hypothesis rates, box statistics, histogram, top-k, quantiles, agreement).

Every operator is one or two aggregate jobs with map-side partial aggregation;
results are tiny frames (one row per column / bin / class), so transposition
(``explode`` of an array of structs) runs on a single aggregated row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nullsafe import flag, safe_div
from ..functions.quantiles import exact_quantiles
from ..functions.ranks import running_sums

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def prefixed_columns(df: DataFrame, prefixes: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes)) and c not in exclude]


def _explode_structs(df_one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return df_one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# Q1
def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


# Q2
def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # window over the aggregated frame: one row per class
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


# Q3
def null_profile(df: DataFrame, top: int | None = 10, only_positive: bool = True) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    out = _explode_structs(row, [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                 for c in df.columns])
    if only_positive:
        out = out.where(F.col("n_null") > 0)
    out = out.orderBy(F.desc("n_null"), F.asc("column_name"))
    return out.limit(top) if top else out


# Q4
def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    qs = exact_quantiles(df, {f"{c}|{p}": (c, p) for c in cols for p in (0.25, 0.5, 0.75)})
    row = df.agg(*[F.struct(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in cols])
    structs = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"`{c}`.count").alias("count"),
        F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.std").alias("std"),
        F.col(f"`{c}`.min").alias("min"),
        F.lit(qs[f"{c}|0.25"]).cast("double").alias("q25"),
        F.lit(qs[f"{c}|0.5"]).cast("double").alias("q50"),
        F.lit(qs[f"{c}|0.75"]).cast("double").alias("q75"),
        F.col(f"`{c}`.max").alias("max")) for c in cols]
    return _explode_structs(row, structs)


# Q5
def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise-complete (rows where
    either side is NULL are skipped, as pandas does).

    One ``corr`` aggregate per pair does not scale with width: k columns give
    k(k+1)/2 six-slot aggregation buffers in one operator, which Catalyst takes
    minutes to plan at k = 32.  The co-moments are instead four mask-weighted Gram
    matrices: each partition multiplies its Arrow batches (numpy) into one partial
    row per pair, and a narrow ``groupBy(i, j)`` sums the partials (map-side
    combine).  Values are shifted by the column means first, which keeps the
    sums well conditioned.
    """
    cols = list(cols)
    k = len(cols)
    means_row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = [means_row[f"m{i}"] or 0.0 for i in range(k)]
    proj = df.select(*[(F.col(c).cast("double") - F.lit(means[i])).alias(f"x{i}") for i, c in enumerate(cols)])

    def partial(batches):
        import numpy as np
        import pandas as pd
        n = sx = sxx = sxy = None
        for b in batches:
            x = b.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")
            x0 = np.nan_to_num(x)
            if n is None:
                n, sx, sxx, sxy = m.T @ m, x0.T @ m, (x0 * x0).T @ m, x0.T @ x0
            else:
                n += m.T @ m
                sx += x0.T @ m
                sxx += (x0 * x0).T @ m
                sxy += x0.T @ x0
        if n is None:
            return
        ii, jj = np.triu_indices(k)
        yield pd.DataFrame({"i": ii.astype("int32"), "j": jj.astype("int32"), "n": n[ii, jj],
                            "sa": sx[ii, jj], "sb": sx[jj, ii], "saa": sxx[ii, jj], "sbb": sxx[jj, ii],
                            "sab": sxy[ii, jj]})

    schema = "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double"
    sums = proj.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    cov = F.col("sab") - sa * sb / n
    va = F.col("saa") - sa * sa / n
    vb = F.col("sbb") - sb * sb / n
    corr = F.when((n > 1) & (va > 0) & (vb > 0), cov / F.sqrt(va * vb))
    names = F.array(*[F.lit(c) for c in cols])
    pairs = sums.select(F.col("i"), F.col("j"), corr.alias("corr"))
    upper = pairs.select(names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"), "corr")
    lower = pairs.where(F.col("i") != F.col("j")).select(
        names[F.col("j")].alias("column_a"), names[F.col("i")].alias("column_b"), "corr")
    return upper.unionByName(lower)


# Q6
def corr_pairs_above(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Pairs i < j (column order) with corr > threshold (signed, as the reference)."""
    pos = {c: i for i, c in enumerate(cols)}
    long = corr_long(df, cols)
    order = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(pos[c]))])
    return long.where((order[F.col("column_a")] < order[F.col("column_b")])
                      & (F.col("corr") > F.lit(threshold)))


# Q7
def median_ratio(df: DataFrame, label: str, value: str) -> DataFrame:
    """Median of ``value`` among positives and negatives, and their ratio.

    One exact-quantile pass: ``when(label = k, value)`` makes each class its own
    column, so no per-class group holds a value map."""
    q = exact_quantiles(df, {
        "median_positive": (F.when(F.col(label) == 1, F.col(value)), 0.5),
        "median_negative": (F.when(F.col(label) == 0, F.col(value)), 0.5)})
    spark = df.sparkSession
    one = spark.createDataFrame([(q["median_positive"], q["median_negative"])],
                                "median_positive double, median_negative double")
    return one.withColumn("ratio", safe_div(F.col("median_positive"), F.col("median_negative")))


# Q8 / Q9
def rate_by_flag(df: DataFrame, label: str, cond: Column, name: str) -> DataFrame:
    """Success rate inside / outside a boolean group (NULL condition counts as False)."""
    return (df.groupBy(flag(cond).alias(name))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label)).alias("success_rate")))


# Q10
CLASSES = 64  # of a label that a box plot tells apart


def boxplot_stats(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts of each feature by class; the classes are
    the label's values in the data (rows without one are left out)."""
    found = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().limit(CLASSES + 1).collect())
    if len(found) > CLASSES:
        raise ValueError(f"{label} has over {CLASSES} values; it is no class")
    specs = {f"{f}|{i}|{p}": (F.when(F.col(label) == F.lit(k), F.col(f)), p)
             for f in features for i, k in enumerate(found) for p in (0.25, 0.5, 0.75)}
    q = exact_quantiles(df, specs)

    def by_class(value) -> Column:
        """``value(class number)`` of a row's class."""
        out = F.lit(None).cast("double")
        for i, k in enumerate(found):
            out = F.when(F.col("label") == F.lit(k), F.lit(value(i)).cast("double")).otherwise(out)
        return out

    fence = lambda f, sign: lambda i: None if q[f"{f}|{i}|0.25"] is None else (
        q[f"{f}|{i}|{0.5 + 0.25 * sign}"] + sign * 1.5 * (q[f"{f}|{i}|0.75"] - q[f"{f}|{i}|0.25"]))
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), *[F.col(f).cast("double").alias(f"x{j}") for j, f in enumerate(features)])
    aggs = []
    for j, f in enumerate(features):
        x, low, high = F.col(f"x{j}"), by_class(fence(f, -1)), by_class(fence(f, 1))
        aggs.append(F.struct(F.min(F.when(x >= low, x)).alias("whisker_low"), F.max(F.when(x <= high, x)).alias("whisker_high"),
                             F.count_if((x < low) | (x > high)).alias("n_outliers"), F.count(x).alias("n")).alias(f"s{j}"))
    structs = []
    for j, f in enumerate(features):
        q1, q2, q3 = (by_class(lambda i, p=p: q[f"{f}|{i}|{p}"]) for p in (0.25, 0.5, 0.75))
        structs.append(F.struct(F.lit(f).alias("feature"), F.col("label"), F.col(f"s{j}.n").alias("n"), q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
                                (q3 - q1).alias("iqr"), *[F.col(f"s{j}.{c}").alias(c) for c in ("whisker_low", "whisker_high", "n_outliers")]))
    return rows.groupBy("label").agg(*aggs).select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# Q11
def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls in the last bin."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_low"), "n"))


# Q12
def category_topk(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


# Q13
def probability_summary(df: DataFrame, prob: str) -> DataFrame:
    return df.agg(F.avg(prob).alias("mean"), F.stddev_pop(prob).alias("std"),
                  F.min(prob).alias("min"), F.max(prob).alias("max"))


# Q14
def prediction_share(df: DataFrame, pred: str) -> DataFrame:
    return df.agg(F.sum(pred).cast("bigint").alias("n_positive"),
                  F.avg(pred).alias("share_positive"), F.count(F.lit(1)).alias("n"))


# Q16
def table_quantiles(df: DataFrame, specs: Mapping[str, tuple[str, float]]) -> DataFrame:
    q = exact_quantiles(df, specs)
    rows = [(name, c if isinstance(c, str) else str(c), float(p), q[name]) for name, (c, p) in specs.items()]
    return df.sparkSession.createDataFrame(
        rows, "statistic string, column_name string, p double, value double")


# Q17
def agreement(df: DataFrame, preds: Sequence[str]) -> DataFrame:
    """Pairwise share of rows on which two prediction columns agree (one pass)."""
    pairs = [(a, b) for i, a in enumerate(preds) for b in preds[i + 1:]]
    row = df.agg(*[F.avg((F.col(a) == F.col(b)).cast("int")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    return _explode_structs(row, [F.struct(F.lit(a).alias("prediction_a"), F.lit(b).alias("prediction_b"),
                                           F.col(f"`{i}`").alias("agreement"))
                                  for i, (a, b) in enumerate(pairs)])


# P11
def schema_report(df: DataFrame) -> DataFrame:
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return _explode_structs(row, [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"`{f.name}`").alias("non_null")) for i, f in enumerate(df.schema.fields)])


def grouped_quantile(df: DataFrame, group: str, value: str, p: float = 0.5, name: str = "q") -> DataFrame:
    """Exact quantile of each group, one row a group (NULL where it has no value).

    The distinct values of all groups are counted before the shuffle and ordered in range
    partitions (``running_sums``), which give each value its ranks in its group; the two
    values that hold the quantile's ranks are picked and interpolated.  No group is read back
    or lies in one task as a whole, however many groups or values there are."""
    x = F.col(value).cast("double")
    counted = df.select(F.col(group), F.when(~F.isnan(x), x).alias("_x")).groupBy(group, "_x").agg(F.count(F.lit(1)).alias("_n"))
    own = F.when(F.col("_x").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    ranked = running_sums(counted, [group], ["_x"], own)
    at = F.lit(float(p)) * (F.col("_total") - 1)
    holds = lambda rank: F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + own), F.col("_x")))
    two = ranked.groupBy(group).agg(holds(F.floor(at)).alias("_a"), holds(F.ceil(at)).alias("_b"), F.max(at).alias("_at"))
    low, high = F.floor("_at"), F.ceil("_at")
    mixed = (high - F.col("_at")) * F.col("_a") + (F.col("_at") - low) * F.col("_b")
    return two.select(group, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(mixed).alias(name))


