"""Fit / apply preparation operators (imputation, clipping, scaling, encoders,
class weights).

``fit_*`` runs on the training part only and returns small statistics (scalars
or a per-category frame); ``apply_*`` is a projection or a join, so the same fit
is applied to training, test and scoring data.  Semantics follow pandas /
scikit-learn where they differ from Spark's defaults: population std in the
standard scaler, linear-interpolated exact quantiles, smallest value among tied
modes, NULL kept by clipping and scaling, unknown category -> all-zero one-hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import clip
from ..functions.quantiles import exact_quantiles
from ..functions.ranks import running_sums
from ..session import materialize

BROADCAST_BYTES = 32 << 20  # of an encoder's values and codes


# T1 ------------------------------------------------------------------------
def fit_median(train: DataFrame, cols: Sequence[str], skip: Sequence[str] = ()) -> dict:
    return exact_quantiles(train, {c: (c, 0.5) for c in cols if c not in skip})


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``fillna({col: value})``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


# T2 ------------------------------------------------------------------------
def fit_mode(train: DataFrame, cols: Sequence[str], default="Unknown") -> dict:
    """Most frequent non-null value; ties go to the smallest value (pandas ``mode()[0]``).

    A ``groupBy(value)`` with map-side counting per column, then a top-1: no
    aggregation buffer holds all distinct values."""
    out = {}
    for c in cols:
        top = (train.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc(c)).limit(1).collect())
        out[c] = top[0][c] if top else default
    return out


# T4 / T5 -------------------------------------------------------------------
def fit_clip(train: DataFrame, cols: Sequence[str], lower: float = 0.25, upper: float = 0.75,
             preserve: Sequence[str] = ()) -> dict:
    specs = {}
    for c in cols:
        if c in preserve:
            continue
        specs[f"{c}|lo"] = (c, lower)
        specs[f"{c}|hi"] = (c, upper)
    q = exact_quantiles(train, specs)
    return {c: (q[f"{c}|lo"], q[f"{c}|hi"]) for c in cols if c not in preserve}


def apply_clip(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), F.lit(lo), F.lit(hi)) for c, (lo, hi) in bounds.items()
                           if lo is not None})


# T6 ------------------------------------------------------------------------
def fit_standard(train: DataFrame, cols: Sequence[str]) -> dict:
    row = train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    return {c: (row[c]["m"], row[c]["s"] if row[c]["s"] else 1.0) for c in cols}


def apply_standard(df: DataFrame, stats: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items() if m is not None})


# T7 ------------------------------------------------------------------------
def fit_robust(train: DataFrame, cols: Sequence[str]) -> dict:
    q = exact_quantiles(train, {f"{c}|{p}": (c, p) for c in cols for p in (0.25, 0.5, 0.75)})
    out = {}
    for c in cols:
        med, q1, q3 = q[f"{c}|0.5"], q[f"{c}|0.25"], q[f"{c}|0.75"]
        iqr = (q3 - q1) if q1 is not None else None
        out[c] = (med, iqr if iqr else 1.0)
    return out


apply_robust = apply_standard


# T8 ------------------------------------------------------------------------
def fit_categories(train: DataFrame, col: str) -> list:
    """Sorted vocabulary of a categorical column (like ``StringIndexer``, the
    vocabulary is assumed to fit on the driver; it does not grow with rows)."""
    return [r[col] for r in train.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def apply_one_hot(df: DataFrame, col: str, categories: Sequence, prefix: str | None = None) -> DataFrame:
    prefix = prefix or col
    return df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(col) == F.lit(v)), F.lit(False)).cast("int")
                           for v in categories})


# T9 / T10 / T11 ------------------------------------------------------------
def _as_label_string(col: str):
    # ``astype(str)`` turns a missing value into the string 'nan'
    return F.coalesce(F.col(col).cast("string"), F.lit("nan"))


def _sized(encoder: DataFrame) -> DataFrame:
    """An encoder's frame, stored and with a broadcast hint while its counted size is
    small, so the large side is not shuffled on a category that may be hot.  Beyond
    that it is joined by a shuffle, whose skewed keys adaptive execution splits."""
    encoder = materialize(encoder)
    size = encoder.agg(F.sum(F.coalesce(F.octet_length(F.col("value").cast("string")), F.lit(0)) + F.lit(16))).first()[0] or 0
    return F.broadcast(encoder) if size <= BROADCAST_BYTES else encoder


def fit_label_codes(train: DataFrame, col: str) -> DataFrame:
    """Per-category codes 0..n-1 in sorted order, as a frame (value, code): the place of each
    distinct value in range partitions, so no task ranks the whole vocabulary."""
    vocab = train.select(_as_label_string(col).alias("value")).distinct()
    return running_sums(vocab, [], ["value"], F.lit(1)).select("value", F.col("_before").cast("int").alias("code"))


def apply_label_codes(df: DataFrame, col: str, codes: DataFrame, unseen: str = "extra",
                      out: str | None = None) -> DataFrame:
    """``unseen='extra'``: unseen values get code = number of classes ('unknown'
    appended after the fitted classes).  ``unseen='null'`` leaves NULL."""
    out = out or f"{col}_code"
    keyed = df.withColumn("_lbl", _as_label_string(col))
    joined = keyed.join(_sized(codes).withColumnRenamed("value", "_lbl").withColumnRenamed("code", "_code"),
                        "_lbl", "left")
    code = F.col("_code")
    if unseen == "extra":
        n_classes = codes.select(F.count(F.lit(1))).scalar()
        code = F.coalesce(code, n_classes.cast("int"))
    return joined.withColumn(out, code).drop("_lbl", "_code")


# T12 -----------------------------------------------------------------------
def fit_target_encoding(train: DataFrame, col: str, label: str, *, method: str = "sigmoid",
                        smoothing: float = 1.0, min_samples_leaf: int = 1, m: float = 1.0) -> tuple[DataFrame, float]:
    """Smoothed per-category target mean.

    ``sigmoid`` (library default of the reference): w = 1/(1+exp(-(n-k)/s)),
    enc = prior*(1-w) + mean*w, and a category seen once gets the prior.
    ``m_estimate``: enc = (n*mean + m*prior)/(n+m).  Unseen -> prior.
    Returns (per-category frame [value, encoding], prior)."""
    prior = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    stats = train.groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("mean"))
    n, mean = F.col("n"), F.col("mean")
    if method == "sigmoid":
        w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(min_samples_leaf)) / F.lit(smoothing)))
        enc = F.when(n == 1, F.lit(prior)).otherwise(F.lit(prior) * (F.lit(1.0) - w) + mean * w)
    elif method == "m_estimate":
        enc = (n * mean + F.lit(m) * F.lit(prior)) / (n + F.lit(m))
    else:
        raise ValueError(method)
    return stats.select("value", enc.alias("encoding")), prior


def apply_target_encoding(df: DataFrame, col: str, enc: DataFrame, prior: float,
                          out: str | None = None) -> DataFrame:
    out = out or f"{col}_te"
    e = _sized(enc).withColumnRenamed("value", "_v").withColumnRenamed("encoding", "_e")
    return (df.join(e, df[col] == e["_v"], "left")
            .withColumn(out, F.coalesce(F.col("_e"), F.lit(prior))).drop("_v", "_e"))


# T15 / T16 -----------------------------------------------------------------
def class_weights(train: DataFrame, label: str) -> DataFrame:
    """``class_weight='balanced'``: n / (n_classes * n_c), one row per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = Window.partitionBy()
    return counts.select(label, (F.sum("n_c").over(tot) / (F.count(F.lit(1)).over(tot) * F.col("n_c")))
                         .alias("weight"))


def apply_class_weights(df: DataFrame, label: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    # one row per class: the weight table's size is the number of classes
    return df.join(F.broadcast(weights.withColumnRenamed("weight", out)), label, "left")


def pos_weight(train: DataFrame, label: str) -> float:
    """``scale_pos_weight`` = negatives / positives."""
    r = train.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return r["n0"] / r["n1"] if r["n1"] else 1.0


def apply_pos_weight(df: DataFrame, label: str, w: float, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w)).otherwise(F.lit(1.0)))
