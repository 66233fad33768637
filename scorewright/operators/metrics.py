"""Exact binary-classification metrics as aggregate and window queries.

Input: a frame with a 0/1 label and a score (probability).  Curve metrics
(ROC, PR, AUC, average precision, best-F1 threshold) need cumulative counts in
descending score order.  They work on the *distinct-score* table
(``groupBy(score)``, partial aggregation), cut into score-range buckets by
``percentile_approx`` cut points (``Bucketizer`` binary search, JVM side).  A
per-bucket total table (one row per bucket) gives each bucket's offset, and a
window partitioned by bucket adds the running sums, so no single task ever sees
all distinct scores.  The results are exact (ties are grouped, as scikit-learn
does).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import running_sums

BUCKETS = 64
BUCKET_ROWS = 1_000_000   # distinct scores in a bucket; more buckets beyond it
EPS_F1 = 1e-10


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 for a zero denominator (scikit-learn zero_division=0)."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def predict(df: DataFrame, score: str, threshold: float, comparator: str = ">=",
            out: str = "prediction") -> DataFrame:
    """Apply a decision threshold (``>=`` or ``>``)."""
    s, t = F.col(score), F.lit(threshold)
    cond = s >= t if comparator == ">=" else s > t
    return df.withColumn(out, cond.cast("int"))


# M1 / M2 / M3 ---------------------------------------------------------------
def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """All four cells of the 2x2 matrix, zeros kept."""
    c = _counts(df, label, pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(n).alias("n"))
        for a, b, n in cells])).alias("s")).select("s.*")


def _metric_cols(tp, fp, fn, tn) -> dict[str, Column]:
    n = tp + fp + fn + tn
    return {
        "accuracy": _div0(tp + tn, n),
        "precision": _div0(tp, tp + fp),
        "recall": _div0(tp, tp + fn),
        "f1": _div0(2 * tp, 2 * tp + fp + fn),
    }


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*[v.alias(k) for k, v in _metric_cols(tp, fp, fn, tn).items()], "tp", "fp", "fn", "tn")


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / f1 / support, accuracy, macro and weighted averages."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _div0(tn, tn + fn), _div0(tn, tn + fp), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        s.cast("bigint").alias("support"))
    none = F.lit(None).cast("double")
    rows = [
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, _div0(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, n), _div0(r0 * s0 + r1 * s1, n),
            _div0(f0 * s0 + f1 * s1, n), n),
    ]
    return c.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


# cumulative counts over distinct scores ----------------------------------------
def scored_rows(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows that count: label and score present, and the score a number."""
    return df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    return scored_rows(df, label, score).groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def _score_cuts(groups: DataFrame, buckets: int) -> list[float]:
    """Cuts of the distinct scores into ``buckets`` ranges, more where a range would hold
    over ``BUCKET_ROWS`` of them."""
    while buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        row = groups.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", probs, max(10000, 10 * buckets)).alias("c")).first()
        wanted = -(-row["n"] // BUCKET_ROWS)
        if wanted <= buckets:
            return sorted({float(c) for c in (row["c"] or []) if c is not None})
        buckets = wanted
    return []


def cumulative(df: DataFrame, label: str, score: str, buckets: int = BUCKETS) -> DataFrame:
    """One row per distinct score with positives / negatives at that score and the
    cumulative counts ``tp``/``fp`` of all rows scoring >= it, plus the next lower
    point's counts (``next_pos``/``next_neg``, NULL at the lowest score)."""
    g = score_groups(df, label, score)
    cuts = _score_cuts(g, buckets)
    if cuts:
        splits = [float("-inf")] + cuts + [float("inf")]
        b = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(g)
        b = b.withColumn("bucket", F.col("bucket").cast("int"))
    else:
        b = g.withColumn("bucket", F.lit(0))

    per_bucket = b.groupBy("bucket").agg(
        F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"),
        F.max_by("pos", "score").alias("first_pos"), F.max_by("neg", "score").alias("first_neg"))
    wb = Window.orderBy(F.desc("bucket"))   # one row per bucket: a tiny single-task window
    running = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_bucket.select(
        "bucket",
        (F.sum("b_pos").over(running) - F.col("b_pos")).alias("off_pos"),
        (F.sum("b_neg").over(running) - F.col("b_neg")).alias("off_neg"),
        F.lead("first_pos").over(wb).alias("nb_pos"), F.lead("first_neg").over(wb).alias("nb_neg"))
    # at most `buckets` rows by construction
    j = b.join(F.broadcast(offsets), "bucket")
    w = Window.partitionBy("bucket").orderBy(F.desc("score"))
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(
        "score", "pos", "neg",
        (F.col("off_pos") + F.sum("pos").over(cum)).alias("tp"),
        (F.col("off_neg") + F.sum("neg").over(cum)).alias("fp"),
        F.coalesce(F.lead("pos").over(w), F.col("nb_pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(w), F.col("nb_neg")).alias("next_neg"))


def _totals(df: DataFrame, label: str) -> tuple[int, int]:
    r = df.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    p = r["p"] or 0
    return p, r["n"] - p


# M4 / M7 ----------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str, score: str, buckets: int = BUCKETS) -> DataFrame:
    """Mann-Whitney AUC with average ranks for ties: the sum over distinct scores
    of pos * (negatives scoring lower + neg / 2), divided by P * N."""
    c = cumulative(df, label, score, buckets)
    p, n = _totals(scored_rows(df, label, score), label)
    num = F.sum(F.col("pos").cast("double") * (F.lit(n) - F.col("fp") + F.col("neg") * 0.5))
    auc = (F.col("_num") / F.lit(float(p * n))) if p and n else F.lit(None).cast("double")
    return c.agg(num.alias("_num")).select(
        F.lit(p).cast("bigint").alias("n_positive"), F.lit(n).cast("bigint").alias("n_negative"),
        auc.alias("roc_auc"))


def roc_auc_by(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """``roc_auc`` of each group in one pass: the distinct scores of all groups are ordered in
    range partitions, which give the negatives that score lower in the same group."""
    rows = scored_rows(df, label, score)
    counted = rows.groupBy(*by, F.col(score).cast("double").alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.sum((1 - F.col(label)).cast("long")).alias("_neg"))
    ranked = running_sums(counted, list(by), ["_score"], F.col("_neg"))
    won = F.sum(F.col("_pos") * (F.col("_before") + F.col("_neg") * 0.5))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return ranked.groupBy(*by).agg(F.when(pairs > 0, won / pairs).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, buckets: int = BUCKETS) -> DataFrame:
    """sum over distinct scores (descending) of (recall step) * precision."""
    c = cumulative(df, label, score, buckets)
    n_pos = c.agg(F.sum("pos")).first()[0] or 0
    ap = F.sum(F.col("pos") / F.lit(float(n_pos)) * (F.col("tp") / (F.col("tp") + F.col("fp")))) if n_pos else F.lit(None)
    return c.agg(ap.cast("double").alias("average_precision"))


# M5 ---------------------------------------------------------------------------
def roc_curve(df: DataFrame, label: str, score: str, drop_intermediate: bool = True,
              buckets: int = BUCKETS) -> DataFrame:
    """(threshold, fpr, tpr) per kept distinct score plus the (0, 0) start, whose
    threshold is NULL (scikit-learn uses +inf).  ``drop_intermediate`` keeps a
    point only where the curve bends (second difference of fp or tp is non-zero)."""
    c = cumulative(df, label, score, buckets)
    p, n = _totals(scored_rows(df, label, score), label)
    tp, fp = F.col("tp"), F.col("fp")
    prev_tp, prev_fp = tp - F.col("pos"), fp - F.col("neg")
    next_tp, next_fp = tp + F.col("next_pos"), fp + F.col("next_neg")
    pts = c
    if drop_intermediate:
        # the first point has (0, 0) before it, the last point is always kept
        bend = (F.col("next_pos").isNull() | ((prev_fp - 2 * fp + next_fp) != 0) | ((prev_tp - 2 * tp + next_tp) != 0))
        pts = c.where(bend)
    rate = lambda x, d: (x / F.lit(float(d))) if d else F.lit(None).cast("double")
    curve = pts.select(F.col("score").alias("threshold"), rate(fp, n).alias("fpr"), rate(tp, p).alias("tpr"))
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(curve)


# M6 ---------------------------------------------------------------------------
def pr_curve(df: DataFrame, label: str, score: str, buckets: int = BUCKETS) -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the final point
    (precision 1, recall 0) that has no threshold."""
    c = cumulative(df, label, score, buckets)
    p, _n = _totals(scored_rows(df, label, score), label)
    tp, fp = F.col("tp"), F.col("fp")
    recall = (tp / F.lit(float(p))) if p else F.lit(1.0)
    curve = c.select(F.col("score").alias("threshold"), _div0(tp, tp + fp).alias("precision"),
                     recall.alias("recall"))
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


# M9 ---------------------------------------------------------------------------
def best_f1_threshold(df: DataFrame, label: str, score: str, eps: float = EPS_F1,
                      buckets: int = BUCKETS) -> DataFrame:
    """Threshold maximising F1 = 2PR/(P+R+eps) on the PR curve (last point
    excluded); ties go to the lowest threshold (numpy argmax over ascending
    thresholds).  A top-1, not a sort."""
    pr = pr_curve(df, label, score, buckets).where(F.col("threshold").isNotNull())
    f1 = (2 * F.col("precision") * F.col("recall")) / (F.col("precision") + F.col("recall") + F.lit(eps))
    return (pr.withColumn("f1", f1).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
            .select("threshold", "precision", "recall", "f1"))


# M8 ---------------------------------------------------------------------------
def grid(start: int, stop: int, step: int, scale: int) -> list[float]:
    """Thresholds built as integer / scale (no floating drift)."""
    return [i / scale for i in range(start, stop, step)]


def threshold_grid_f1(df: DataFrame, label: str, score: str, thresholds: Sequence[float],
                      comparator: str = ">") -> DataFrame:
    """F1 at every grid threshold without pairing rows with thresholds: each row
    counts the grid points it clears (``k``), rows aggregate by ``k`` (at most
    len(grid)+1 groups), and suffix sums over k give tp / fp at every threshold."""
    ts = sorted({float(t) for t in thresholds})
    inf, s = float("inf"), F.col(score).cast("double")
    rows = scored_rows(df, label, score).select(F.col(label), (-s if comparator == ">" else s).alias("_s"))
    # the bucketizer counts the cuts at or below a value; with signs turned, those at or above it
    cuts = [-t for t in reversed(ts)] if comparator == ">" else ts
    at = Bucketizer(splits=[-inf, *cuts, inf], inputCol="_s", outputCol="_at").transform(rows)
    k = F.col("_at").cast("int")
    k = F.lit(len(ts)) - k if comparator == ">" else k
    per_k = at.groupBy(k.alias("k")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    p_tot, n_tot = _totals(rows, label)
    spark = df.sparkSession
    # grid point i as a marker row at k = i + 1; a suffix sum over k (ties included)
    # then gives, at the marker, the counts of all rows with k > i.  Both parts
    # have at most len(grid) + 1 rows, so the window is tiny.
    marks = spark.createDataFrame([(i + 1, float(t)) for i, t in enumerate(ts)], "k int, threshold double")
    both = (per_k.withColumn("threshold", F.lit(None).cast("double"))
            .unionByName(marks.withColumn("pos", F.lit(0).cast("long")).withColumn("neg", F.lit(0).cast("long"))))
    suffix = Window.orderBy(F.desc("k")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    agg = (both.select("k", "threshold", F.sum("pos").over(suffix).alias("tp"), F.sum("neg").over(suffix).alias("fp"))
           .where(F.col("threshold").isNotNull()))
    tp = F.coalesce(F.col("tp"), F.lit(0)).cast("long")
    fp = F.coalesce(F.col("fp"), F.lit(0)).cast("long")
    fn = F.lit(p_tot) - tp
    tn = F.lit(n_tot) - fp
    return agg.select("threshold", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
                      _div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
                      _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


# M14 --------------------------------------------------------------------------
def score_buckets(df: DataFrame, label: str, score: str, n: int = 10) -> DataFrame:
    b = F.least(F.floor(F.col(score) * n), F.lit(n - 1)).cast("int")
    return (df.where(F.col(score).isNotNull()).groupBy(b.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("observed_rate"),
                 F.avg(score).alias("mean_score")))
