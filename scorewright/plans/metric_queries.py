"""Registered queries: evaluation metrics and decision thresholds (M1-M14) on the
deterministic ``scored`` fixture (id, label, score)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mx
from ..sources.fixtures import scored, scored_m
from .oracle_fixtures import with_fixtures
from .registry import register

T_DEFAULT = 0.5
GRID_40 = mx.grid(30, 70, 1, 100)        # .30 .. .69, step .01
GRID_100 = mx.grid(200, 700, 5, 1000)    # .200 .. .695, step .005

_CUM = """
g AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
      FROM scored WHERE score IS NOT NULL GROUP BY score),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM g),
c AS (SELECT score, pos, neg,
             CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
             lead(pos) OVER (ORDER BY score DESC) AS next_pos,
             lead(neg) OVER (ORDER BY score DESC) AS next_neg FROM g)"""

_COUNTS = f"""
k AS (SELECT CAST(count_if(label = 1 AND score >= {T_DEFAULT}) AS BIGINT) AS tp,
             CAST(count_if(label = 0 AND score >= {T_DEFAULT}) AS BIGINT) AS fp,
             CAST(count_if(label = 1 AND score < {T_DEFAULT}) AS BIGINT) AS fn,
             CAST(count_if(label = 0 AND score < {T_DEFAULT}) AS BIGINT) AS tn FROM scored)"""

_PR = """
pr AS (SELECT score AS threshold, CASE WHEN tp + fp <> 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
              tp::DOUBLE / (SELECT P FROM tot) AS recall FROM c)"""

_BEST = """
best AS (SELECT threshold, precision, recall,
                2 * precision * recall / (precision + recall + 1e-10::DOUBLE) AS f1
         FROM pr ORDER BY f1 DESC, threshold ASC LIMIT 1)"""


def _div0(a, b):
    return f"CASE WHEN ({b}) <> 0 THEN ({a})::DOUBLE / ({b}) ELSE 0.0::DOUBLE END"


def _pred(spark, d, t=T_DEFAULT):
    return mx.predict(scored(spark, d), "score", t, ">=")


# M10
register("apply_threshold", doubles=("score",), sql=with_fixtures(
    f"SELECT id, label, score, CAST(score >= {T_DEFAULT} AS INTEGER) AS prediction FROM scored", "scored"))(
    lambda spark, d: _pred(spark, d).select("id", "label", "score", "prediction"))

# M1
register("confusion_matrix", sql=with_fixtures("""
SELECT 0 AS label, 0 AS prediction, tn AS n FROM k UNION ALL SELECT 0, 1, fp FROM k
UNION ALL SELECT 1, 0, fn FROM k UNION ALL SELECT 1, 1, tp FROM k""", "scored", extra=_COUNTS))(
    lambda spark, d: mx.confusion_matrix(_pred(spark, d), "label", "prediction"))

# M2
_METRICS_SQL = f"""{_div0('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_div0('tp', 'tp + fp')} AS precision,
       {_div0('tp', 'tp + fn')} AS recall, {_div0('2 * tp', '2 * tp + fp + fn')} AS f1"""
register("binary_metrics", doubles=("accuracy", "precision", "recall", "f1"), sql=with_fixtures(
    f"SELECT {_METRICS_SQL}, tp, fp, fn, tn FROM k", "scored", extra=_COUNTS))(
    lambda spark, d: mx.binary_metrics(_pred(spark, d), "label", "prediction"))

# M3
register("classification_report", doubles=("precision", "recall", "f1"), sql=with_fixtures(f"""
SELECT '0' AS class, {_div0('tn', 'tn + fn')} AS precision, {_div0('tn', 'tn + fp')} AS recall,
       {_div0('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM k
UNION ALL SELECT '1', {_div0('tp', 'tp + fp')}, {_div0('tp', 'tp + fn')}, {_div0('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM k
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, {_div0('tp + tn', 'tp + fp + fn + tn')}, tp + fp + fn + tn FROM k
UNION ALL SELECT 'macro avg', ({_div0('tn', 'tn + fn')} + {_div0('tp', 'tp + fp')}) / 2,
       ({_div0('tn', 'tn + fp')} + {_div0('tp', 'tp + fn')}) / 2,
       ({_div0('2 * tn', '2 * tn + fn + fp')} + {_div0('2 * tp', '2 * tp + fp + fn')}) / 2, tp + fp + fn + tn FROM k
UNION ALL SELECT 'weighted avg',
       {_div0(f"{_div0('tn', 'tn + fn')} * (tn + fp) + {_div0('tp', 'tp + fp')} * (tp + fn)", 'tp + fp + fn + tn')},
       {_div0(f"{_div0('tn', 'tn + fp')} * (tn + fp) + {_div0('tp', 'tp + fn')} * (tp + fn)", 'tp + fp + fn + tn')},
       {_div0(f"{_div0('2 * tn', '2 * tn + fn + fp')} * (tn + fp) + {_div0('2 * tp', '2 * tp + fp + fn')} * (tp + fn)", 'tp + fp + fn + tn')},
       tp + fp + fn + tn FROM k""", "scored", extra=_COUNTS))(
    lambda spark, d: mx.classification_report(_pred(spark, d), "label", "prediction"))

# M4
register("roc_auc", doubles=("roc_auc",), sql=with_fixtures("""
SELECT (SELECT P FROM tot) AS n_positive, (SELECT N FROM tot) AS n_negative,
       CASE WHEN (SELECT P FROM tot) > 0 AND (SELECT N FROM tot) > 0 THEN
         sum(pos::DOUBLE * ((SELECT N FROM tot) - fp + neg * 0.5::DOUBLE)) / ((SELECT P FROM tot) * (SELECT N FROM tot))::DOUBLE
       END AS roc_auc FROM c""", "scored", extra=_CUM))(
    lambda spark, d: mx.roc_auc(scored_m(spark, d), "label", "score"))

# M5
register("roc_curve", doubles=("threshold", "fpr", "tpr"), sql=with_fixtures("""
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score, fp::DOUBLE / (SELECT N FROM tot), tp::DOUBLE / (SELECT P FROM tot) FROM c
WHERE next_pos IS NULL OR (fp - neg) - 2 * fp + (fp + next_neg) <> 0 OR (tp - pos) - 2 * tp + (tp + next_pos) <> 0""",
                                                                          "scored", extra=_CUM))(
    lambda spark, d: mx.roc_curve(scored_m(spark, d), "label", "score"))

# M6
register("pr_curve", doubles=("threshold", "precision", "recall"), sql=with_fixtures("""
SELECT threshold, precision, recall FROM pr
UNION ALL SELECT NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE""", "scored", extra=_CUM + "," + _PR))(
    lambda spark, d: mx.pr_curve(scored_m(spark, d), "label", "score"))

# M7
register("average_precision", doubles=("average_precision",), sql=with_fixtures("""
SELECT sum(pos / (SELECT P FROM tot)::DOUBLE * (tp::DOUBLE / (tp + fp))) AS average_precision FROM c""",
                                                                                            "scored", extra=_CUM))(
    lambda spark, d: mx.average_precision(scored_m(spark, d), "label", "score"))


# M8
def _grid_sql(ts, cmp=">"):
    values = ", ".join(f"({t}::DOUBLE)" for t in ts)
    return with_fixtures(f"""
SELECT threshold, tp, fp, fn, tn, {_div0('tp', 'tp + fp')} AS precision, {_div0('tp', 'tp + fn')} AS recall,
       {_div0('2 * tp', '2 * tp + fp + fn')} AS f1
FROM (SELECT t.threshold,
             CAST(count_if(s.label = 1 AND s.score {cmp} t.threshold) AS BIGINT) AS tp,
             CAST(count_if(s.label = 0 AND s.score {cmp} t.threshold) AS BIGINT) AS fp,
             CAST(count_if(s.label = 1 AND NOT (s.score {cmp} t.threshold)) AS BIGINT) AS fn,
             CAST(count_if(s.label = 0 AND NOT (s.score {cmp} t.threshold)) AS BIGINT) AS tn
      FROM (VALUES {values}) t(threshold), scored s WHERE s.score IS NOT NULL GROUP BY t.threshold)""", "scored")


register("threshold_grid_f1", doubles=("threshold", "precision", "recall", "f1"), sql=_grid_sql(GRID_40))(
    lambda spark, d: mx.threshold_grid_f1(scored_m(spark, d), "label", "score", GRID_40, ">"))

register("threshold_grid_f1_fine", doubles=("threshold", "precision", "recall", "f1"), sql=_grid_sql(GRID_100))(
    lambda spark, d: mx.threshold_grid_f1(scored_m(spark, d), "label", "score", GRID_100, ">"))

# M9
register("threshold_best_f1", doubles=("threshold", "precision", "recall", "f1"), sql=with_fixtures(
    "SELECT * FROM best", "scored", extra=_CUM + "," + _PR + "," + _BEST))(
    lambda spark, d: mx.best_f1_threshold(scored_m(spark, d), "label", "score"))


# M11
def threshold_compare(spark, d):
    s = scored_m(spark, d)
    t_best = mx.best_f1_threshold(s, "label", "score").first()["threshold"]
    f_def = mx.binary_metrics(mx.predict(s, "score", T_DEFAULT), "label", "prediction").select(
        F.col("f1").alias("f1_default"))
    f_tun = mx.binary_metrics(mx.predict(s, "score", t_best), "label", "prediction").select(
        F.col("f1").alias("f1_tuned"))
    row = f_def.first()["f1_default"], f_tun.first()["f1_tuned"]
    return spark.createDataFrame([(T_DEFAULT, row[0], t_best, row[1])],
                                 "threshold_default double, f1_default double, threshold_tuned double, f1_tuned double") \
        .withColumn("f1_gain", F.col("f1_tuned") - F.col("f1_default"))


register("threshold_compare", doubles=("threshold_default", "f1_default", "threshold_tuned", "f1_tuned", "f1_gain"),
         sql=with_fixtures(f"""
SELECT {T_DEFAULT}::DOUBLE AS threshold_default, fd AS f1_default, tt AS threshold_tuned, ft AS f1_tuned, ft - fd AS f1_gain
FROM (SELECT (SELECT f1 FROM k2) AS fd, (SELECT threshold FROM best) AS tt,
             (SELECT {_div0('2 * tp', '2 * tp + fp + fn')} FROM (
                SELECT count_if(label = 1 AND score >= (SELECT threshold FROM best)) AS tp,
                       count_if(label = 0 AND score >= (SELECT threshold FROM best)) AS fp,
                       count_if(label = 1 AND score < (SELECT threshold FROM best)) AS fn FROM scored)) AS ft)""",
                           "scored", extra=_CUM + "," + _PR + "," + _BEST + "," + _COUNTS
                           + f",\nk2 AS (SELECT {_div0('2 * tp', '2 * tp + fp + fn')} AS f1 FROM k)"))(threshold_compare)

# M12
QUALITY_GATE = 0.80
register("quality_gate", doubles=("accuracy",), sql=with_fixtures(f"""
SELECT {_div0('tp + tn', 'tp + fp + fn + tn')} AS accuracy,
       {_div0('tp + tn', 'tp + fp + fn + tn')} >= {QUALITY_GATE}::DOUBLE AS passed FROM k""", "scored", extra=_COUNTS))(
    lambda spark, d: mx.binary_metrics(_pred(spark, d), "label", "prediction").select(
        "accuracy", (F.col("accuracy") >= F.lit(QUALITY_GATE)).alias("passed")))


# M13
def evaluation_summary(spark, d):
    s = scored_m(spark, d)
    m = mx.binary_metrics(mx.predict(s, "score", T_DEFAULT), "label", "prediction").first()
    auc = mx.roc_auc(s, "label", "score").first()["roc_auc"]
    ap = mx.average_precision(s, "label", "score").first()["average_precision"]
    best = mx.best_f1_threshold(s, "label", "score").first()
    return spark.createDataFrame(
        [(m["accuracy"], m["precision"], m["recall"], m["f1"], auc, ap, best["threshold"], best["f1"],
          m["tn"], m["fp"], m["fn"], m["tp"])],
        "accuracy double, precision double, recall double, f1 double, roc_auc double, average_precision double, "
        "best_threshold double, best_f1 double, tn bigint, fp bigint, fn bigint, tp bigint")


register("evaluation_summary", doubles=("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
                                        "best_threshold", "best_f1"), sql=with_fixtures(f"""
SELECT {_METRICS_SQL},
       (SELECT sum(pos::DOUBLE * ((SELECT N FROM tot) - fp + neg * 0.5::DOUBLE)) / ((SELECT P FROM tot) * (SELECT N FROM tot))::DOUBLE FROM c) AS roc_auc,
       (SELECT sum(pos / (SELECT P FROM tot)::DOUBLE * (tp::DOUBLE / (tp + fp))) FROM c) AS average_precision,
       (SELECT threshold FROM best) AS best_threshold, (SELECT f1 FROM best) AS best_f1, tn, fp, fn, tp
FROM k""", "scored", extra=_CUM + "," + _PR + "," + _BEST + "," + _COUNTS))(evaluation_summary)

# M14
register("score_buckets", doubles=("observed_rate", "mean_score"), sql=with_fixtures("""
SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bucket, count(*) AS n, avg(label::DOUBLE) AS observed_rate,
       avg(score) AS mean_score
FROM scored WHERE score IS NOT NULL GROUP BY 1""", "scored"))(
    lambda spark, d: mx.score_buckets(scored(spark, d), "label", "score"))
