"""Registered queries: exact k nearest neighbours (J3), k-NN classifier, SMOTE
(T17), on the ``vectors`` fixture (embeddings, binary target label = 0)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mx
from ..operators import neighbors as nb
from ..operators import prepare as pr
from ..operators import split as sp
from ..sources.fixtures import account, vectors
from ..session import materialize
from .oracle_fixtures import with_fixtures
from .registry import register

K = 5


def _vecs(spark, d):
    v = vectors(spark, d)
    return v.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"),
                    (F.col("label") == 0).cast("int").alias("label"))


def _split(spark, d):
    return materialize(sp.stratified_split(_vecs(spark, d), "label"))


register("knn_topk", doubles=("distance",), sql=with_fixtures(f"""
SELECT q_id, n_id, CAST(rank AS INTEGER) AS rank, distance FROM (
  SELECT q_id, n_id, distance, row_number() OVER (PARTITION BY q_id ORDER BY distance, n_id) AS rank
  FROM (SELECT a.vec_id AS q_id, b.vec_id AS n_id,
               list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))
WHERE rank <= {K}""", "vsplit"))(
    lambda spark, d: (lambda v: nb.knn(v, v, K))(materialize(_vecs(spark, d))))


def model_knn(spark, d):
    s = _split(spark, d)
    train, test = s.where(F.col("is_test") == 0), s.where(F.col("is_test") == 1)
    return nb.knn_classify(train, test, K).select("id", "p1", "prediction")


register("model_knn", doubles=("p1",), sql=with_fixtures(f"""
SELECT id, avg(y::DOUBLE) AS p1, CAST(avg(y::DOUBLE) > 0.5 AS INTEGER) AS prediction FROM (
  SELECT q.vec_id AS id, t.y, row_number() OVER (PARTITION BY q.vec_id ORDER BY
           list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])), t.vec_id) AS rank
  FROM (SELECT * FROM vsplit WHERE is_test = 1) q, (SELECT * FROM vsplit WHERE is_test = 0) t)
WHERE rank <= {K} GROUP BY id""", "vsplit"))(model_knn)


def smote_oversample(spark, d):
    s = _split(spark, d)
    return nb.smote(s.where(F.col("is_test") == 0), k=3).select("id", "label", "synthetic", "v")


register("smote_oversample")(smote_oversample)


# C-KNN: every setting of the reference's search from one neighbour table (fixed values)
KNN_KS = [3, 5, 7, 9, 11]


def knn_grid(spark, d):
    """Hold-out AUC and accuracy of the ten settings."""
    s = _split(spark, d)
    train, test = s.where(F.col("is_test") == 0), s.where(F.col("is_test") == 1)
    scored = nb.knn_settings(train, test, KNN_KS).join(test.select("id", "label"), "id")
    scored = materialize(scored.withColumn("p1", F.round("p1", 9)))  # sums of one order in both engines
    right = scored.groupBy("k", "weights").agg(F.avg((F.col("label") == (F.col("p1") > 0.5).cast("int")).cast("double")).alias("accuracy"))
    return right.join(mx.roc_auc_by(scored, ["k", "weights"], "label", "p1"), ["k", "weights"])


register("knn_grid", doubles=("accuracy", "roc_auc"), sql=with_fixtures(f"""
SELECT k, weights, avg(CAST(y = CAST(p1 > 0.5 AS INTEGER) AS DOUBLE)) AS accuracy,
  (sum(place) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS roc_auc
FROM (SELECT *, rank() OVER (PARTITION BY k, weights ORDER BY p1) + (count(*) OVER (PARTITION BY k, weights, p1) - 1) / 2 AS place FROM (
  SELECT k, weights, id, any_value(own) AS y, round(CASE WHEN weights = 'uniform' THEN avg(y::DOUBLE)
      WHEN count(*) FILTER (distance = 0) > 0 THEN avg(y::DOUBLE) FILTER (distance = 0) ELSE sum(y / distance) / sum(1 / distance) END, 9) AS p1
  FROM near, (SELECT unnest({KNN_KS}) AS k), (SELECT unnest(['uniform', 'distance']) AS weights) WHERE rank <= k GROUP BY k, weights, id))
GROUP BY k, weights""", "vsplit", extra=f"""near AS (SELECT * FROM (
  SELECT q.vec_id AS id, q.y AS own, t.y, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])) AS distance, row_number() OVER (
    PARTITION BY q.vec_id ORDER BY list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])), t.vec_id) AS rank
  FROM (SELECT * FROM vsplit WHERE is_test = 1) q, (SELECT * FROM vsplit WHERE is_test = 0) t) WHERE rank <= {max(KNN_KS)})"""))(knn_grid)

# J3, approximate: the accounts' numbers, filled and scaled, against each other
KNN_COLUMNS = ["relationships", "funding_rounds", "milestones", "avg_participants", "funding_total_usd", "age_first_funding_year", "age_last_funding_year"]


def account_vectors(spark, d):
    rows = materialize(account(spark, d).select("id", *[F.col(c).cast("double").alias(c) for c in KNN_COLUMNS]))
    rows = pr.apply_fill(rows, pr.fit_median(rows, KNN_COLUMNS))
    rows = pr.apply_standard(rows, pr.fit_standard(rows, KNN_COLUMNS))
    return materialize(rows.select("id", F.array(*KNN_COLUMNS).alias("v")))


def knn_approx_topk(spark, d):
    v = account_vectors(spark, d)
    return nb.knn_approx(v, v, K)


register("knn_approx_topk")(knn_approx_topk)
