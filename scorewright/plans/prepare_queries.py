"""Registered queries: splitting (V1-V3) and preparation.

Every ``fit_*`` sees only the training part of the exact stratified split; the
fitted statistics are applied to all rows.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import prepare as pr
from ..operators import split as sp
from ..sources.fixtures import account, account_m
from .oracle_fixtures import with_fixtures
from .registry import register

AGES = ["age_first_funding_year", "age_last_funding_year", "age_first_milestone_year",
        "age_last_milestone_year"]
CORE = AGES + ["relationships", "funding_rounds", "funding_total_usd", "milestones", "avg_participants"]


def _split(spark, d):
    return sp.stratified_split(account_m(spark, d), "labels")


def _train(df):
    return df.where(F.col("is_test") == 0)


# V1
register("stratified_split", sql=with_fixtures("SELECT id, labels, is_test FROM account_split", "account_split"))(
    lambda spark, d: _split(spark, d).select("id", "labels", "is_test"))

# V2
register("random_split", sql=with_fixtures("""
SELECT id, CAST(rn <= round(0.2::DOUBLE * n) AS INTEGER) AS is_test
FROM (SELECT id, row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 15), id) AS rn,
             count(*) OVER () AS n FROM account)""", "account"))(
    lambda spark, d: sp.random_split(account_m(spark, d)).select("id", "is_test"))

# V3
register("stratified_kfold", sql=with_fixtures("SELECT id, labels, fold FROM account_split", "account_split"))(
    lambda spark, d: sp.stratified_kfold(account_m(spark, d), "labels", k=5).select("id", "labels", "fold"))


# T1
IMPUTE_MEDIAN_COLS = AGES + ["avg_participants"]


def impute_median(spark, d):
    s = _split(spark, d)
    return pr.apply_fill(s, pr.fit_median(_train(s), IMPUTE_MEDIAN_COLS)).select("id", *IMPUTE_MEDIAN_COLS)


register("impute_median", doubles=tuple(IMPUTE_MEDIAN_COLS), sql=with_fixtures(
    "SELECT id, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM train)) AS {c}" for c in IMPUTE_MEDIAN_COLS)
    + " FROM account_split", "train"))(impute_median)

# T2
IMPUTE_MODE_COLS = ["category_code", "age_first_milestone_year", "age_last_milestone_year"]


def impute_mode(spark, d):
    s = _split(spark, d)
    return pr.apply_fill(s, pr.fit_mode(_train(s), IMPUTE_MODE_COLS)).select("id", *IMPUTE_MODE_COLS)


register("impute_mode", doubles=tuple(IMPUTE_MODE_COLS[1:]), sql=with_fixtures(
    "SELECT id, " + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in IMPUTE_MODE_COLS) + " FROM account_split", "train"))(impute_mode)

# T3
CONSTANTS = {"age_first_funding_year": 999.0, "age_last_funding_year": 0.0,
             "age_first_milestone_year": 999.0, "age_last_milestone_year": 10.0, "avg_participants": 1.0}
register("impute_constant", doubles=tuple(CONSTANTS), sql=with_fixtures(
    "SELECT id, " + ", ".join(f"coalesce({c}, {v}::DOUBLE) AS {c}" for c, v in CONSTANTS.items())
    + " FROM account", "account"))(
    lambda spark, d: pr.apply_fill(account(spark, d), CONSTANTS).select("id", *CONSTANTS))


# T4 / T5
def _clip_sql(cols, lo, hi):
    parts = []
    for c in cols:
        ql = f"(SELECT quantile_cont({c}, {lo}) FROM train)"
        qh = f"(SELECT quantile_cont({c}, {hi}) FROM train)"
        parts.append(f"CASE WHEN {c} < {ql} THEN {ql}::DOUBLE WHEN {c} > {qh} THEN {qh}::DOUBLE ELSE {c}::DOUBLE END AS {c}")
    return with_fixtures("SELECT id, " + ", ".join(parts) + " FROM account_split", "train")


CLIP_Q_COLS = ["funding_total_usd", "funding_rounds", "milestones", "relationships", "avg_participants"]


def clip_quartiles(spark, d):
    s = _split(spark, d)
    return pr.apply_clip(s, pr.fit_clip(_train(s), CLIP_Q_COLS, 0.25, 0.75)).select("id", *CLIP_Q_COLS)


register("clip_quartiles", doubles=tuple(CLIP_Q_COLS), sql=_clip_sql(CLIP_Q_COLS, 0.25, 0.75))(clip_quartiles)

PRESERVE = ["funding_total_usd", "relationships", "milestones"]
CLIP_P_COLS = [c for c in CORE if c not in PRESERVE]


def clip_p05_p95(spark, d):
    s = _split(spark, d)
    bounds = pr.fit_clip(_train(s), CORE, 0.05, 0.95, preserve=PRESERVE)
    return pr.apply_clip(s, bounds).select("id", *CLIP_P_COLS)


register("clip_p05_p95", doubles=tuple(CLIP_P_COLS), sql=_clip_sql(CLIP_P_COLS, 0.05, 0.95))(clip_p05_p95)


# T6
def scale_standard(spark, d):
    s = _split(spark, d)
    return pr.apply_standard(s, pr.fit_standard(_train(s), CORE)).select("id", *CORE)


register("scale_standard", doubles=tuple(CORE), sql=with_fixtures(
    "SELECT id, " + ", ".join(
        f"({c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END FROM train) AS {c}"
        for c in CORE) + " FROM account_split", "train"))(scale_standard)


# T7
def scale_robust(spark, d):
    s = _split(spark, d)
    return pr.apply_robust(s, pr.fit_robust(_train(s), CORE)).select("id", *CORE)


register("scale_robust", doubles=tuple(CORE), sql=with_fixtures(
    "SELECT id, " + ", ".join(
        f"({c} - (SELECT median({c}) FROM train)) / (SELECT CASE WHEN coalesce(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0) = 0 THEN 1.0::DOUBLE ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM train) AS {c}"
        for c in CORE) + " FROM account_split", "train"))(scale_robust)


# Spark ML encoder pair; reported as the sparse vector (size, hot index)
def one_hot(spark, d):
    s = _split(spark, d)
    idx = StringIndexer(inputCol="category_code", outputCol="cat_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    # the indexer (keep) already adds the unknown slot; dropLast removes it -> unknown = all zeros
    enc = OneHotEncoder(inputCol="cat_idx", outputCol="cat_vec", dropLast=True)
    tr = _train(s)
    idx_m = idx.fit(tr)
    enc_m = enc.fit(idx_m.transform(tr))
    out = enc_m.transform(idx_m.transform(s)).withColumn("arr", vector_to_array("cat_vec"))
    pos = F.array_position(F.col("arr"), F.lit(1.0)) - 1
    return out.select("id", "category_code", F.size("arr").alias("onehot_size"),
                      F.when(pos >= 0, pos).cast("int").alias("onehot_index"))


register("one_hot", sql=with_fixtures("""
SELECT s.id, s.category_code, (SELECT count(DISTINCT category_code) FROM train)::INTEGER AS onehot_size,
       CAST(v.code AS INTEGER) AS onehot_index
FROM account_split s LEFT JOIN (
  SELECT category_code, row_number() OVER (ORDER BY category_code) - 1 AS code
  FROM (SELECT DISTINCT category_code FROM train WHERE category_code IS NOT NULL)) v
  ON s.category_code = v.category_code""", "train"))(one_hot)


# T9 / T10 / T11
def label_encode(spark, d):
    s = _split(spark, d)
    codes = pr.fit_label_codes(_train(s), "category_code")
    return pr.apply_label_codes(s, "category_code", codes, unseen="null").select("id", "category_code", "category_code_code")


_CODES_SQL = """
SELECT s.id, s.category_code, CAST({fill} AS INTEGER) AS category_code_code
FROM account_split s LEFT JOIN (
  SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
  FROM (SELECT DISTINCT coalesce(CAST(category_code AS VARCHAR), 'nan') AS value FROM {src})) v
  ON coalesce(CAST(s.category_code AS VARCHAR), 'nan') = v.value"""

register("label_encode", sql=with_fixtures(_CODES_SQL.format(fill="v.code", src="train"), "train"))(label_encode)


def label_encode_unseen(spark, d):
    s = _split(spark, d)
    codes = pr.fit_label_codes(_train(s), "category_code")
    return pr.apply_label_codes(s, "category_code", codes, unseen="extra").select("id", "category_code", "category_code_code")


register("label_encode_unseen", sql=with_fixtures(_CODES_SQL.format(
    fill="coalesce(v.code, (SELECT count(DISTINCT coalesce(CAST(category_code AS VARCHAR), 'nan')) FROM train))",
    src="train"), "train"))(label_encode_unseen)


def label_encode_union(spark, d):
    s = _split(spark, d)
    both = _train(s).select("category_code").unionByName(s.where(F.col("is_test") == 1).select("category_code"))
    return pr.fit_label_codes(both, "category_code").select(F.col("value").alias("category_code"), "code")


register("label_encode_union", sql=with_fixtures("""
SELECT value AS category_code, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT coalesce(CAST(category_code AS VARCHAR), 'nan') AS value FROM (
  SELECT category_code FROM account_split WHERE is_test = 0
  UNION ALL SELECT category_code FROM account_split WHERE is_test = 1))""", "account_split"))(label_encode_union)


# T12
def target_encode(spark, d):
    s = _split(spark, d)
    enc, prior = pr.fit_target_encoding(_train(s), "category_code", "labels")
    return pr.apply_target_encoding(s, "category_code", enc, prior).select("id", "category_code", "category_code_te")


register("target_encode", doubles=("category_code_te",), sql=with_fixtures("""
SELECT s.id, s.category_code, coalesce(e.enc, (SELECT avg(labels::DOUBLE) FROM train)) AS category_code_te
FROM account_split s LEFT JOIN (
  SELECT value, CASE WHEN n = 1 THEN prior
                     ELSE prior * (1.0::DOUBLE - 1.0::DOUBLE / (1.0::DOUBLE + exp(-(n - 1) / 1.0::DOUBLE)))
                          + mean * (1.0::DOUBLE / (1.0::DOUBLE + exp(-(n - 1) / 1.0::DOUBLE))) END AS enc
  FROM (SELECT category_code AS value, count(*) AS n, avg(labels::DOUBLE) AS mean,
               (SELECT avg(labels::DOUBLE) FROM train) AS prior
        FROM train GROUP BY category_code)) e ON s.category_code = e.value""", "train"))(target_encode)

# T15
register("class_weights", doubles=("weight",), sql=with_fixtures("""
SELECT labels, sum(n) OVER ()::DOUBLE / (count(*) OVER () * n) AS weight
FROM (SELECT labels, count(*) AS n FROM train GROUP BY labels)""", "train"))(
    lambda spark, d: pr.class_weights(_train(_split(spark, d)), "labels"))


# T16
def pos_weight_q(spark, d):
    tr = _train(_split(spark, d))
    return tr.agg(F.count_if(F.col("labels") == 0).alias("n_negative"),
                  F.count_if(F.col("labels") == 1).alias("n_positive")).withColumn(
        "pos_weight", F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive")))


register("pos_weight", doubles=("pos_weight",), sql=with_fixtures("""
SELECT n_negative, n_positive, CASE WHEN n_positive > 0 THEN n_negative::DOUBLE / n_positive END AS pos_weight
FROM (SELECT CAST(count_if(labels = 0) AS BIGINT) AS n_negative, CAST(count_if(labels = 1) AS BIGINT) AS n_positive FROM train)""",
                                                                      "train"))(pos_weight_q)
