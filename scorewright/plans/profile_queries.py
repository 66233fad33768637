"""Registered queries: profiling (Q1-Q17) and projections / predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nullsafe import all_of, any_of, flag
from ..operators import features as fx
from ..operators import profile as pf
from ..sources.fixtures import ACCOUNT_COLUMNS, account, account_m, scored
from .feature_queries import SCORED_LIST
from .oracle_fixtures import with_fixtures
from .registry import register

NUMERIC = [c for c in ACCOUNT_COLUMNS if c not in ("id", "category_code")]
CORE = ["age_first_funding_year", "age_last_funding_year", "age_first_milestone_year",
        "age_last_milestone_year", "relationships", "funding_rounds", "funding_total_usd",
        "milestones", "avg_participants"]
ENHANCED = CORE + [c for c in fx.SCORED_COLUMNS]
BOX_FEATURES = ["funding_total_usd", "relationships", "milestones", "funding_rounds", "avg_participants"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# Q1
register("table_shape", sql=with_fixtures(
    f"SELECT count(*) AS n_rows, {len(ACCOUNT_COLUMNS)} AS n_columns FROM account", "account"))(
    lambda spark, d: pf.table_shape(account(spark, d)))

# Q2
register("class_balance", doubles=("share",), sql=with_fixtures("""
SELECT labels, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share
FROM account GROUP BY labels""", "account"))(
    lambda spark, d: pf.class_balance(account(spark, d), "labels"))

# Q3
register("null_profile", sql=with_fixtures(
    "SELECT * FROM (" + _union([f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM account"
                                for c in ACCOUNT_COLUMNS])
    + ") WHERE n_null > 0 ORDER BY n_null DESC, column_name LIMIT 10", "account"))(
    lambda spark, d: pf.null_profile(account(spark, d)))

# Q4
register("describe_stats", doubles=("mean", "std", "min", "q25", "q50", "q75", "max"),
         sql=with_fixtures(_union([f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean,
  stddev_samp({c}) AS std, min({c})::DOUBLE AS min, quantile_cont({c}, 0.25)::DOUBLE AS q25,
  quantile_cont({c}, 0.5)::DOUBLE AS q50, quantile_cont({c}, 0.75)::DOUBLE AS q75, max({c})::DOUBLE AS max
FROM account""" for c in NUMERIC]), "account"))(
    lambda spark, d: pf.describe(account_m(spark, d), NUMERIC))


# Q5
def _corr_sql(cols, source, where=""):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = "SELECT " + ", ".join(f'corr({a}::DOUBLE, {b}::DOUBLE) AS "c{i}"' for i, (a, b) in enumerate(pairs)) \
        + f" FROM {source}"
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, \"c{i}\" AS corr, {cols.index(a)} AS ia, {cols.index(b)} AS ib FROM one")
        if a != b:
            rows.append(f"SELECT '{b}' AS column_a, '{a}' AS column_b, \"c{i}\" AS corr, {cols.index(b)} AS ia, {cols.index(a)} AS ib FROM one")
    return one, f"SELECT column_a, column_b, corr FROM ({_union(rows)}) {where}"


_one, _body = _corr_sql(NUMERIC, "account")
register("corr_matrix", doubles=("corr",), sql=with_fixtures(_body, "account", extra=f"one AS ({_one})"))(
    lambda spark, d: pf.corr_long(account_m(spark, d), NUMERIC))

# Q6 (over the enhanced frame: account + Set C)
_one, _body = _corr_sql(ENHANCED, "enh", where="WHERE ia < ib AND corr > 0.8")
register("corr_pairs_high", doubles=("corr",), sql=with_fixtures(
    _body, "account", extra=f"enh AS (SELECT account.*, {SCORED_LIST} FROM account),\none AS ({_one})"))(
    lambda spark, d: pf.corr_pairs_above(fx.derive_scored(account_m(spark, d)), ENHANCED, 0.8))

# Q7
register("hypothesis_median_ratio", doubles=("median_positive", "median_negative", "ratio"),
         sql=with_fixtures("""
SELECT pos AS median_positive, neg AS median_negative, CASE WHEN neg <> 0 THEN pos / neg END AS ratio
FROM (SELECT median(funding_total_usd) FILTER (WHERE labels = 1)::DOUBLE AS pos,
             median(funding_total_usd) FILTER (WHERE labels = 0)::DOUBLE AS neg FROM account)""", "account"))(
    lambda spark, d: pf.median_ratio(account_m(spark, d), "labels", "funding_total_usd"))

# Q8
register("hypothesis_rate_by_flag", doubles=("success_rate",), sql=with_fixtures("""
SELECT CAST(coalesce(is_CA + is_NY + is_MA <> 0, false) AS INTEGER) AS is_innovation_hub,
       count(*) AS n, avg(labels) AS success_rate
FROM account GROUP BY 1""", "account"))(
    lambda spark, d: pf.rate_by_flag(account(spark, d), "labels",
                                     (F.col("is_CA") + F.col("is_NY") + F.col("is_MA")) != 0,
                                     "is_innovation_hub"))

# Q9
register("hypothesis_rate_by_rounds", doubles=("success_rate",), sql=with_fixtures("""
SELECT CAST(coalesce(funding_rounds >= 2, false) AS INTEGER) AS multiple_rounds,
       count(*) AS n, avg(labels) AS success_rate
FROM account GROUP BY 1""", "account"))(
    lambda spark, d: pf.rate_by_flag(account(spark, d), "labels", F.col("funding_rounds") >= 2,
                                     "multiple_rounds"))


# Q10
def _box_sql():
    parts = []
    for f in BOX_FEATURES:
        parts.append(f"""SELECT '{f}' AS feature, q.label, count(a.{f}) AS n, q.q1, q.med AS median, q.q3,
  q.q3 - q.q1 AS iqr,
  min(CASE WHEN a.{f}::DOUBLE >= q.q1 - 1.5::DOUBLE * (q.q3 - q.q1) THEN a.{f}::DOUBLE END) AS whisker_low,
  max(CASE WHEN a.{f}::DOUBLE <= q.q3 + 1.5::DOUBLE * (q.q3 - q.q1) THEN a.{f}::DOUBLE END) AS whisker_high,
  CAST(count_if(a.{f}::DOUBLE < q.q1 - 1.5::DOUBLE * (q.q3 - q.q1) OR a.{f}::DOUBLE > q.q3 + 1.5::DOUBLE * (q.q3 - q.q1)) AS BIGINT) AS n_outliers
FROM account a JOIN (
  SELECT labels AS label, quantile_cont({f}, 0.25)::DOUBLE AS q1, quantile_cont({f}, 0.5)::DOUBLE AS med,
         quantile_cont({f}, 0.75)::DOUBLE AS q3
  FROM account WHERE labels IN (0, 1) GROUP BY labels) q ON a.labels = q.label
GROUP BY q.label, q.q1, q.med, q.q3""")
    return _union(parts)


register("boxplot_stats", doubles=("q1", "median", "q3", "iqr", "whisker_low", "whisker_high"),
         sql=with_fixtures(_box_sql(), "account"))(
    lambda spark, d: pf.boxplot_stats(account_m(spark, d), "labels", BOX_FEATURES))

# Q11
register("histogram_bins", doubles=("bin_low",), sql=with_fixtures("""
SELECT b AS bin, lo + b * width AS bin_low, count(*) AS n
FROM (SELECT CAST(least(floor((funding_total_usd::DOUBLE - w.lo) / w.width), 49) AS INTEGER) AS b, w.lo, w.width
      FROM account, (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0::DOUBLE END AS width
                     FROM (SELECT min(funding_total_usd)::DOUBLE AS lo, max(funding_total_usd)::DOUBLE AS hi FROM account)) w
      WHERE funding_total_usd IS NOT NULL)
GROUP BY b, lo, width""", "account"))(
    lambda spark, d: pf.histogram(account_m(spark, d), "funding_total_usd", 50))

# Q12
register("category_topk", sql=with_fixtures("""
SELECT category_code, count(*) AS n FROM account GROUP BY category_code
ORDER BY n DESC, category_code LIMIT 10""", "account"))(
    lambda spark, d: pf.category_topk(account(spark, d), "category_code", 10))

# Q13
register("probability_summary", doubles=("mean", "std", "min", "max"), sql=with_fixtures("""
SELECT avg(score) AS mean, stddev_pop(score) AS std, min(score) AS min, max(score) AS max FROM scored""",
                                                                                        "scored"))(
    lambda spark, d: pf.probability_summary(scored(spark, d), "score"))

# Q14
register("prediction_share", doubles=("share_positive",), sql=with_fixtures("""
SELECT CAST(sum(CAST(score >= 0.5 AS INTEGER)) AS BIGINT) AS n_positive,
       avg(CAST(score >= 0.5 AS INTEGER)) AS share_positive, count(*) AS n FROM scored""", "scored"))(
    lambda spark, d: pf.prediction_share(
        scored(spark, d).withColumn("prediction", (F.col("score") >= 0.5).cast("int")), "prediction"))

# Q16
_Q_SPECS = {f"{c}_{name}": (c, p) for c in ("funding_total_usd", "relationships", "avg_participants",
                                             "age_last_funding_year")
            for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))}
register("table_quantiles", doubles=("p", "value"), sql=with_fixtures(_union([
    f"SELECT '{n}' AS statistic, '{c}' AS column_name, {p}::DOUBLE AS p, quantile_cont({c}, {p})::DOUBLE AS value FROM account"
    for n, (c, p) in _Q_SPECS.items()]), "account"))(
    lambda spark, d: pf.table_quantiles(account_m(spark, d), _Q_SPECS))

# Q17: agreement between prediction rules over the same ids
_RULES = {"pred_t30": 0.3, "pred_t50": 0.5, "pred_t70": 0.7}


def _agreement(spark, d):
    s = scored(spark, d)
    preds = s.select("label", *[(F.col("score") >= t).cast("int").alias(n) for n, t in _RULES.items()])
    return pf.agreement(preds, list(_RULES) + ["label"])


def _agreement_sql():
    names = list(_RULES) + ["label"]
    inner = "SELECT label, " + ", ".join(f"CAST(score >= {t}::DOUBLE AS INTEGER) AS {n}" for n, t in _RULES.items()) + " FROM scored"
    rows = [f"SELECT '{a}' AS prediction_a, '{b}' AS prediction_b, avg(CAST({a} = {b} AS INTEGER)) AS agreement FROM p"
            for i, a in enumerate(names) for b in names[i + 1:]]
    return with_fixtures(_union(rows), "scored", extra=f"p AS ({inner})")


register("prediction_agreement", doubles=("agreement",), sql=_agreement_sql())(_agreement)


# ------------------------------------------------------------- projections
MANUAL_FEATURES = [
    "total_activity_score", "maturity_funding_interaction", "funding_progression_score",
    "is_mature_startup", "time_to_first_milestone", "funding_relationships_interaction",
    "milestone_duration", "location_success_score", "funding_duration", "is_top_tier_location",
    "has_later_stage", "milestones_per_funding_round", "funding_efficiency"]

# P1
register("project_list", doubles=("maturity_funding_interaction", "time_to_first_milestone",
                                  "milestone_duration", "location_success_score", "funding_duration",
                                  "milestones_per_funding_round", "funding_efficiency"),
         sql=with_fixtures("SELECT id, " + ", ".join(MANUAL_FEATURES) + f" FROM (SELECT id, {SCORED_LIST} FROM account)",
                           "account"))(
    lambda spark, d: fx.derive_scored(account(spark, d)).select("id", *MANUAL_FEATURES))


# The reference's `startswith('is_') or startswith('has_') and c != 'is_othercategory'`
# binds as `is_ or (has_ and ...)`, so is_othercategory stays in; `exclude` is the fix.
def binary_columns(df, exclude=()):
    return [c for c in df.columns if (c.startswith("is_") or c.startswith("has_")) and c not in exclude]


_BIN = [c for c in ACCOUNT_COLUMNS if c.startswith("is_") or c.startswith("has_")]
register("project_prefix", sql=with_fixtures("SELECT id, " + ", ".join(_BIN) + " FROM account", "account"))(
    lambda spark, d: (lambda a: a.select("id", *binary_columns(a)))(account(spark, d)))

# P3
register("project_dtype", doubles=("age_first_funding_year", "age_last_funding_year",
                                   "age_first_milestone_year", "age_last_milestone_year", "avg_participants"),
         sql=with_fixtures("SELECT " + ", ".join(c for c in ACCOUNT_COLUMNS if c != "category_code")
                           + " FROM account", "account"))(
    lambda spark, d: (lambda a: a.select(*pf.numeric_columns(a)))(account(spark, d)))

# P4
register("drop_if_exists", doubles=("age_first_funding_year", "age_last_funding_year",
                                    "age_first_milestone_year", "age_last_milestone_year", "avg_participants"),
         sql=with_fixtures("SELECT * EXCLUDE (category_code, labels) FROM account", "account"))(
    lambda spark, d: account(spark, d).drop("category_code", "labels", "no_such_column"))

# P5
register("filter_by_label", sql=with_fixtures("""
SELECT id, funding_total_usd, is_CA + is_NY + is_MA AS hub FROM account
WHERE labels = 1 AND NOT coalesce(is_CA + is_NY + is_MA <> 0, false)""", "account"))(
    lambda spark, d: account(spark, d)
    .withColumn("hub", F.col("is_CA") + F.col("is_NY") + F.col("is_MA"))
    .where((F.col("labels") == 1) & ~F.coalesce(F.col("hub") != 0, F.lit(False)))
    .select("id", "funding_total_usd", "hub"))


# Comparisons combined with pandas semantics, including negation
def _boolean_flags(spark, d):
    a = account(spark, d)
    mature = all_of(F.col("milestones") >= 2, F.col("funding_rounds") >= 2)
    return a.select(
        "id",
        mature.alias("is_mature"),
        (1 - mature).alias("not_mature"),
        any_of(F.col("milestones") == 0, F.col("relationships") < 3).alias("low_activity"),
        flag(~F.coalesce(F.col("age_first_milestone_year") > 2, F.lit(False))).alias("not_late_milestone"),
        all_of(F.col("has_VC") == 1, F.col("has_roundA") == 1).alias("vc_and_round_a"))


register("boolean_flags", sql=with_fixtures("""
SELECT id,
  CAST(coalesce(milestones >= 2, false) AND coalesce(funding_rounds >= 2, false) AS INTEGER) AS is_mature,
  1 - CAST(coalesce(milestones >= 2, false) AND coalesce(funding_rounds >= 2, false) AS INTEGER) AS not_mature,
  CAST(coalesce(milestones = 0, false) OR coalesce(relationships < 3, false) AS INTEGER) AS low_activity,
  CAST(NOT coalesce(age_first_milestone_year > 2, false) AS INTEGER) AS not_late_milestone,
  CAST(coalesce(has_VC = 1, false) AND coalesce(has_roundA = 1, false) AS INTEGER) AS vc_and_round_a
FROM account""", "account"))(_boolean_flags)

# P9
register("preview_topn", doubles=("avg_participants",), sql=with_fixtures("""
SELECT id, category_code, funding_total_usd, avg_participants, labels FROM account ORDER BY id LIMIT 10""",
                                                                      "account"))(
    lambda spark, d: account(spark, d).orderBy("id").limit(10)
    .select("id", "category_code", "funding_total_usd", "avg_participants", "labels"))

# P10: seeded random rows = smallest md5(id|seed): a top-k, not a full sort
SAMPLE_SEED = 123
register("sample_rows", sql=with_fixtures(f"""
SELECT id, category_code, labels FROM account
ORDER BY md5(CAST(id AS VARCHAR) || '|{SAMPLE_SEED}'), id LIMIT 10""", "account"))(
    lambda spark, d: account(spark, d)
    .orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"|{SAMPLE_SEED}"))), "id").limit(10)
    .select("id", "category_code", "labels"))


# P11
def _schema_sql():
    types = {"id": "bigint", "relationships": "int", "funding_rounds": "int", "funding_total_usd": "bigint",
             "milestones": "int", "category_code": "string", "avg_participants": "double"}
    rows = []
    for i, c in enumerate(ACCOUNT_COLUMNS):
        t = types.get(c, "double" if c.startswith("age_") else "int")
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM account")
    return with_fixtures(_union(rows), "account")


register("schema_report", sql=_schema_sql())(lambda spark, d: pf.schema_report(account(spark, d)))

# P12
ALERT_THRESHOLD = 0.8
register("alert_filter", doubles=("score",), sql=with_fixtures(
    f"SELECT id, score FROM scored WHERE score > {ALERT_THRESHOLD}::DOUBLE", "scored"))(
    lambda spark, d: scored(spark, d).where(F.col("score") > ALERT_THRESHOLD).select("id", "score"))
