"""Registered queries: staged fit with resampling (S-PIPE), the second preprocessing flow
(S-PRE2, S-PRE3), fixed votes, the full report (S-REP), and a stream scored by a saved and
loaded model (R1, S9)."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..operators import features as fx
from ..operators import models as ml
from ..operators import split as sp
from ..operators import stages as st
from ..operators.auto import full_report
from ..session import materialize, scratch_folder
from ..sources import sinks
from ..sources.fixtures import account, doc_quality
from ..sources.tables import table
from ..streaming.scoring import score_alerts
from .model_queries import SPEC
from .oracle_fixtures import with_fixtures
from .registry import register

SOURCES = [f"src{i}" for i in range(20)]       # the driver's sources and languages
LANGUAGES = ["de", "en", "es", "fr"]


def imbalanced(spark, d):
    """Labelled documents (six in seven are good) as numbers and flags, split 80 to 20."""
    rows = doc_quality(spark, d).select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias(ml.LABEL), F.col("n_chars").cast("double").alias("n_chars"),
                                        "toxic", "lang", "source").where("label is not null and id is not null")
    flag = lambda c, v: F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
    rows = rows.withColumns({f"lang_{v}": flag("lang", v) for v in LANGUAGES} | {f"source_{v}": flag("source", v) for v in SOURCES})
    rows = rows.withColumn("toxic", F.coalesce("toxic", F.lit(0))).drop("lang", "source")
    return materialize(sp.stratified_split(materialize(rows), ml.LABEL))


INPUTS = ["n_chars", "toxic", *(f"lang_{v}" for v in LANGUAGES), *(f"source_{v}" for v in SOURCES)]


def staged_pipeline(spark, d, **options):
    """S-PIPE on the hold-out of the imbalanced table."""
    rows = imbalanced(spark, d)
    model = st.imbalanced_pipeline(["n_chars"], INPUTS, **options).fit(rows.where("is_test = 0"))
    return ml.scored_frame(model, rows.where("is_test = 1"))


register("staged_pipeline")(staged_pipeline)

# S-PRE2: medians but for the ages, whose NULL means that nothing has happened; then clip
AGES = ["age_first_funding_year", "age_last_funding_year", "age_first_milestone_year", "age_last_milestone_year"]
NUMBERS = [*AGES, "relationships", "funding_rounds", "funding_total_usd", "milestones", "avg_participants"]
WHOLE = ["funding_total_usd", "relationships", "milestones"]     # whose extremes are kept


def preprocess_advanced(spark, d):
    """S-PRE2, fitted on the training rows and applied to all."""
    rows = materialize(sp.stratified_split(account(spark, d).select("id", "labels", *[F.col(c).cast("double").alias(c) for c in NUMBERS]), "labels"))
    flow = st.StagedPipeline([st.MedianFill(NUMBERS, skip=AGES), st.QuantileClip(NUMBERS, 0.05, 0.95, skip=WHOLE)])
    return flow.fit(rows.where("is_test = 0")).transform(rows).select("id", "is_test", *NUMBERS)


def _preprocess_sql():
    fill = {c: f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM t WHERE is_test = 0))" if c not in AGES else f"{c}::DOUBLE" for c in NUMBERS}
    clip = {c: f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, (SELECT quantile_cont({c}, 0.95) FROM f WHERE is_test = 0)), (SELECT quantile_cont({c}, 0.05) FROM f WHERE is_test = 0)) END"
            if c not in WHOLE else c for c in NUMBERS}
    return with_fixtures(f"""
SELECT id, is_test, {", ".join(f"{e} AS {c}" for c, e in clip.items())} FROM (
  SELECT * FROM f)""", "account_split", extra=f"t AS (SELECT * FROM account_split),\nf AS (SELECT id, is_test, {', '.join(f'{e} AS {c}' for c, e in fill.items())} FROM t)")


register("preprocess_advanced", doubles=tuple(NUMBERS), sql=_preprocess_sql())(preprocess_advanced)


# S-PRE3, and the vote of balanced models on its columns
FLAGS = ["is_CA", "is_NY", "is_MA", "is_TX", "is_otherstate", "has_VC", "has_angel", "has_roundA", "has_roundB", "has_roundC", "has_roundD"]


def clean_frames(spark, d):
    rows = account(spark, d).select("id", "labels", "labels_planted", "category_code", *[F.col(c).cast("double").alias(c) for c in NUMBERS], *FLAGS)
    rows = materialize(sp.stratified_split(rows, "labels"))
    return st.preprocess_clean(rows.where("is_test = 0"), rows.where("is_test = 1"), NUMBERS, ["category_code"])


def preprocess_clean(spark, d):
    train, test = clean_frames(spark, d)
    return train.unionByName(test).select("id", "is_test", "category_code", *NUMBERS)


def _clean_sql():
    numbers = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM train)) AS {c}" for c in NUMBERS)
    return with_fixtures(f"""
SELECT id, is_test, CAST(code AS INTEGER) AS category_code, {", ".join(NUMBERS)} FROM filled JOIN (
  SELECT category_code, row_number() OVER (ORDER BY category_code) - 1 AS code FROM (SELECT DISTINCT category_code FROM filled)) USING (category_code)""",
                         "train", extra=f"""filled AS (SELECT id, is_test, {numbers}, coalesce(category_code, (
  SELECT category_code FROM train WHERE category_code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, category_code LIMIT 1), 'Unknown') AS category_code FROM account_split)""")


register("preprocess_clean", doubles=tuple(NUMBERS), sql=_clean_sql())(preprocess_clean)


def vote_balanced(spark, d):
    """E-VOTE with fixed members: balanced forest, logistic regression and radial SVM on S-PRE3's columns."""
    inputs = ["category_code", *NUMBERS, *FLAGS]
    train, test = (df.withColumn(ml.LABEL, F.col("labels_planted")) for df in clean_frames(spark, d))
    flow = st.StagedPipeline([st.StandardScale(["category_code", *NUMBERS]), VectorAssembler(inputCols=inputs, outputCol="features"), st.Vote(st.BALANCED_VOTE)])
    return ml.scored_frame(flow.fit(materialize(train)), test)


register("vote_balanced")(vote_balanced)


# S-REP: the whole report of a fitted facade
def model_report(spark, d):
    data = fx.derive_scored(account(spark, d)).select("id", "labels_planted", *SPEC.cont, SPEC.cat, *SPEC.bins)
    return full_report(data, "labels_planted", SPEC, models=["random_forest", "logistic_regression", "naive_bayes", "linear_svc"])


register("model_report")(model_report)

# A model fitted on the older half of the events scores the newer half as it arrives
EVENT_INPUTS = ["size", "hour", "k"]
EVENT_THRESHOLD = 0.8


def event_features(events):
    """Features of an event, and the label that the older half has: a value above 100."""
    return events.select(F.col("event_id").alias("id"), "ts", F.log1p(F.coalesce("value", F.lit(0.0))).alias("size"), F.hour("ts").cast("double").alias("hour"),
                         F.get_json_object("props", "$.k").cast("double").alias("k"), F.coalesce((F.col("value") > 100).cast("int"), F.lit(0)).alias(ml.LABEL))


def event_model(history):
    """Fill, scale and Gaussian naive Bayes as one pipeline."""
    return st.StagedPipeline([st.MedianFill(EVENT_INPUTS), st.StandardScale(EVENT_INPUTS),
                              VectorAssembler(inputCols=EVENT_INPUTS, outputCol="features"),
                              Wrapped(NaiveBayes(modelType="gaussian", labelCol=ml.LABEL, featuresCol="features"))]).fit(history)


class Wrapped(st.Estimator):
    """A Spark ML classifier whose fitted model gives ``p1``."""

    def __init__(self, classifier):
        super().__init__()
        self.classifier = classifier

    def _fit(self, df):
        return ml.SparkModel(self.classifier.fit(df))


def halves(spark, d):
    """Events up to the middle of their time span, and those after it."""
    events = table(spark, d, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.select(F.min(at).alias("a"), F.max(at).alias("b")).first()
    middle = F.lit(((span["a"] or 0) + (span["b"] or 0)) // 2)
    return events.where(at <= middle), events.where(at > middle)


def stream_model_alerts(spark, d, threshold=EVENT_THRESHOLD):
    """R1 with a saved and loaded model: alerts of the newer events, file by file."""
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    older, newer = halves(spark, d)
    sinks.save_model(event_model(materialize(event_features(older))), f"{folder}/model")
    newer.repartition(4).write.parquet(f"{folder}/arriving")
    model = sinks.load_model(f"{folder}/model")
    return score_alerts(spark, f"{folder}/arriving", newer.schema, lambda rows: model.transform(event_features(rows)), f"{folder}/alerts", f"{folder}/state",
                        threshold=threshold, prob="p1", max_files_per_trigger=1)


_SCALED = [f"({c} - (SELECT avg({c}) FROM h)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM h)" for c in EVENT_INPUTS]


def _naive_bayes_sql():
    score = lambda y: "ln(n{0}::DOUBLE / (n0 + n1)) + ".format(y) + " + ".join(
        f"(-0.5 * ln(2 * pi() * (v{y}{i} + e)) - 0.5 * (x{i} - m{y}{i}) ** 2 / (v{y}{i} + e))" for i in range(len(EVENT_INPUTS)))
    moments = ", ".join(f"avg(x{i}) FILTER (label = {y}) AS m{y}{i}, var_pop(x{i}) FILTER (label = {y}) AS v{y}{i}" for y in (0, 1) for i in range(len(EVENT_INPUTS)))
    largest = ", ".join(f"var_pop(x{i})" for i in range(len(EVENT_INPUTS)))
    filled = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM r WHERE old)) AS {c}" for c in EVENT_INPUTS)
    return f"""
WITH w AS (SELECT *, epoch_us(ts) <= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) AS old FROM events),
r AS (SELECT event_id AS id, old, ln(1 + coalesce(value, 0.0)) AS size, hour(ts)::DOUBLE AS hour, json_extract_string(props, '$.k')::DOUBLE AS k,
    coalesce((value > 100)::INTEGER, 0) AS label FROM w),
f AS (SELECT id, old, label, {filled} FROM r),
h AS (SELECT * FROM f WHERE old),
s AS (SELECT id, old, label, {", ".join(f"{e} AS x{i}" for i, e in enumerate(_SCALED))} FROM f),
m AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1, 1e-9 * greatest({largest}) AS e, {moments} FROM s WHERE old)
SELECT id, p1 FROM (SELECT id, 1 / (1 + exp(({score(0)}) - ({score(1)}))) AS p1 FROM s, m WHERE NOT old) WHERE p1 > {EVENT_THRESHOLD}"""


register("stream_model_alerts", doubles=("p1",), sql=_naive_bayes_sql())(stream_model_alerts)
