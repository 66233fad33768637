"""Automatic classifier facade (fit / predict / evaluate), composed from the
operators: exact split -> fitted preparation -> optional automatic features
(set E) -> optional recursive elimination -> leaderboard of Spark ML models ->
soft vote of the best ``top_n`` or the single best -> hold-out evaluation.

Every flag chosen at fit time is stored and replayed by ``predict`` (the
reference derived features at predict time even when fit had them off).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import load_labeled
from . import features as fx
from . import metrics as mx
from . import models as ml
from . import profile as pf
from . import select as fs
from . import split as sp
from .persist import Saved


class AutoClassifier(Saved):
    """``fit`` returns the object itself; a fitted one can be saved, loaded and used as a
    transformer, which adds ``p1`` and ``prediction``."""

    def __init__(self, spec: ml.FeatureSpec, label: str, *, key: str = "id", test_size: float = 0.2,
                 feature_engineering: bool = False, feature_selection: bool = False, n_select: int = 20, selection_step=1,
                 ensemble: bool = True, top_n: int = 3, models: Sequence[str] = tuple(ml.LEADERBOARD_MODELS),
                 refit_full: bool = False, seed: int = 42):
        super().__init__()
        self.spec, self.label, self.key = spec, label, key
        self.test_size, self.seed = test_size, seed
        self.feature_engineering, self.feature_selection, self.n_select = feature_engineering, feature_selection, n_select
        self.selection_step = selection_step
        self.ensemble, self.top_n, self.models = ensemble, top_n, list(models)
        self.refit_full = refit_full

    # -- persistence --------------------------------------------------------
    OPTIONS = ("key", "test_size", "feature_engineering", "feature_selection", "n_select", "selection_step", "ensemble", "top_n", "models", "refit_full", "seed")
    FITTED = ("auto_inputs", "names", "keep", "leaderboard_rows", "metrics")

    def state(self):
        return {"spec": asdict(self.spec), "label": self.label, "options": {k: getattr(self, k) for k in self.OPTIONS},
                "fitted": {k: getattr(self, k) for k in self.FITTED}}

    def parts(self):
        return {"prep": self.prep, "model": self.model}

    @classmethod
    def rebuild(cls, state, parts):
        out = cls(ml.FeatureSpec(**state["spec"]), state["label"], **state["options"])
        for k, v in (state["fitted"] | parts).items():
            setattr(out, k, v)
        out.leaderboard_rows = [tuple(r) for r in out.leaderboard_rows]
        return out

    # -- helpers -----------------------------------------------------------
    def _derive(self, df: DataFrame) -> DataFrame:
        if not self.feature_engineering:
            return df
        return fx.derive_auto(df, columns=self.auto_inputs)

    def _features(self, df: DataFrame) -> DataFrame:
        out = self.prep.transform(self._derive(df))
        if self.keep is not None:
            out = fs.slice_features(out, self.keep)
        return out

    # -- API ---------------------------------------------------------------
    def fit(self, df: DataFrame) -> "AutoClassifier":
        data = df.withColumn(ml.LABEL, F.col(self.label).cast("int"))
        split = materialize(sp.stratified_split(data, ml.LABEL, self.key, self.test_size, self.seed))
        train, test = split.where(F.col("is_test") == 0), split.where(F.col("is_test") == 1)
        spec = self.spec
        self.auto_inputs = [c for c in fx.auto_numeric_columns(train) if c in set(spec.cont)]
        if self.feature_engineering:
            extra = [c for c in self._derive(train).columns if c not in train.columns]
            spec = ml.FeatureSpec(cont=list(spec.cont) + extra, bins=spec.bins, cat=spec.cat)
        self.prep = ml.fit_preparation(self._derive(train), spec)
        self.names = self.prep.names
        self.keep = None
        keep_cols = [self.key, ml.LABEL, "features"]
        tr = materialize(ml.add_weights(self.prep.transform(self._derive(train)).select(*keep_cols)))
        if self.feature_selection:
            self.keep = fs.rfe(tr, self.names, lambda d: ml.fit_model("random_forest", d, numTrees=50),
                               min(self.n_select, len(self.names)), self.selection_step)
            tr = materialize(fs.slice_features(tr, self.keep))
            self.names = [self.names[i] for i in self.keep]
        te = materialize(self._features(test).select(*keep_cols))
        rows, fitted = [], {}
        for name in self.models:
            m = ml.fit_model(name, tr)
            fitted[name] = m
            res = ml.evaluate(ml.scored_frame(m, te, self.key))
            rows.append((name, res["accuracy"], res["f1"], res["roc_auc"]))
        rows.sort(key=lambda r: (-(r[3] if r[3] is not None else -1.0), r[0]))
        self.leaderboard_rows = rows
        chosen = [r[0] for r in rows[: self.top_n]] if self.ensemble else [rows[0][0]]
        if self.refit_full:   # refit the chosen models on all labelled rows before scoring
            full = materialize(ml.add_weights(self._features(split).select(*keep_cols)))
            fitted = {n: ml.fit_model(n, full) for n in chosen}
        members = [fitted[n] for n in chosen]
        self.model = ml.SoftVote(members) if self.ensemble else members[0]
        self.metrics = ml.evaluate(ml.scored_frame(self.model, te, self.key))
        return self

    def leaderboard(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.leaderboard_rows, "model string, accuracy double, f1 double, roc_auc double") \
            .orderBy(F.desc("roc_auc"), F.asc("model"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self._features(df))

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self._features(df)).select(self.key, "p1")

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.predict_proba(df).select(self.key, (F.col("p1") >= threshold).cast("int").alias("prediction"))


def create_best_classifier(spark: SparkSession, source, target: str, spec: ml.FeatureSpec, **kw) -> AutoClassifier:
    """Path or DataFrame with a named target (which must exist) -> fitted facade."""
    return AutoClassifier(spec, target, **kw).fit(load_labeled(spark, source, target))


def evaluate_model(model: AutoClassifier, df: DataFrame, label: str) -> dict:
    """Metrics of a fitted facade on labelled data."""
    scored = model.predict_proba(df).join(df.select(model.key, F.col(label).cast("int").alias(ml.LABEL)), model.key)
    scored = scored.withColumn("prediction", (F.col("p1") >= 0.5).cast("int"))
    return ml.evaluate(scored)


def full_report(data: DataFrame, label: str, spec: ml.FeatureSpec, *, key: str = "id", test_size: float = 0.2, top: int = 15, **options) -> DataFrame:
    """S-REP: hold out, fit the facade on the rest, and report on the held rows as (section,
    name, value): sizes, class balance, metrics, confusion matrix, classification report,
    probabilities and the largest importances."""
    spark = data.sparkSession
    rows = materialize(sp.stratified_split(data.withColumn(ml.LABEL, F.col(label).cast("int")), ml.LABEL, key, test_size, seed=7))
    train, test = (rows.where(F.col("is_test") == t).drop("is_test") for t in (0, 1))
    auto = AutoClassifier(spec, label, key=key, **options).fit(train)
    scored = materialize(ml.scored_frame(auto, test, key))
    out = [("size", "train", train.count()), ("size", "test", test.count()), ("size", "features", len(auto.names))]
    for name, part in (("train", train), ("test", test)):
        out += [(f"balance {name}", str(r[ml.LABEL]), r["count"]) for r in part.groupBy(ml.LABEL).count().orderBy(ml.LABEL).collect()]
    out += [("metric", k, v) for k, v in ml.evaluate(scored).items()]
    confusion = mx.confusion_matrix(scored, ml.LABEL, "prediction")
    out += [("confusion", " ".join(f"{c}={r[c]}" for c in confusion.columns[:-1]), r[-1]) for r in confusion.collect()]
    report = mx.classification_report(scored, ml.LABEL, "prediction").collect()
    out += [(f"class {r['class']}", c, r[c]) for r in report for c in ("precision", "recall", "f1", "support") if r[c] is not None]
    summary = pf.probability_summary(scored, "p1").first()
    out += [("probability", c, summary[c]) for c in ("mean", "std", "min", "max")]
    ranked = sorted(zip(auto.model.importances(len(auto.names)), auto.names), key=lambda x: (-x[0], x[1]))
    out += [("importance", name, value) for value, name in ranked[:top]]
    return spark.createDataFrame([(s, n, None if v is None else float(v)) for s, n, v in out], "section string, name string, value double")
