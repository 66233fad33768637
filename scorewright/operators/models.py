"""Spark ML estimators, tuning, ensembles, feature selection and importance.

Every model exposes ``transform(df) -> df`` adding ``p1`` (probability of the
positive class) and ``prediction``.  Training data is prepared once by
``fit_preparation`` (exact median imputation and population-std scaling of the
continuous columns, alphabetical one-hot of the category, flags passed through)
and the fitted preparation is applied unchanged to validation and scoring data.
Cross-validation fits it, and the class weights, anew outside each fold.
Metrics come from ``operators.metrics`` (exact AUC with ties), not from the
binned ML evaluator.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import metrics as mx
from . import neighbors as nb
from . import prepare as pr
from .persist import Saved, in_order, numbered

SEED = 42
LABEL = "label"
PARALLELISM = 4
ROWS_A_TASK = 65_536


def par_map(fn, items, parallelism: int = PARALLELISM):
    """Run independent fits concurrently from driver threads (as
    ``CrossValidator(parallelism=...)`` does); results keep the input order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def parts_of(df: DataFrame, fits: int = PARALLELISM) -> int:
    """Partitions for one of ``fits`` concurrent fits: its share of the cores, more where one
    would hold over ``ROWS_A_TASK`` rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-cores // fits), -(-df.count() // ROWS_A_TASK))


def packed(df: DataFrame, fits: int = PARALLELISM) -> DataFrame:
    """The rows of a stored table in no more partitions than that: every partition of a fit
    costs a task in each of its jobs, and a histogram of each open node of its trees."""
    return df.coalesce(parts_of(df, fits))


# ------------------------------------------------------------- preparation
@dataclass
class FeatureSpec:
    cont: list[str]
    bins: list[str]
    cat: str | None = None


@dataclass(eq=False)
class Preparation(Saved):
    spec: FeatureSpec
    medians: dict
    scaling: dict
    encoder: PipelineModel
    names: list[str] = field(default_factory=list)

    def __post_init__(self):
        super().__init__()

    def state(self):
        return {"spec": asdict(self.spec), "medians": self.medians, "scaling": self.scaling, "names": self.names}

    def parts(self):
        return {"encoder": self.encoder}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(FeatureSpec(**state["spec"]), state["medians"], state["scaling"], parts["encoder"], state["names"])

    def _transform(self, df: DataFrame) -> DataFrame:
        x = pr.apply_standard(pr.apply_fill(df, self.medians), self.scaling)
        return self.encoder.transform(x)


def fit_preparation(train: DataFrame, spec: FeatureSpec) -> Preparation:
    med = pr.fit_median(train, spec.cont)
    filled = pr.apply_fill(train, med)
    scaling = pr.fit_standard(filled, spec.cont)
    scaled = pr.apply_standard(filled, scaling)
    stages, inputs = [], list(spec.cont)
    if spec.cat:
        stages += [StringIndexer(inputCol=spec.cat, outputCol="_cat_idx", handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol="_cat_idx", outputCol="_cat_vec", dropLast=True)]
        inputs.append("_cat_vec")
    inputs += list(spec.bins)
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    enc = Pipeline(stages=stages).fit(scaled)
    prep = Preparation(spec, med, scaling, enc)
    prep.names = feature_names(prep)
    return prep


def feature_names(prep: Preparation) -> list[str]:
    """Output names (continuous, one-hot, flags), in vector order."""
    names = list(prep.spec.cont)
    if prep.spec.cat:
        labels = prep.encoder.stages[0].labels
        names += [f"{prep.spec.cat}_{v}" for v in labels]
    return names + list(prep.spec.bins)


# ------------------------------------------------------------------ models
def _p1(df: DataFrame) -> DataFrame:
    return df.withColumn("p1", vector_to_array("probability")[1])


class SparkModel(Saved):
    """A Spark ML classifier with ``p1`` in place of its vectors."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def parts(self):
        return {"model": self.model}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(parts["model"])

    def _transform(self, df):
        return _p1(self.model.transform(df)).drop("rawPrediction", "probability")

    def importances(self, n):
        m = self.model
        if hasattr(m, "featureImportances"):
            return list(m.featureImportances.toArray())
        if hasattr(m, "coefficients"):
            return [abs(v) for v in m.coefficients.toArray()]
        return [0.0] * n


class CalibratedSVC(Saved):
    """Linear SVM margin + Platt scaling (logistic regression on the margin)."""

    def __init__(self, svc, platt):
        super().__init__()
        self.svc, self.platt = svc, platt

    def parts(self):
        return {"svc": self.svc, "platt": self.platt}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(parts["svc"], parts["platt"])

    def _transform(self, df):
        m = self.svc.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
        m = m.drop("rawPrediction", "prediction").withColumn(
            "_mvec", F.array("_margin"))
        m = m.withColumn("_mvec", array_to_vector("_mvec"))
        out = self.platt.transform(m.withColumnRenamed("features", "_features").withColumnRenamed("_mvec", "features"))
        out = _p1(out).drop("rawPrediction", "probability", "features", "_margin")
        return out.withColumnRenamed("_features", "features")

    def importances(self, n):
        return [abs(v) for v in self.svc.coefficients.toArray()]


class FourierFeatures(Saved):
    """Random Fourier features of the kernel exp(-gamma |x - y|^2): the inner product of two
    rows' vectors approximates it.  A column transform; weights come from the seed."""

    def __init__(self, width: int, gamma: float, size: int, seed: int = SEED):
        super().__init__()
        self.width, self.gamma, self.size, self.seed = width, gamma, size, seed

    def state(self):
        return {"width": self.width, "gamma": self.gamma, "size": self.size, "seed": self.seed}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(**state)

    def _transform(self, df):
        rng = np.random.default_rng(self.seed)
        weight = rng.normal(0.0, math.sqrt(2 * self.gamma), (self.width, self.size))
        shift = rng.uniform(0.0, 2 * math.pi, self.size)

        @F.pandas_udf("array<double>")
        def waves(x: pd.Series) -> pd.Series:
            out = np.cos(np.stack(x.to_numpy()) @ weight + shift) * math.sqrt(2 / self.size) if len(x) else []
            return pd.Series(list(out))

        return df.withColumn("features", array_to_vector(waves(vector_to_array("features"))))


class CubicFeatures(FourierFeatures):
    """Random features of the kernel (gamma x.y)^3: products of three signed sums, whose inner
    product has the kernel as its mean."""

    def _transform(self, df):
        signs = np.random.default_rng(self.seed).choice([-1.0, 1.0], (3, self.width, self.size))

        @F.pandas_udf("array<double>")
        def products(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([])
            rows = np.stack(x.to_numpy())
            out = (rows @ signs[0]) * (rows @ signs[1]) * (rows @ signs[2])
            return pd.Series(list(out * math.sqrt(self.gamma ** 3 / self.size)))

        return df.withColumn("features", array_to_vector(products(vector_to_array("features"))))


def fit_fourier(train: DataFrame, size: int = 256, seed: int = SEED, gamma: str = "scale", kind=FourierFeatures) -> FourierFeatures:
    """``gamma`` = 1 / (width * variance of all elements), as scikit-learn's 'scale', or
    1 / width ('auto')."""
    x = vector_to_array("features")
    r = train.select(F.size(x).alias("n"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("s"),
                     F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("q")).agg(F.sum("n").alias("n"), F.max("n").alias("w"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    variance = r["q"] / r["n"] - (r["s"] / r["n"]) ** 2
    scale = 1.0 / (r["w"] * variance) if variance > 0 else 1.0
    return kind(r["w"], 1.0 / r["w"] if gamma == "auto" else scale, size, seed)


class KernelSVC(Saved):
    """Support vectors with a radial kernel: Fourier features before the calibrated linear SVM."""

    def __init__(self, kernel: FourierFeatures, svc: CalibratedSVC):
        super().__init__()
        self.kernel, self.svc = kernel, svc

    def parts(self):
        return {"kernel": self.kernel, "svc": self.svc}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(parts["kernel"], parts["svc"])

    def _transform(self, df):
        out = self.svc.transform(self.kernel.transform(df.withColumn("_plain", F.col("features"))))
        return out.drop("features").withColumnRenamed("_plain", "features")

    def importances(self, n):
        return [0.0] * n  # the weights belong to waves, not to inputs


def _row_vectors(df: DataFrame) -> DataFrame:
    """Rows numbered for the neighbour join, so null and repeated keys go as others."""
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_v", vector_to_array("features")))


class Neighbours:
    """k-NN vote over the training rows (exact join)."""

    def __init__(self, train: DataFrame, k: int = 5, weights: str = "uniform"):
        self.rows, self.k, self.weights = _row_vectors(train), k, weights

    def transform(self, df: DataFrame) -> DataFrame:
        rows = _row_vectors(df)
        votes = nb.knn_classify(self.rows, rows, self.k, key="_row", vec="_v", label=LABEL, weights=self.weights)
        return rows.join(votes, "_row", "left").drop("_row", "_v")

    def importances(self, n):
        return [0.0] * n


class AdaBoost(Saved):
    """SAMME with depth-1 trees: reweight misclassified rows by exp(alpha)."""

    def __init__(self, stumps, alphas):
        super().__init__()
        self.stumps, self.alphas = stumps, alphas

    def state(self):
        return {"alphas": self.alphas}

    def parts(self):
        return numbered(self.stumps)

    @classmethod
    def rebuild(cls, state, parts):
        return cls(in_order(parts), state["alphas"])

    def _transform(self, df):
        total = sum(self.alphas) or 1.0
        out = df.withColumn("_d", F.lit(0.0))
        for i, (s, a) in enumerate(zip(self.stumps, self.alphas)):
            pred = s.transform(out).select(*out.columns, F.col("prediction").alias("_h"))
            out = pred.withColumn("_d", F.col("_d") + F.lit(a) * (2 * F.col("_h") - 1)).drop("_h")
        d = F.col("_d") / F.lit(total)
        return (out.withColumn("p1", F.lit(1.0) / (F.lit(1.0) + F.exp(-d)))
                .withColumn("prediction", (F.col("_d") > 0).cast("double")).drop("_d"))

    def importances(self, n):
        acc = [0.0] * n
        total = sum(self.alphas) or 1.0
        for s, a in zip(self.stumps, self.alphas):
            for i, v in enumerate(s.featureImportances.toArray()):
                acc[i] += a * v / total
        return acc


def fit_adaboost(train: DataFrame, n_estimators: int = 50, learning_rate: float = 1.0,
                 checkpoint_every: int = 5) -> AdaBoost:
    n = train.count()
    w = train.withColumn("_w", F.lit(1.0 / n))
    stumps, alphas = [], []
    for m in range(n_estimators):
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="_w", labelCol=LABEL, seed=SEED).fit(w)
        scored = stump.transform(w).withColumn("_miss", (F.col("prediction") != F.col(LABEL)).cast("double"))
        r = scored.agg(F.sum(F.col("_w") * F.col("_miss")).alias("e"), F.sum("_w").alias("t")).first()
        err = (r["e"] or 0.0) / r["t"]
        if err >= 0.5:
            if not stumps:
                stumps, alphas = [stump], [1.0]
            break
        if err <= 0:
            stumps.append(stump)
            alphas.append(1.0)
            break
        alpha = learning_rate * math.log((1 - err) / err)
        stumps.append(stump)
        alphas.append(alpha)
        # new total = correct weight + missed weight * e^alpha, known from the same aggregate
        total = (r["t"] - (r["e"] or 0.0)) + (r["e"] or 0.0) * math.exp(alpha)
        w = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss")) / F.lit(total)) \
            .drop("_miss", "prediction", "rawPrediction", "probability")
        if (m + 1) % checkpoint_every == 0:
            w = materialize(w)   # reliable checkpoint: bounded lineage, survives executor loss
    return AdaBoost(stumps, alphas)


def make_estimator(name: str, n_train: int, **params):
    """Spark counterparts of the reference's classifiers (see README for gaps)."""
    common = dict(labelCol=LABEL, featuresCol="features")
    if name == "random_forest":
        return RandomForestClassifier(numTrees=params.get("numTrees", 100), maxDepth=params.get("maxDepth", 10),
                                      minInstancesPerNode=params.get("minInstancesPerNode", 1),
                                      weightCol=params.get("weightCol", "w_balanced"), seed=SEED, **common)
    if name == "extra_trees":
        return RandomForestClassifier(numTrees=100, maxDepth=10, bootstrap=False, featureSubsetStrategy="sqrt",
                                      weightCol="w_balanced", seed=SEED, **common)
    if name == "gradient_boosting":
        return GBTClassifier(maxIter=params.get("maxIter", 100), maxDepth=params.get("maxDepth", 3),
                             stepSize=params.get("stepSize", 0.1), subsamplingRate=params.get("subsamplingRate", 1.0),
                             featureSubsetStrategy=params.get("featureSubsetStrategy", "all"), seed=SEED, **common)
    if name == "gbt_weighted":
        return GBTClassifier(maxIter=params.get("maxIter", 150), maxDepth=params.get("maxDepth", 6),
                             stepSize=params.get("stepSize", 0.1), subsamplingRate=params.get("subsamplingRate", 0.8),
                             featureSubsetStrategy=params.get("featureSubsetStrategy", "0.8"),
                             weightCol=params.get("weightCol", "w_pos"), seed=SEED, **common)
    if name == "logistic_regression":
        c, weight = params.get("C", 1.0), params.get("weightCol")
        return LogisticRegression(maxIter=1000, regParam=1.0 / (c * max(n_train, 1)), elasticNetParam={"l2": 0.0, "l1": 1.0}[params.get("penalty", "l2")],
                                  standardization=False, **common, **({"weightCol": weight} if weight else {}))
    if name == "decision_tree":
        return DecisionTreeClassifier(maxDepth=params.get("maxDepth", 30), seed=SEED, **common)
    if name == "naive_bayes":
        return NaiveBayes(modelType="gaussian", **common)
    raise ValueError(name)


MODEL_NAMES = ["random_forest", "extra_trees", "gradient_boosting", "gbt_weighted", "logistic_regression",
               "linear_svc", "rbf_svc", "decision_tree", "naive_bayes", "ada_boost"]
LEADERBOARD_MODELS = ["random_forest", "gradient_boosting", "logistic_regression", "linear_svc",
                      "decision_tree", "naive_bayes", "ada_boost"]


def add_weights(train: DataFrame) -> DataFrame:
    cw = pr.class_weights(train, LABEL).withColumnRenamed("weight", "w_balanced")
    pw = pr.pos_weight(train, LABEL)
    return pr.apply_pos_weight(pr.apply_class_weights(train, LABEL, cw, "w_balanced"), LABEL, pw, "w_pos")


@dataclass
class Fold:
    """One cross-validation fold: preparation and class weights are fitted on ``train``
    (the rows outside the fold) only, and applied to ``held``."""
    number: int
    prep: Preparation
    train: DataFrame
    held: DataFrame


def fit_folds(data: DataFrame, spec: FeatureSpec, folds: int, fold_col: str = "fold", key: str = "id") -> list[Fold]:
    """Folds of unprepared rows, each with its own preparation; stored once for all fits."""
    def one(k: int) -> Fold:
        train, held = data.where(F.col(fold_col) != k), data.where(F.col(fold_col) == k)
        prep = fit_preparation(train, spec)
        keep = [key, LABEL, "features"]
        return Fold(k, prep, materialize(add_weights(prep.transform(train).select(*keep))),
                    materialize(prep.transform(held).select(*keep)))

    return par_map(one, range(folds))


def fit_model(name: str, train: DataFrame, **params):
    """``train`` has ``features``, ``label`` and the weight columns."""
    n = train.count() if name in ("linear_svc", "logistic_regression") else 0  # their penalty depends on it
    if name == "ada_boost":
        return fit_adaboost(train, params.get("n_estimators", 50))
    if name == "knn":
        return Neighbours(train, **params)
    if name == "svm":
        kernel, gamma = params.pop("kernel", "rbf"), params.pop("gamma", "scale")
        return fit_model("linear_svc", train, **params) if kernel == "linear" else \
            fit_model("rbf_svc", train, gamma=gamma, kind={"rbf": FourierFeatures, "poly": CubicFeatures}[kernel], **params)
    if name == "rbf_svc":
        kernel = fit_fourier(train, params.get("size", 256), gamma=params.get("gamma", "scale"), kind=params.get("kind", FourierFeatures))
        return KernelSVC(kernel, fit_model("linear_svc", materialize(kernel.transform(train)), **params))
    if name == "linear_svc":
        weight = {"weightCol": params["weightCol"]} if params.get("weightCol") else {}
        svc = LinearSVC(maxIter=100, regParam=1.0 / (params.get("C", 1.0) * max(n, 1)), labelCol=LABEL, featuresCol="features", **weight).fit(train)
        margin = svc.transform(train).select(LABEL, vector_to_array("rawPrediction")[1].alias("_m"))
        platt = LogisticRegression(labelCol=LABEL, featuresCol="features").fit(
            margin.select(LABEL, array_to_vector(F.array("_m")).alias("features")))
        return CalibratedSVC(svc, platt)
    return SparkModel(make_estimator(name, n, **params).fit(train))


# ------------------------------------------------------- frames and scoring
def scored_frame(model, df: DataFrame, key: str = "id") -> DataFrame:
    return model.transform(df).select(key, LABEL, "p1", F.col("prediction").cast("int").alias("prediction"))


def evaluate(scored: DataFrame) -> dict:
    """accuracy / precision / recall / f1 at the model's own prediction, exact AUC and AP.

    The scored frame is checkpointed once so the metric passes do not re-run the model."""
    scored = materialize(scored)
    m = mx.binary_metrics(scored, LABEL, "prediction").first()
    auc = mx.roc_auc(scored, LABEL, "p1").first()["roc_auc"]
    ap = mx.average_precision(scored, LABEL, "p1").first()["average_precision"]
    return {"accuracy": m["accuracy"], "precision": m["precision"], "recall": m["recall"], "f1": m["f1"],
            "roc_auc": auc, "average_precision": ap}


def fold_score(name: str, fold: Fold, params: dict) -> dict:
    res = evaluate(scored_frame(fit_model(name, fold.train, **params), fold.held))
    res["fold"] = fold.number
    return res


def fold_auc(name: str, fold: Fold, params: dict) -> float:
    """``fold_score``'s AUC alone: of the metrics, searches and the leaderboard read no other."""
    scored = materialize(scored_frame(fit_model(name, fold.train, **params), fold.held))
    return mx.roc_auc(scored, LABEL, "p1").first()["roc_auc"]


def cv_scores(name: str, folds: Sequence[Fold], parallelism: int = PARALLELISM, **params) -> list[dict]:
    """One fit per fold (folds fitted concurrently); every metric from the same
    held-out scored frame."""
    return par_map(lambda fold: fold_score(name, fold, params), folds, parallelism)


# ---------------------------------------------------------------- tuning
def grid(space: dict) -> list[dict]:
    combos = [{}]
    for k, vs in space.items():
        combos = [dict(c, **{k: v}) for c in combos for v in vs]
    return combos


def search(name: str, folds: Sequence[Fold], combos: Sequence[dict], parallelism: int = PARALLELISM) -> list[dict]:
    """Mean CV AUC for every parameter combination (grid or seeded random sample);
    all (candidate, fold) fits run concurrently."""
    combos = list(combos)
    tasks = [(i, fold) for i in range(len(combos)) for fold in folds]
    res = par_map(lambda t: fold_auc(name, t[1], combos[t[0]]), tasks, parallelism)
    rows = []
    for i, params in enumerate(combos):
        scores = [r for (ci, _k), r in zip(tasks, res) if ci == i]
        mean = sum(scores) / len(scores)
        std = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
        rows.append({"candidate": i, "params": ", ".join(f"{k}={v}" for k, v in params.items()),
                     "mean_auc": mean, "std_auc": std})
    return rows


def knn_aucs(fold: Fold, combos: Sequence[dict]) -> list[float | None]:
    """``fold_auc`` of each kNN setting, all from one neighbour join."""
    train, held = _row_vectors(fold.train), _row_vectors(fold.held)
    votes = nb.knn_settings(train, held, sorted({c["k"] for c in combos}), key="_row", vec="_v", label=LABEL)
    scored = materialize(votes.join(held.select("_row", LABEL), "_row"))
    auc = {(r["k"], r["weights"]): r["roc_auc"] for r in mx.roc_auc_by(scored, ["k", "weights"], LABEL, "p1").collect()}
    return [auc.get((c["k"], c["weights"])) for c in combos]


def tune(folds: Sequence[Fold], candidates: dict[str, list[dict]], parallelism: int = PARALLELISM) -> dict[str, tuple[dict, float | None]]:
    """(params, mean held-out AUC) of the best candidate of each model, the first of several;
    all fits run concurrently."""
    packs = [replace(fold, train=packed(fold.train)) for fold in folds]
    joined = {name for name, combos in candidates.items() if name == "knn" and combos != [{}]}
    tasks = [(name, None if name in joined else i, k) for name, combos in candidates.items()
             for i in range(1 if name in joined else len(combos)) for k in range(len(folds))]

    def one(task):
        name, i, k = task
        if i is None:
            return knn_aucs(folds[k], candidates[name])
        return [fold_auc(name, packs[k], candidates[name][i])]

    scores: dict[tuple[str, int], list] = {}
    for (name, i, _), found in zip(tasks, par_map(one, tasks, parallelism)):
        for j, auc in enumerate(found):
            scores.setdefault((name, (i or 0) + j), []).append(auc)
    best = {}
    for name, combos in candidates.items():
        means = [None if None in scores[name, i] else sum(scores[name, i]) / len(folds) for i in range(len(combos))]
        at = max(range(len(combos)), key=lambda i: (means[i] is not None, means[i] or 0.0, -i))
        best[name] = (combos[at], means[at])
    return best


def random_sample(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    rng = random.Random(seed)
    all_ = grid(space)
    return rng.sample(all_, min(n_iter, len(all_)))


# ------------------------------------------------------------- ensembles
class SoftVote(Saved):
    """Mean positive-class probability of the member models."""

    def __init__(self, members):
        super().__init__()
        self.members = members

    def parts(self):
        return numbered(self.members)

    @classmethod
    def rebuild(cls, state, parts):
        return cls(in_order(parts))

    def _transform(self, df):
        out = df
        cols = []
        for i, m in enumerate(self.members):
            res = m.transform(out)
            out = res.withColumnRenamed("p1", f"_p{i}").drop("prediction")
            cols.append(f"_p{i}")
        mean = sum((F.col(c) for c in cols), F.lit(0.0)) / len(cols)
        return out.withColumn("p1", mean).withColumn("prediction", (F.col("p1") >= 0.5).cast("double")).drop(*cols)

    def importances(self, n):
        imps = [m.importances(n) for m in self.members]
        return [sum(v[i] for v in imps) / len(imps) for i in range(n)]
