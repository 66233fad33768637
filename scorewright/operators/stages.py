"""Staged fits (S-PIPE, S-PRE2): Spark ML stages with this library's exact statistics, and a
pipeline whose fit may have stages that scoring never sees.

``StagedPipeline`` runs its stages in turn over the training rows.  An estimator is fitted and
its model transforms the rows for the stages behind it; a ``Resampler`` changes the rows of
the fit and leaves nothing behind.  What comes out is a plain ``PipelineModel`` of the fitted
transformers, so synthetic rows exist in the fit alone, whatever is scored later, and the
pipeline is saved and loaded like any other.  ``staged_folds`` fits the whole pipeline anew
outside each fold, so held-out rows reach no statistic, no selection and no synthetic row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import metrics as mx
from . import models as ml
from . import neighbors as nb
from . import prepare as pr
from . import select as fs
from . import split as sp
from .persist import Saved


class Values(Saved):
    """Statistics of columns, applied as literals: ``fill``, ``scale`` or ``clip``."""

    APPLY: Mapping[str, Callable] = {"fill": pr.apply_fill, "scale": pr.apply_standard, "clip": pr.apply_clip}

    def __init__(self, kind: str, values: dict):
        super().__init__()
        self.kind, self.values = kind, values

    def state(self):
        return {"kind": self.kind, "values": self.values}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(state["kind"], state["values"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.APPLY[self.kind](df, self.values)


class _Fit(Estimator):
    """An estimator of statistics of some columns."""

    def __init__(self, cols: Sequence[str], skip: Sequence[str] = ()):
        super().__init__()
        self.cols = [c for c in cols if c not in set(skip)]


class MedianFill(_Fit):
    """Exact medians of ``cols`` but those to ``skip``."""

    def _fit(self, df: DataFrame) -> Values:
        return Values("fill", pr.fit_median(df, self.cols))


class ModeFill(_Fit):
    """The most frequent value, the smallest of several."""

    def _fit(self, df: DataFrame) -> Values:
        return Values("fill", pr.fit_mode(df, self.cols))


class RobustScale(_Fit):
    """(x - median) / (third quartile - first quartile); NULL stays."""

    def _fit(self, df: DataFrame) -> Values:
        return Values("scale", pr.fit_robust(df, self.cols))


class StandardScale(_Fit):
    """(x - mean) / population standard deviation."""

    def _fit(self, df: DataFrame) -> Values:
        return Values("scale", pr.fit_standard(df, self.cols))


class QuantileClip(_Fit):
    """T4, T5: clip to two quantiles."""

    def __init__(self, cols: Sequence[str], lower: float = 0.05, upper: float = 0.95, skip: Sequence[str] = ()):
        super().__init__(cols, skip)
        self.lower, self.upper = lower, upper

    def _fit(self, df: DataFrame) -> Values:
        return Values("clip", pr.fit_clip(df, self.cols, self.lower, self.upper))


class Selected(Saved):
    """The vector narrowed to some positions."""

    def __init__(self, keep: Sequence[int], scores: Mapping[int, float] | None = None):
        super().__init__()
        self.keep, self.scores = list(keep), dict(scores or {})

    def state(self):
        return {"keep": self.keep, "scores": sorted(self.scores.items())}

    @classmethod
    def rebuild(cls, state, parts):
        return cls(state["keep"], dict(state["scores"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        return fs.slice_features(df, self.keep)


class CrossValidatedElimination(Estimator):
    """F-RFECV inside a pipeline: eliminate ``step`` features a round in each of ``folds`` folds,
    take the size of the best mean held-out AUC (fewer features on ties), and eliminate down to
    it on all rows of the fit."""

    def __init__(self, min_features: int = 15, folds: int = 3, step=1, trees: int = 50, key: str = "id"):
        super().__init__()
        self.min_features, self.folds, self.step, self.trees, self.key = min_features, folds, step, trees, key

    def _forest(self, df: DataFrame):
        return ml.fit_model("random_forest", df, numTrees=self.trees)

    def _fit(self, df: DataFrame) -> Selected:
        data = materialize(sp.stratified_kfold(ml.add_weights(df.select(self.key, ml.LABEL, "features")), ml.LABEL, self.key, self.folds))
        width = len(data.select("features").first()["features"])
        sizes = fs.path_sizes(width, min(self.min_features, width), self.step)

        def one(k: int) -> dict[int, float]:
            held, scores = materialize(data.where(F.col("fold") == k)), {}

            def on_model(keep, model):
                scored = materialize(ml.scored_frame(model, fs.slice_features(held, keep), self.key))
                scores[len(keep)] = mx.roc_auc(scored, ml.LABEL, "p1").first()["roc_auc"]

            train = data.where(F.col("fold") != k).drop("w_balanced", "w_pos")
            fs.rfe_path(ml.add_weights(train), width, self._forest, sizes=sizes, on_model=on_model)
            return scores

        per_fold = ml.par_map(one, range(self.folds))
        known = {size: [s[size] for s in per_fold if s.get(size) is not None] for size in sizes}
        mean = {size: sum(v) / len(v) for size, v in known.items() if v}
        best = max(mean, key=lambda size: (mean[size], -size)) if mean else width
        return Selected(fs.rfe_path(data, width, self._forest, sizes=[s for s in sizes if s >= best]), mean)


class Resampler:
    """A stage of the fit alone: ``resample`` gives other rows to the stages behind it."""

    def resample(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


class Smote(Resampler):
    """T17 on the feature vector: synthetic minority rows (negative keys) up to the majority's count."""

    def __init__(self, k: int = 3, key: str = "id"):
        self.k, self.key = k, key

    def resample(self, df: DataFrame) -> DataFrame:
        rows = materialize(df.select(self.key, ml.LABEL, vector_to_array("features").alias("v")))
        grown = nb.smote(rows, key=self.key, vec="v", label=ml.LABEL, k=self.k)
        return materialize(grown.select(self.key, ml.LABEL, array_to_vector("v").alias("features")))


class Vote(Estimator):
    """E-VOTE with fixed members: (model name, parameters) each, probabilities averaged."""

    def __init__(self, members: Sequence[tuple[str, dict]]):
        super().__init__()
        self.members = list(members)

    def _fit(self, df: DataFrame) -> ml.SoftVote:
        rows = materialize(ml.add_weights(df.drop("w_balanced", "w_pos")))
        return ml.SoftVote(ml.par_map(lambda m: ml.fit_model(m[0], rows, **m[1]), self.members))


class StagedPipeline(Estimator):
    """Stages in turn; resamplers act in the fit and are no part of the fitted pipeline."""

    def __init__(self, stages: Sequence):
        super().__init__()
        self.stages = list(stages)

    def _fit(self, df: DataFrame) -> PipelineModel:
        fitted = []
        for i, stage in enumerate(self.stages):
            if isinstance(stage, Resampler):
                df = stage.resample(df)
                continue
            fitted.append(stage if isinstance(stage, Transformer) else stage.fit(df))
            if i + 1 < len(self.stages):
                df = fitted[-1].transform(df)
        return PipelineModel(fitted)


def staged_folds(pipeline: StagedPipeline, data: DataFrame, folds: int, key: str = "id") -> list[tuple[PipelineModel, DataFrame]]:
    """For each fold of ``data`` (with column ``fold``): the pipeline fitted on the other rows,
    and the scored rows of the fold."""
    out = []
    for k in range(folds):
        model = pipeline.fit(data.where(F.col("fold") != k))
        out.append((model, ml.scored_frame(model, data.where(F.col("fold") == k), key)))
    return out


# fixed values: members of the reference's two hand-made votes, in the terms of Spark ML
BOOSTED_VOTE = [
    ("random_forest", {"numTrees": 150, "maxDepth": 12, "minInstancesPerNode": 2}),
    ("gradient_boosting", {"maxIter": 150, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}),
    ("gbt_weighted", {"maxIter": 150, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "weightCol": "w_balanced"}),
]
BALANCED_VOTE = [
    ("random_forest", {"numTrees": 100, "maxDepth": 10}),
    ("logistic_regression", {"weightCol": "w_balanced"}),
    ("rbf_svc", {"weightCol": "w_balanced"}),
]


def preprocess_clean(train: DataFrame, test: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """S-PRE3: modes and medians of the training rows fill both frames; then each category has its
    place among the sorted values of both.  Codes are columns of the category's name."""
    fill = StagedPipeline([ModeFill(categories), MedianFill(numbers)]).fit(train)
    train, test = fill.transform(train), fill.transform(test)
    for c in categories:
        codes = materialize(pr.fit_label_codes(train.select(c).unionByName(test.select(c)), c))
        train, test = (pr.apply_label_codes(df, c, codes, out=f"{c}__place").drop(c).withColumnRenamed(f"{c}__place", c) for df in (train, test))
    return train, test


def imbalanced_pipeline(cols: Sequence[str], inputs: Sequence[str], vote: Sequence[tuple[str, dict]] = BOOSTED_VOTE, *,
                        min_features: int = 15, folds: int = 3, step=1, neighbours: int = 3, key: str = "id") -> StagedPipeline:
    """S-PIPE: robust scale -> median fill -> cross-validated elimination -> SMOTE -> vote."""
    from pyspark.ml.feature import VectorAssembler
    return StagedPipeline([
        RobustScale(cols), MedianFill(cols), VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="keep"),
        CrossValidatedElimination(min_features, folds, step, key=key), Smote(neighbours, key), Vote(vote)])
