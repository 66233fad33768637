"""Registered queries: estimators, leaderboard, ensembles, CV, tuning, importance.

No DuckDB twins but for ``feature_names`` (model fits are not SQL); tests check invariants instead.
The target is ``labels_planted`` (separable by construction, FIXTURES.md 2.1)
so that the models have something to learn; ``labels`` is near noise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import features as fx
from ..operators import metrics as mx
from ..operators import models as ml
from ..operators import select as fs
from ..functions.ranks import hash_key, hashed_rank
from ..operators import split as sp
from ..session import materialize
from ..sources.fixtures import account_m
from .oracle_fixtures import with_fixtures
from .registry import register

TARGET = "labels_planted"
CONT = ["age_first_funding_year", "age_last_funding_year", "age_first_milestone_year", "age_last_milestone_year",
        "relationships", "funding_rounds", "funding_total_usd", "milestones", "avg_participants",
        "milestones_per_funding_round", "avg_funding_per_round", "relationships_per_milestone",
        "funding_duration", "milestone_duration", "funding_efficiency", "location_success_score",
        "sector_success_score", "maturity_funding_interaction"]
BINS = ["is_CA", "is_NY", "is_MA", "is_TX", "is_otherstate", "is_software", "is_web", "is_mobile",
        "is_enterprise", "is_advertising", "is_gamesvideo", "is_ecommerce", "is_biotech", "is_consulting",
        "is_othercategory", "has_VC", "has_angel", "has_roundA", "has_roundB", "has_roundC", "has_roundD"]
SPEC = ml.FeatureSpec(cont=CONT, bins=BINS, cat="category_code")


class ModelData:
    def __init__(self, spark, d, folds=5):
        acc = fx.derive_scored(account_m(spark, d)).withColumn(ml.LABEL, F.col(TARGET).cast("int"))
        split = materialize(sp.stratified_split(acc, ml.LABEL))
        train = materialize(sp.stratified_kfold(split.where(F.col("is_test") == 0), ml.LABEL, k=folds))
        test = split.where(F.col("is_test") == 1)
        self.prep = ml.fit_preparation(train, SPEC)
        keep = ["id", ml.LABEL, "features"]
        self.train = materialize(ml.add_weights(self.prep.transform(train).select(*keep)))
        self.test = materialize(self.prep.transform(test).select(*keep))
        self.train_raw, self.test_raw, self.n_folds = train, test, folds
        self.names = self.prep.names

    @cached_property
    def folds(self) -> list[ml.Fold]:
        return ml.fit_folds(self.train_raw, SPEC, self.n_folds)


def _model_query(name):
    def run(spark, d):
        md = ModelData(spark, d)
        return ml.scored_frame(ml.fit_model(name, md.train), md.test)
    return run


for _key, _name in [("model_random_forest", "random_forest"), ("model_extra_trees", "extra_trees"),
                    ("model_gbt", "gradient_boosting"), ("model_gbt_weighted", "gbt_weighted"),
                    ("model_logreg", "logistic_regression"), ("model_linear_svc", "linear_svc"),
                    ("model_decision_tree", "decision_tree"), ("model_naive_bayes", "naive_bayes"),
                    ("model_adaboost", "ada_boost"), ("model_rbf_svc", "rbf_svc")]:
    register(_key)(_model_query(_name))


# Random-search space of the reference leaderboard for the forest (max_depth None -> Spark's cap 30)
RF_RANDOM = {"numTrees": [100, 200, 300], "maxDepth": [30, 10, 20], "minInstancesPerNode": [1, 2, 4]}
# The models of the reference leaderboard and the spaces it searches (solver and
# min_samples_split have no Spark counterpart); models without a space are fitted as they are
LEADERBOARD = ["random_forest", "gradient_boosting", "logistic_regression", "svm", "knn",
               "decision_tree", "naive_bayes", "ada_boost"]
LEADERBOARD_SPACES = {
    "random_forest": RF_RANDOM,
    "gradient_boosting": {"maxIter": [100, 200], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 5, 7]},
    "logistic_regression": {"C": [0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"]},
    "svm": {"C": [0.1, 1, 10], "kernel": ["linear", "rbf", "poly"], "gamma": ["scale", "auto"]},
    "knn": {"k": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"]},
}


def leaderboard(spark, d, models=tuple(LEADERBOARD), cv_folds=3, n_iter=10, spaces=LEADERBOARD_SPACES):
    """E-SEL / E-SUM / E-BEST: tune each model that has a space (``n_iter`` candidates, mean
    held-out AUC of ``cv_folds`` folds), fit the best, test metrics; ranked by test ROC-AUC
    (name breaks ties).  ``cv_score`` is the chosen candidate's mean: the folds, rows and seeds
    of another round of validation would be the same.  Without folds nothing is tuned."""
    md = ModelData(spark, d, folds=cv_folds or 3)
    candidates = {name: ml.random_sample(spaces[name], n_iter) if cv_folds and name in spaces else [{}] for name in models}
    tuned = ml.tune(md.folds, candidates) if cv_folds else {name: ({}, None) for name in models}
    train = ml.packed(md.train) if cv_folds else md.train

    def one(name):
        model = ml.fit_model(name, train, **tuned[name][0])
        return model, ml.evaluate(ml.scored_frame(model, md.test))

    fitted, rows = {}, []
    for name, (model, res) in zip(models, ml.par_map(one, models)):
        fitted[name] = model
        rows.append((name, res["accuracy"], res["f1"], res["roc_auc"], tuned[name][1]))
    df = spark.createDataFrame(rows, "model string, accuracy double, f1 double, roc_auc double, cv_score double")
    return df.orderBy(F.desc("roc_auc"), F.asc("model")), fitted, md


register("model_leaderboard")(lambda spark, d: leaderboard(spark, d)[0])


def soft_vote(spark, d, top_n=3, models=("random_forest", "gradient_boosting", "logistic_regression",
                                          "naive_bayes", "decision_tree")):
    """E-VOTE: the top-n models by test ROC-AUC, averaged probabilities."""
    board, fitted, md = leaderboard(spark, d, list(models), cv_folds=0)
    top = [r["model"] for r in board.limit(top_n).collect()]
    return ml.SoftVote([fitted[n] for n in top]), md


register("ensemble_soft_vote")(lambda spark, d: (lambda v: ml.scored_frame(v[0], v[1].test))(soft_vote(spark, d)))


def _importance_frame(spark, names, values, top=None):
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top) if top else df


def importance_topn(spark, d, top=20):
    md = ModelData(spark, d)
    rf = ml.fit_model("random_forest", md.train)
    return _importance_frame(spark, md.names, rf.importances(len(md.names)), top)


register("importance_topn")(importance_topn)


def importance_ensemble(spark, d, top=15):
    vote, md = soft_vote(spark, d)
    return _importance_frame(spark, md.names, vote.importances(len(md.names)), top)


register("importance_ensemble")(importance_ensemble)


def feature_names_q(spark, d):
    md = ModelData(spark, d)
    return spark.createDataFrame(list(enumerate(md.names)), "position int, feature string")


def _names_sql():
    """Continuous columns, then the sorted categories of the training rows, then flags."""
    listed = lambda cols: ", ".join(f"'{c}'" for c in cols)
    return with_fixtures(f"""
SELECT CAST(row_number() OVER (ORDER BY part, place, feature) - 1 AS INTEGER) AS position, feature FROM (
  SELECT 0 AS part, unnest(range({len(CONT)})) AS place, unnest([{listed(CONT)}]) AS feature
  UNION ALL SELECT DISTINCT 1, 0, 'category_code_' || category_code FROM placed WHERE rn > round(0.2::DOUBLE * n) AND category_code IS NOT NULL
  UNION ALL SELECT 2, unnest(range({len(BINS)})), unnest([{listed(BINS)}]))""", "account", extra=f"""placed AS (
  SELECT category_code, row_number() OVER (PARTITION BY {TARGET} ORDER BY substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 15), id) AS rn,
         count(*) OVER (PARTITION BY {TARGET}) AS n FROM account)""")


register("feature_names", sql=_names_sql())(feature_names_q)


def cv_scores_q(spark, d, folds=5):
    md = ModelData(spark, d, folds=folds)
    rows = [(r["fold"], r["roc_auc"]) for r in ml.cv_scores("random_forest", md.folds)]
    return spark.createDataFrame(rows, "fold int, roc_auc double")


register("cv_scores")(cv_scores_q)


def cv_multi_metric_q(spark, d, folds=3):
    md = ModelData(spark, d, folds=folds)
    rows = [(r["fold"], r["roc_auc"], r["f1"], r["precision"], r["recall"])
            for r in ml.cv_scores("gradient_boosting", md.folds)]
    return spark.createDataFrame(rows, "fold int, roc_auc double, f1 double, precision double, recall double")


register("cv_multi_metric")(cv_multi_metric_q)

# The forest grid of the reference notebook (min_samples_split has no Spark counterpart)
RF_GRID = {"numTrees": [100, 200], "maxDepth": [3, 5, 7], "minInstancesPerNode": [1, 2]}


def _search_frame(spark, rows):
    return spark.createDataFrame([(r["candidate"], r["params"], r["mean_auc"], r["std_auc"]) for r in rows],
                                 "candidate int, params string, mean_auc double, std_auc double") \
        .orderBy(F.desc("mean_auc"), F.asc("candidate"))


def grid_search_q(spark, d, folds=3):
    md = ModelData(spark, d, folds=folds)
    return _search_frame(spark, ml.search("random_forest", md.folds, ml.grid(RF_GRID)))


def random_search_q(spark, d, folds=3, n_iter=10):
    md = ModelData(spark, d, folds=folds)
    return _search_frame(spark, ml.search("random_forest", md.folds, ml.random_sample(RF_RANDOM, n_iter)))


register("grid_search")(grid_search_q)
register("random_search")(random_search_q)


# F-SFM: boosted model (positive-class weight), keep importance >= median
def select_by_importance(spark, d):
    md = ModelData(spark, d)
    gbt = ml.fit_model("gbt_weighted", md.train)
    imp = gbt.importances(len(md.names))
    kept = set(fs.keep_above_median(md.names, imp))
    return spark.createDataFrame([(i, n, float(v), n in kept) for i, (n, v) in enumerate(zip(md.names, imp))],
                                 "position int, feature string, importance double, selected boolean")


register("select_by_importance")(select_by_importance)

# RFE / RFECV: a 50-tree forest as in the reference.  RFE's step is a share of the features
# per round (the reference removes one at a time, see README); RFECV removes one.
RFE_STEP = 0.1
RFECV_STEP = 1


def _forest50(df):
    return ml.fit_model("random_forest", df, numTrees=50)


def select_rfe(spark, d, n_select=20, step=RFE_STEP):
    md = ModelData(spark, d)
    keep = set(fs.rfe(md.train, md.names, _forest50, n_select, step))
    return spark.createDataFrame([(i, n, i in keep) for i, n in enumerate(md.names)],
                                 "position int, feature string, selected boolean")


register("select_rfe")(select_rfe)


def select_rfecv(spark, d, folds=3, min_features=15, step=RFECV_STEP):
    """Mean held-out AUC of every size on the elimination path of each fold; the row of
    the best size (ties: fewer features) has the features that elimination on all
    training rows keeps, in vector order.

    Folds are prepared apart, so a rare category may be missing in one; the sizes start
    at the smallest width of a fold.  A fold's rounds follow each other; the folds run
    concurrently."""
    md = ModelData(spark, d, folds=folds)
    sizes = fs.path_sizes(min(len(f.prep.names) for f in md.folds), min_features, step)

    def one(fold: ml.Fold) -> dict[int, float]:
        scores, parts = {}, ml.parts_of(fold.train, folds)

        def on_model(keep, model):
            if len(keep) in sizes:
                s = materialize(ml.scored_frame(model, fs.slice_features(fold.held, keep)))
                scores[len(keep)] = mx.roc_auc(s, ml.LABEL, "p1").first()["roc_auc"]

        fs.rfe_path(fold.train, len(fold.prep.names), lambda df: _forest50(df.coalesce(parts)), sizes=sizes, on_model=on_model)
        return scores

    per_fold = ml.par_map(one, md.folds, folds)
    mean = {size: sum(s[size] for s in per_fold) / len(per_fold) for size in sizes}
    best = max(mean, key=lambda size: (mean[size], -size))
    kept = fs.rfe_path(md.train, len(md.names), _forest50, sizes=[size for size in sizes if size >= best])
    names = [md.names[i] for i in kept]
    return spark.createDataFrame([(size, mean[size], size == best, names if size == best else None) for size in sorted(mean)],
                                 "n_features int, mean_auc double, chosen boolean, features array<string>")


register("select_rfecv")(select_rfecv)


# I-PERM: AUC drop when one input column is permuted across the hold-out rows
def importance_permutation(spark, d, seed=7):
    """Each row meets one donor row; a variant of the row takes one column from it.  All
    variants are scored by one transform, and their AUCs come from one grouping."""
    md = ModelData(spark, d)
    model = ml.fit_model("random_forest", md.train)
    columns = SPEC.cont + [SPEC.cat] + SPEC.bins
    # two independent exact ranks of the same rows: row with _r1 = i takes the value of row with _r2 = i
    ranked = hashed_rank(md.test_raw, [], hash_key("id", seed), F.col("id"), rank_col="_r1", size_col=None)
    ranked = materialize(hashed_rank(ranked, [], hash_key("id", seed + 1), F.col("id"), rank_col="_r2", size_col=None))
    both = ranked.join(ranked.select(F.col("_r2").alias("_r1"), F.struct(*columns).alias("_donor")), "_r1")
    variants = both.withColumn("_feature", F.explode(F.array(*[F.lit(c) for c in ["", *columns]])))
    variants = variants.withColumns({c: F.when(F.col("_feature") == c, F.col(f"_donor.{c}")).otherwise(F.col(c)) for c in columns})
    scored = model.transform(md.prep.transform(variants).select("_feature", ml.LABEL, "features")).select("_feature", ml.LABEL, "p1")
    auc = {r["_feature"]: r["roc_auc"] for r in mx.roc_auc_by(scored, ["_feature"], ml.LABEL, "p1").collect()}  # one row a column
    return spark.createDataFrame([(c, auc[""] - auc[c]) for c in columns], "feature string, auc_drop double").orderBy(F.desc("auc_drop"), "feature")


register("importance_permutation")(importance_permutation)
