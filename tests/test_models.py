"""Invariants for the non-SQL operators (models, kNN, SMOTE, persistence)."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from scorewright.operators import models as ml
from scorewright.operators import neighbors as nb
from scorewright.plans import model_queries as mq
from scorewright.plans.model_queries import ModelData
from scorewright.plans.neighbor_queries import _vecs
from scorewright.session import materialize
from scorewright.sources import sinks

from conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def md(spark):
    return ModelData(spark, SF_SMALL)


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "naive_bayes", "linear_svc"])
def test_probabilities_and_planted_signal(md, name):
    model = ml.fit_model(name, md.train)
    s = ml.scored_frame(model, md.test)
    rows = s.collect()
    assert len(rows) == md.test.count()
    assert all(0.0 <= r["p1"] <= 1.0 for r in rows)
    assert ml.evaluate(s)["roc_auc"] > 0.5


def test_adaboost_and_vote(md):
    ada = ml.fit_adaboost(md.train, n_estimators=5)
    rf = ml.fit_model("random_forest", md.train)
    vote = ml.SoftVote([ada, rf])
    r = ml.scored_frame(vote, md.test).collect()
    assert all(0.0 <= x["p1"] <= 1.0 for x in r)


def test_knn_equals_brute_force(spark):
    v = _vecs(spark, SF_SMALL)
    rows = v.collect()
    ids = np.array([r["id"] for r in rows])
    x = np.array([r["v"] for r in rows])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for pivots, dims in ((4, 1), (32, 4), (64, 8)):
        got = {}
        for r in nb.knn(v, v, 3, n_pivots=pivots, proj_dims=dims).collect():
            got.setdefault(r["q_id"], []).append((r["rank"], r["n_id"]))
        for i, qid in enumerate(ids):
            order = sorted(range(len(ids)), key=lambda j: (d[i, j], ids[j]))[:3]
            assert [n for _, n in sorted(got[qid])] == [ids[j] for j in order]


def test_knn_sends_a_query_once_to_a_group_of_cells(spark, monkeypatch):
    """Without structure every cell is a candidate; a query is sent to groups, and blocks cut
    groups: the rows are those of brute force, with equal and missing vectors too."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 8))
    x[50:60] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(4000, None), (None, x[0].tolist())]
    v = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    diag = {}
    found = nb.knn(v, v, 4, diagnostics=diag)
    want = {}
    for i in range(0, 4000, 97):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        want[i] = np.lexsort((np.arange(4000), d))[:4].tolist()
    near = lambda df: {i: [r["n_id"] for r in sorted(rs, key=lambda r: r["rank"])] for i, rs in
                       ((i, [r for r in found_rows if r["q_id"] == i]) for found_rows in [df.where(F.col("q_id") % 97 == 0).collect()] for i in want)}
    assert near(found) == want
    assert diag["sent"] <= 4000 * (nb.GROUPS + 1)   # 4000 x 125 cells before
    monkeypatch.setattr(nb, "BLOCK_ROWS", 40)       # more groups, and cells of over a block
    assert near(nb.knn(v, v, 4, max_cells=32)) == want


def test_groups_of_cells_follow_their_sizes():
    sizes = [30] * 40_000
    groups = nb._groups(sizes)
    held = np.bincount(groups, weights=sizes)
    assert (np.diff(groups) >= 0).all() and held.max() <= nb.BLOCK_ROWS
    assert len(held) <= 1.1 * max(nb.GROUPS, sum(sizes) / nb.BLOCK_ROWS)
    assert nb._groups([3, 90_000, 5]).tolist() == [0, 1, 2]


def test_smote_balances_and_interpolates(spark):
    v = _vecs(spark, SF_MID)
    out = nb.smote(v, k=3)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    orig = {r["id"]: np.array(r["v"]) for r in v.where(F.col("label") == 1).collect()}
    syn = out.where(F.col("synthetic") == 1).collect()
    assert len({r["id"] for r in syn}) == len(syn)
    # every synthetic point lies inside the bounding box of the minority class
    lo = np.min(np.stack(list(orig.values())), axis=0) - 1e-9
    hi = np.max(np.stack(list(orig.values())), axis=0) + 1e-9
    for r in syn:
        p = np.array(r["v"])
        assert np.all(p >= lo) and np.all(p <= hi)


def test_model_save_load_roundtrip(spark, md, tmp_path):
    pipe = Pipeline(stages=[LogisticRegression(labelCol="label", featuresCol="features")]).fit(md.train)
    path = str(tmp_path / "model")
    sinks.save_model(pipe, path)
    again = sinks.load_model(path)
    a = [r["probability"][1] for r in pipe.transform(md.test).orderBy("id").collect()]
    b = [r["probability"][1] for r in again.transform(md.test).orderBy("id").collect()]
    assert all(math.isclose(x, y) for x, y in zip(a, b))


def test_auto_classifier_facade(spark):
    from scorewright.operators.auto import AutoClassifier, evaluate_model
    from scorewright.operators import features as fx
    from scorewright.plans.model_queries import SPEC
    from scorewright.sources.fixtures import account
    data = fx.derive_scored(account(spark, SF_SMALL))
    auto = AutoClassifier(SPEC, "labels_planted", models=["logistic_regression", "naive_bayes", "decision_tree"],
                          top_n=2, feature_engineering=True).fit(data)
    assert auto.leaderboard(spark).count() == 3
    pred = auto.predict(data)
    assert pred.count() == data.count()
    assert evaluate_model(auto, data, "labels_planted")["roc_auc"] > 0.5


def test_knn_prunes_structured_data(spark):
    """On tabular features (low intrinsic dimension) the projected-box bounds
    remove most pairs, and the result still equals brute force."""
    from scorewright.sources.fixtures import account
    from scorewright.operators import prepare as pr
    cols = ["relationships", "funding_rounds", "milestones", "avg_participants", "funding_total_usd",
            "age_first_funding_year", "age_last_funding_year"]
    a = account(spark, SF_MID).select("id", *cols)
    a = pr.apply_fill(a, pr.fit_median(a, cols))
    a = pr.apply_standard(a, pr.fit_standard(a, cols))
    v = a.select("id", F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    diag = {}
    got = nb.knn(v, v, 3, diagnostics=diag).collect()
    n = v.count()
    assert diag["candidate_pairs"] < 0.5 * n * n
    rows = v.collect()
    ids = np.array([r["id"] for r in rows])
    x = np.array([r["v"] for r in rows])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    by_q = {}
    for r in got:
        by_q.setdefault(r["q_id"], []).append((r["rank"], r["n_id"]))
    idx = {i: j for j, i in enumerate(ids)}
    for qid, lst in list(by_q.items())[:200]:
        i = idx[qid]
        order = sorted(range(len(ids)), key=lambda j: (d[i, j], ids[j]))[:3]
        assert [nid for _, nid in sorted(lst)] == [ids[j] for j in order]


def test_folds_are_prepared_without_their_held_rows(spark, md):
    """Other values in the held-out rows leave the fold's preparation and weights unchanged."""
    from scorewright.plans.model_queries import SPEC
    raw = md.train_raw
    held = F.col("fold") == 0
    other = raw.withColumns({c: F.when(held, F.col(c) * 1000 + 7).otherwise(F.col(c)) for c in SPEC.cont[:3]}) \
        .withColumn(SPEC.cat, F.when(held, F.lit("a held-out category")).otherwise(F.col(SPEC.cat))) \
        .withColumn(ml.LABEL, F.when(held, F.lit(1)).otherwise(F.col(ml.LABEL)))
    a, b = ml.fit_folds(raw, SPEC, 2)[0], ml.fit_folds(other, SPEC, 2)[0]
    assert a.prep.medians == b.prep.medians
    for c in SPEC.cont:
        assert a.prep.scaling[c] == pytest.approx(b.prep.scaling[c])
    assert a.prep.names == b.prep.names
    weights = [{(r["label"], r["w_balanced"], r["w_pos"]) for r in f.train.select("label", "w_balanced", "w_pos").distinct().collect()}
               for f in (a, b)]
    assert weights[0] == weights[1]
    assert a.train.count() + a.held.count() == raw.count() == b.train.count() + b.held.count()


def test_search_scores_folds_by_auc_alone(md, monkeypatch):
    """The same means as from the full report of each fold, without its other passes."""
    folds, params = md.folds[:2], [{"maxDepth": 1}, {"maxDepth": 3}]
    want = [[ml.fold_score("decision_tree", f, p)["roc_auc"] for f in folds] for p in params]

    def never(scored):
        raise AssertionError("a search needs no full report")

    monkeypatch.setattr(ml, "evaluate", never)
    got = ml.search("decision_tree", folds, params)
    assert [r["mean_auc"] for r in got] == pytest.approx([sum(w) / 2 for w in want])


def test_elimination_path_sizes():
    from scorewright.operators.select import path_sizes
    assert path_sizes(10, 4, 3) == [10, 7, 4]
    assert path_sizes(10, 4, 0.4) == [10, 6, 4]
    assert path_sizes(3, 5) == [3]


@pytest.fixture(scope="module")
def wide(spark):
    """Rows of their own with 30 features, keys null and repeated; the first two tell the classes apart."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 30))
    y = (x[:, 0] + x[:, 1] + 0.3 * rng.normal(size=240) > 0).astype(int)
    rows = [(None if i % 31 == 0 else i // 2, int(y[i]), i % 3, x[i].tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, label int, fold int, features array<double>")
    df = df.withColumn("features", array_to_vector("features")).repartition(4)
    prep = SimpleNamespace(names=[f"x{i}" for i in range(30)])
    folds = [ml.Fold(k, prep, materialize(ml.add_weights(df.where(F.col("fold") != k).drop("fold"))),
                     materialize(df.where(F.col("fold") == k).drop("fold"))) for k in range(3)]
    return SimpleNamespace(folds=folds, names=prep.names, train=folds[0].train, test=folds[0].held, n_folds=3)


def test_rfecv_removes_one_feature_a_round(spark, wide, monkeypatch):
    monkeypatch.setattr(mq, "ModelData", lambda *a, **k: wide)
    monkeypatch.setattr(mq, "_forest50", lambda df: ml.fit_model("decision_tree", df, maxDepth=2))
    rows = mq.select_rfecv(spark, None, min_features=24).orderBy("n_features").collect()
    assert [r["n_features"] for r in rows] == list(range(24, 31))  # three a round with a share of 0.1
    chosen = [r for r in rows if r["chosen"]]
    assert len(chosen) == 1 and len(chosen[0]["features"]) == chosen[0]["n_features"]
    assert chosen[0]["mean_auc"] == max(r["mean_auc"] for r in rows)


def test_leaderboard_has_the_models_and_spaces_of_the_reference():
    assert mq.LEADERBOARD == ["random_forest", "gradient_boosting", "logistic_regression", "svm", "knn",
                              "decision_tree", "naive_bayes", "ada_boost"]
    assert {k: len(ml.grid(v)) for k, v in mq.LEADERBOARD_SPACES.items()} == {
        "random_forest": 27, "gradient_boosting": 18, "logistic_regression": 10, "svm": 18, "knn": 10}


def test_leaderboard_tunes_its_models(spark, wide, monkeypatch):
    """Each model with a space takes its best candidate; kNN's settings come from one join."""
    monkeypatch.setattr(mq, "ModelData", lambda *a, **k: wide)
    spaces = {"knn": {"k": [1, 9], "weights": ["uniform"]}, "decision_tree": {"maxDepth": [0, 4]}}
    board, fitted, _ = mq.leaderboard(spark, None, models=["knn", "decision_tree"], spaces=spaces)
    got = {r["model"]: r for r in board.collect()}
    assert set(got) == {"knn", "decision_tree"} and all(r["roc_auc"] > 0.6 for r in got.values())
    want = [ml.fold_auc("decision_tree", f, {"maxDepth": 4}) for f in wide.folds]
    assert got["decision_tree"]["cv_score"] == pytest.approx(sum(want) / 3)  # depth 0 gives 0.5
    assert fitted["knn"].k == 9
    assert ml.knn_aucs(wide.folds[1], [{"k": 9, "weights": "uniform"}]) == pytest.approx([ml.fold_auc("knn", wide.folds[1], {"k": 9})])


def test_svm_kernels(wide):
    train = ml.packed(wide.train, 100)
    poly = ml.fit_model("svm", train, kernel="poly", gamma="auto", C=1, size=16)
    assert isinstance(poly.kernel, ml.CubicFeatures) and poly.kernel.gamma == pytest.approx(1 / 30)
    scored = ml.scored_frame(poly, wide.test).collect()
    assert len(scored) == wide.test.count() and all(0.0 <= r["p1"] <= 1.0 for r in scored)


def test_cubic_features_have_the_kernel_as_mean(spark):
    x = np.random.default_rng(1).normal(size=(6, 4))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    z = np.array([r["features"].toArray() for r in ml.CubicFeatures(4, 0.25, 200_000).transform(df).orderBy("id").collect()])
    assert np.allclose(z @ z.T, (0.25 * x @ x.T) ** 3, atol=0.15)


def test_packed_rows_stay_whole(spark, monkeypatch):
    df = materialize(spark.range(1000).repartition(16))
    monkeypatch.setattr(ml, "ROWS_A_TASK", 90)
    cores = spark.sparkContext.defaultParallelism
    assert ml.parts_of(df) == max(12, -(-cores // ml.PARALLELISM))
    assert ml.packed(df).rdd.getNumPartitions() <= ml.parts_of(df)
    assert sorted(r["id"] for r in ml.packed(df).collect()) == list(range(1000))
