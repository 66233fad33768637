"""Staged fits, persistence, model streams, and the operators on range partitions and cut keys."""

import collections
import json
import math
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.functions.ranks import first_in_order, hash_key, running_sums
from scorewright.operators import models as ml
from scorewright.operators import prepare as pr
from scorewright.operators import profile as pf
from scorewright.operators import split as sp
from scorewright.operators import stages as st
from scorewright.operators.auto import AutoClassifier
from scorewright.sources import sinks
from scorewright.streaming.scoring import score_alerts

SPEC = ml.FeatureSpec(cont=["x1", "x2"], bins=["b"], cat="c")


@pytest.fixture(scope="module")
def rows(spark):
    """120 rows, one in four positive, with NULLs and a category."""
    rng = random.Random(5)
    data = []
    for i in range(120):
        y = int(i % 4 == 0)
        data.append((i, rng.gauss(2.0 * y, 1.0) if i % 11 else None, rng.gauss(0, 1), int(rng.random() < 0.3 + 0.4 * y), rng.choice("uvw"), y))
    return spark.createDataFrame(data, "id long, x1 double, x2 double, b int, c string, label int")


def scores(frame):
    return sorted((r["id"], round(r["p1"], 9)) for r in frame.select("id", "p1").collect())


def test_saved_objects_score_alike_in_a_new_session(spark, rows, tmp_path):
    prep = ml.fit_preparation(rows, SPEC)
    train = ml.add_weights(prep.transform(rows).select("id", "label", "features"))
    svc, ada = ml.fit_model("linear_svc", train), ml.fit_adaboost(train, n_estimators=3)
    auto = AutoClassifier(SPEC, "label", models=["logistic_regression", "naive_bayes"], top_n=2).fit(rows)
    fitted = {"svc": svc, "ada": ada, "vote": ml.SoftVote([svc, ada, ml.fit_model("logistic_regression", train)])}
    sinks.save_model(prep, f"{tmp_path}/prep")
    sinks.save_model(auto, f"{tmp_path}/auto")
    for name, model in fitted.items():
        sinks.save_model(model, f"{tmp_path}/{name}")
    rows.write.parquet(f"{tmp_path}/rows")
    script = f"""
import json, sys
sys.path[:0] = {sys.path!r}
from scorewright.session import local_session
from scorewright.sources import sinks
spark = local_session(2)
rows = spark.read.parquet({str(tmp_path)!r} + "/rows")
prep = sinks.load_model({str(tmp_path)!r} + "/prep")
out = {{"names": prep.names}}
for name in {sorted(fitted)!r}:
    scored = sinks.load_model({str(tmp_path)!r} + "/" + name).transform(prep.transform(rows))
    out[name] = sorted((r["id"], round(r["p1"], 9)) for r in scored.collect())
auto = sinks.load_model({str(tmp_path)!r} + "/auto")
out["auto"] = sorted((r["id"], round(r["p1"], 9)) for r in auto.predict_proba(rows).collect())
out["board"] = [r["model"] for r in auto.leaderboard(spark).collect()]
print("RESULT" + json.dumps(out))
"""
    ran = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    assert "RESULT" in ran.stdout, ran.stderr[-2000:]
    got = json.loads(ran.stdout.rpartition("RESULT")[2])
    assert got["names"] == prep.names
    for name, model in fitted.items():
        assert [tuple(x) for x in got[name]] == scores(model.transform(prep.transform(rows)))
    assert [tuple(x) for x in got["auto"]] == scores(auto.predict_proba(rows)) == scores(auto.transform(rows))
    assert got["board"] == [r["model"] for r in auto.leaderboard(spark).collect()]


SMALL_VOTE = [("random_forest", {"numTrees": 5, "maxDepth": 3}), ("logistic_regression", {})]


def small_pipeline():
    return st.imbalanced_pipeline(["x1", "x2"], ["x1", "x2", "b"], SMALL_VOTE, min_features=2, folds=2)


def test_resampled_rows_exist_in_the_fit_alone(spark, rows, monkeypatch, tmp_path):
    seen = []
    real = st.Smote.resample
    monkeypatch.setattr(st.Smote, "resample", lambda self, df: seen.append(real(self, df)) or seen[-1])
    model = small_pipeline().fit(rows)
    counts = collections.Counter(r["label"] for r in seen[0].collect())
    assert counts[0] == counts[1] == 90 and seen[0].where("id < 0").count() == 60
    assert not any(isinstance(s, st.Resampler) for s in model.stages)
    scored = scores(model.transform(rows))
    assert [i for i, _ in scored] == list(range(120))
    sinks.save_model(model, str(tmp_path / "pipeline"))
    assert scores(sinks.load_model(str(tmp_path / "pipeline")).transform(rows)) == scored
    assert 2 <= len(model.stages[3].keep) <= 3


def test_staged_folds_keep_held_rows_out(spark, rows, monkeypatch):
    seen = []
    real = st.Smote.resample
    monkeypatch.setattr(st.Smote, "resample", lambda self, df: seen.append([r["id"] for r in df.collect()]) or real(self, df))
    data = sp.stratified_kfold(rows, "label", k=2)
    held = {k: {r["id"] for r in data.where(F.col("fold") == k).collect()} for k in range(2)}
    for k, (model, scored) in enumerate(st.staged_folds(small_pipeline(), data, 2)):
        assert {i for i, _ in scores(scored)} == held[k] and not held[k] & set(seen[k])
        rest = [r["x1"] for r in data.where(F.col("fold") != k).collect() if r["x1"] is not None]
        assert model.stages[0].values["x1"][0] == pytest.approx(float(np.median(rest)))


def test_stages_apply_training_statistics(spark):
    train = spark.createDataFrame([(float(i), "a" if i % 3 else None) for i in range(1, 6)] + [(None, "b")], "x double, c string")
    flow = st.StagedPipeline([st.MedianFill(["x"]), st.ModeFill(["c"]), st.QuantileClip(["x"], 0.25, 0.75), st.StandardScale(["x"])]).fit(train)
    other = spark.createDataFrame([(None, None), (100.0, "z")], "x double, c string")
    got = [tuple(r) for r in flow.transform(other).collect()]
    filled = sorted([1.0, 2.0, 3.0, 3.0, 4.0, 5.0])
    low, high = np.quantile(filled, [0.25, 0.75])
    clipped = np.clip(filled, low, high)
    scaled = lambda x: (np.clip(x, low, high) - clipped.mean()) / clipped.std()
    assert [(pytest.approx(scaled(3.0)), "a"), (pytest.approx(scaled(100.0)), "z")] == got


def test_stream_with_loaded_model_restarts_without_repeats(spark, rows, tmp_path):
    model = small_pipeline().fit(rows)
    sinks.save_model(model, str(tmp_path / "model"))
    loaded = sinks.load_model(str(tmp_path / "model"))
    run = lambda: score_alerts(spark, str(tmp_path / "in"), rows.schema, loaded.transform, str(tmp_path / "out"), str(tmp_path / "state"),
                               threshold=0.4, prob="p1", max_files_per_trigger=1)
    want = [(i, p) for i, p in scores(model.transform(rows)) if p > 0.4]
    rows.where("id < 60").repartition(3).write.parquet(str(tmp_path / "in"))
    assert scores(run()) == [(i, p) for i, p in want if i < 60]
    rows.where("id >= 60").repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
    assert scores(run()) == want and scores(run()) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_moves_no_rows_and_is_exact(spark):
    data = [(i, i % 3 if i % 7 else None) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, y int")
    out = sp.stratified_split(df, "y", test_size=0.3)
    assert "hashpartitioning" not in plan_of(out) and "rangepartitioning" not in plan_of(out)
    keys = {r["id"]: r["h"] for r in df.select("id", hash_key("id", 42).alias("h")).collect()}
    classes = collections.defaultdict(list)
    for i, y in data:
        classes[y].append(i)
    want = {i for own in classes.values() for i in sorted(own, key=lambda i: (keys[i], i))[:math.floor(len(own) * 0.3 + 0.5)]}
    assert {r["id"] for r in out.where("is_test = 1").collect()} == want and out.count() == 2000
    assert sp.random_split(df, test_size=0.0).where("is_test = 1").count() == 0
    again = df.union(df).union(spark.createDataFrame([(None, 1)] * 40, "id long, y int"))  # repeated and null keys share a side
    sides = sp.random_split(again, test_size=0.5).groupBy("id").agg(F.countDistinct("is_test").alias("n"), F.count("*").alias("c")).collect()
    assert all(r["n"] == 1 for r in sides) and {r["id"]: r["c"] for r in sides}[None] == 40
    assert sp.random_split(df.where("false")).count() == 0
    more_bits = first_in_order(df, ["y"], hash_key("id", 42), F.col("id"), 0.3, "is_test", bits=3)
    assert {r["id"] for r in more_bits.where("is_test = 1").collect()} == want


def test_running_sums_and_sorted_codes(spark):
    values = [f"v{i * 7919 % 500:03d}" for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "c string").repartition(7)
    codes = {r["value"]: r["code"] for r in pr.fit_label_codes(df, "c").collect()}
    assert codes == {v: i for i, v in enumerate(sorted({*values, "nan"}))}
    pairs = spark.createDataFrame([(g, x) for g in ("a", None, "b") for x in range(50)], "g string, x int")
    got = {(r["g"], r["x"]): (r["_before"], r["_total"]) for r in running_sums(pairs, ["g"], ["x"], F.col("x")).collect()}
    assert got == {(g, x): (x * (x - 1) // 2, 1225) for g in ("a", None, "b") for x in range(50)}


def test_grouped_quantile_of_many_groups(spark):
    rng = random.Random(1)
    data = [(f"g{min(rng.randint(0, 400), 300)}", rng.choice([None, float(rng.randint(0, 30)), float("nan")])) for _ in range(4000)] + [(None, 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    groups = collections.defaultdict(list)
    for g, x in data:
        groups[g] += [] if x is None or math.isnan(x) else [x]
    for p in (0.0, 0.5, 0.9, 1.0):
        got = {r["g"]: r["q"] for r in pf.grouped_quantile(df, "g", "x", p).collect()}
        assert got == {g: pytest.approx(float(np.quantile(v, p))) if v else None for g, v in groups.items()}


def test_boxplot_of_the_classes_in_the_data(spark):
    data = [(k, float(i * i)) for k in ("lo", "mid", "hi") for i in range(9)] + [(None, 5.0), ("mid", None)]
    got = {r["label"]: r for r in pf.boxplot_stats(spark.createDataFrame(data, "y string, x double"), "y", ["x"]).collect()}
    assert set(got) == {"lo", "mid", "hi"}
    for r in got.values():
        q1, q2, q3 = np.quantile([float(i * i) for i in range(9)], [0.25, 0.5, 0.75])
        assert (r["n"], r["q1"], r["median"], r["q3"], r["whisker_low"], r["n_outliers"]) == (9, q1, q2, q3, 0.0, 0)
    with pytest.raises(ValueError):
        pf.boxplot_stats(spark.createDataFrame([(i, 1.0) for i in range(100)], "y int, x double"), "y", ["x"])


def test_kernel_svc_separates_a_ring(spark, tmp_path):
    rng = random.Random(3)
    points = [(rng.uniform(-2, 2), rng.uniform(-2, 2)) for _ in range(300)]
    data = [(i, x, y, int(0.8 < math.hypot(x, y) < 1.6)) for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(data, "id long, x1 double, x2 double, label int")
    from pyspark.ml.feature import VectorAssembler
    df = ml.add_weights(VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df).select("id", "label", "features"))
    auc = {name: ml.evaluate(ml.scored_frame(ml.fit_model(name, df.where("id < 200")), df.where("id >= 200")))["roc_auc"] for name in ("linear_svc", "rbf_svc")}
    assert auc["rbf_svc"] > 0.9 > 0.75 > auc["linear_svc"]
    model = ml.fit_model("rbf_svc", df.where("id < 200"))
    sinks.save_model(model, str(tmp_path / "rbf"))
    assert scores(sinks.load_model(str(tmp_path / "rbf")).transform(df)) == scores(model.transform(df))
    assert model.transform(df).select("features").first()["features"].size == 2


def test_auc_of_groups_equals_that_of_each(spark):
    from scorewright.operators import metrics as mx
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 1, None]), round(rng.random(), 1)) for _ in range(400)] + [("c", 1, 0.5)]
    df = spark.createDataFrame(data, "g string, y int, s double")
    got = {r["g"]: r["roc_auc"] for r in mx.roc_auc_by(df, ["g"], "y", "s").collect()}
    assert got.pop("c") is None
    assert got == {g: pytest.approx(mx.roc_auc(df.where(F.col("g").eqNullSafe(F.lit(g))), "y", "s").first()["roc_auc"]) for g in ("a", "b", None)}


def test_approximate_neighbours_recall(spark):
    from scorewright.operators import neighbors as nb
    from scorewright.plans.neighbor_queries import account_vectors
    v = account_vectors(spark, "/root/testdata/sf0.01")
    pairs = lambda out: {(r["q_id"], r["n_id"]) for r in out.collect()}
    exact = pairs(nb.knn(v, v, 5))
    got = pairs(nb.knn_approx(v, v, 5, cell_rows=32, probes=8))
    assert len(exact & got) >= 0.9 * len(exact)
    assert pairs(nb.knn_approx(v, v, 5, cell_rows=300, probes=100)) == exact
