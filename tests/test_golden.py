"""Golden micro-frames: the pandas / scikit-learn traps, hand-computed."""

import math

import pytest
from pyspark.sql import functions as F

from scorewright.functions.nullsafe import clip, flag, np_maximum, row_stats
from scorewright.functions.quantiles import exact_quantiles
from scorewright.operators import metrics as mx
from scorewright.operators import prepare as pr


def test_null_comparison_is_false(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(flag(F.col("x") > 3).alias("f")).first()["f"] == 0
    # negation of a NULL comparison is True in pandas
    assert df.select(flag(~F.coalesce(F.col("x") > 3, F.lit(False))).alias("f")).first()["f"] == 1


def test_null_max_and_clip(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "x double")
    rows = df.select(np_maximum(F.lit(0.0), F.col("x") - 2).alias("m"), clip("x", 1.0, 2.0).alias("c")).collect()
    assert rows[0]["m"] is None and rows[0]["c"] is None
    assert rows[1]["m"] == 3.0 and rows[1]["c"] == 2.0


def test_row_stats(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    st = row_stats(["a", "b", "c"])
    r = df.select(st["sum"].alias("s"), st["mean"].alias("m"), st["std"].alias("sd")).collect()
    assert r[0]["s"] == 4.0 and r[0]["m"] == 2.0 and math.isclose(r[0]["sd"], 1.41421356, rel_tol=1e-8)
    assert r[1]["s"] == 0.0 and r[1]["m"] is None and r[1]["sd"] is None


@pytest.mark.parametrize("bins", [2, 256])
def test_quantiles_even_median_and_q25(spark, bins):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (math.nan,)], "x double")
    q = exact_quantiles(df, {"m": ("x", 0.5), "q": ("x", 0.25)}, bins=bins)
    assert q["m"] == 2.5 and q["q"] == 1.75


def test_population_std(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double")
    m, s = pr.fit_standard(df, ["x"])["x"]
    assert m == 3.0 and math.isclose(s, 1.41421356, rel_tol=1e-8)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, .1), (0, .4), (1, .4), (1, .8)], "label int, score double")
    for b in (1, 2, 64):
        assert math.isclose(mx.roc_auc(df, "label", "score", buckets=b).first()["roc_auc"], 0.875)


def test_average_precision(spark):
    df = spark.createDataFrame([(0, .1), (0, .4), (1, .35), (1, .8)], "label int, score double")
    assert math.isclose(mx.average_precision(df, "label", "score").first()["average_precision"], 0.83333333,
                        rel_tol=1e-7)


def test_f1_no_positive_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert mx.binary_metrics(df, "label", "prediction").first()["f1"] == 0.0


def test_unseen_category(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    test = spark.createDataFrame([("z",)], "c string")
    cats = pr.fit_categories(train, "c")
    oh = pr.apply_one_hot(test, "c", cats).first()
    assert (oh["c_a"], oh["c_b"], oh["c_c"]) == (0, 0, 0)
    codes = pr.fit_label_codes(train, "c")
    assert pr.apply_label_codes(test, "c", codes, unseen="extra").first()["c_code"] == 3


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    w = {r["y"]: r["weight"] for r in pr.class_weights(df, "y").collect()}
    assert math.isclose(w[1], 0.66666667, rel_tol=1e-7) and w[0] == 2.0


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",)], "c string")
    assert pr.fit_mode(df, ["c"])["c"] == "a"
