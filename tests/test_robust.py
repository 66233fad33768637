"""NULL keys, NULL labels and NaN scores; the checkpoint folder; required columns."""

import pytest
from pyspark.sql import functions as F

from scorewright.operators.metrics import roc_auc
from scorewright.operators.split import random_split, stratified_kfold, stratified_split
from scorewright.session import drop_folder, materialize, scratch_folder
from scorewright.sources.tables import load_labeled, require_columns


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (5, 0), (6, None), (None, None)], "id long, label int")


def count(parts):
    return sum(p.count() for p in parts) if isinstance(parts, tuple) else parts.count()


def test_splits_keep_every_row(rows):
    assert count(stratified_split(rows, "label", "id")) == 7
    assert count(stratified_kfold(rows, "label", "id")) == 7
    assert count(random_split(rows, "id")) == 7


def test_auc_leaves_out_null_labels_and_nan_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (1, float("nan")), (0, None)], "y int, s double")
    r = roc_auc(df, "y", "s").first()
    assert (r["n_positive"], r["n_negative"], r["roc_auc"]) == (1, 1, 1.0)


def test_stored_tables_belong_to_the_application(spark):
    table = materialize(spark.range(5))
    assert table.count() == 5 and f"/tables-{spark.sparkContext.applicationId}/" in table.inputFiles()[0]
    materialize(spark.range(1))
    path = f"{scratch_folder(spark)}-other"
    spark.range(3).write.parquet(path)
    drop_folder(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_required_columns(rows):
    assert require_columns(rows, ["id"]) is rows
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(rows, ["id", "nope"])
    with pytest.raises(ValueError):
        load_labeled(rows.sparkSession, rows, "absent")


def test_more_buckets_give_the_same_ranks_and_curves(spark, monkeypatch):
    from scorewright.functions import ranks
    from scorewright.operators import metrics
    rows = spark.range(500).selectExpr("id", "cast(id % 3 = 0 as int) label", "(id * 7 % 101) / 101.0D score")

    def results():
        r = ranks.hashed_rank(rows, ["label"], ranks.hash_key("id", 1), F.col("id"), bits=1)
        c = metrics.cumulative(rows, "label", "score", 2)
        return (sorted(map(tuple, r.select("id", "_rank", "_group_n").collect())),
                sorted(map(tuple, c.select("score", "tp", "fp").collect())))

    before = results()
    monkeypatch.setattr(ranks, "BUCKET_ROWS", 20)
    monkeypatch.setattr(metrics, "BUCKET_ROWS", 10)
    assert results() == before


def test_threshold_grid_skips_null_labels_and_nan_scores(spark):
    from scorewright.operators.metrics import threshold_grid_f1
    rows = spark.createDataFrame([(1, 0.5), (0, 0.25), (1, 0.75), (None, 0.9), (1, float("nan")), (0, None)], "label int, score double")
    at = {c: [(r["threshold"], r["tp"], r["fp"], r["fn"], r["tn"])
              for r in threshold_grid_f1(rows, "label", "score", [0.25, 0.5], c).orderBy("threshold").collect()] for c in (">", ">=")}
    assert at[">"] == [(0.25, 2, 0, 0, 1), (0.5, 1, 0, 1, 1)]
    assert at[">="] == [(0.25, 2, 1, 0, 0), (0.5, 2, 0, 0, 1)]
