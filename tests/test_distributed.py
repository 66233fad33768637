"""The distributed formulations equal their single-task definitions."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewright.functions.quantiles import exact_quantiles
from scorewright.functions.ranks import hash_key, hashed_rank
from scorewright.operators import metrics as mx
from scorewright.operators import split as sp
from scorewright.sources.fixtures import account, scored
from scorewright.sources.tables import table

from conftest import SF_MID, SF_SMALL


def test_quantiles_equal_percentile(spark):
    li = table(spark, SF_MID, "lineitem")
    ps = (0.05, 0.25, 0.5, 0.9)
    specs = {f"{c}|{p}": (c, p) for c in ("l_extendedprice", "l_discount") for p in ps}
    want = li.agg(*[F.percentile(F.col(c).cast("double"), p).alias(f"{c}|{p}") for c, p in specs.values()]).first().asDict()
    assert exact_quantiles(li, specs) == want
    assert exact_quantiles(li, specs, bins=8, accuracy=20) == want  # wide brackets, many passes


def test_quantiles_of_ties_extremes_and_nothing(spark):
    huge, inf = 1.7e308, math.inf
    tied = [5.0] * 900 + [float(i) for i in range(100)]
    ends = [-inf, -huge, -1.0, 0.0, 5e-324, 1e-323, 3.0, huge, inf]
    rows = [(tied[i], ends[i] if i < len(ends) else None, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "tied double, ends double, nothing double")
    specs = {f"tied|{p}": ("tied", p) for p in (0.0, 0.25, 0.5, 0.951, 1.0)} | {
        f"ends|{p}": ("ends", p) for p in (0.0, 0.125, 0.375, 0.5, 0.625, 0.875, 1.0)} | {"nothing": ("nothing", 0.5)}
    got = exact_quantiles(df, specs, accuracy=5)
    for name, (c, p) in specs.items():
        values = sorted({"tied": tied, "ends": ends}.get(c, []))
        at = p * (len(values) - 1)
        low, high = math.floor(at), math.ceil(at)
        want = None if not values else values[low] if high == low else (high - at) * values[low] + (at - low) * values[high]
        assert got[name] == want, name


def test_hashed_rank_equals_global_row_number(spark):
    acc = account(spark, SF_MID).select("id", "labels")
    h = hash_key("id", 42)
    ours = hashed_rank(acc, ["labels"], h, F.col("id"), bits=6).select("id", "_rank")
    ref = acc.withColumn("_h", h).select(
        "id", (F.row_number().over(Window.partitionBy("labels").orderBy("_h", "id")) - 1).alias("_rank"))
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_split_shares_and_folds(spark):
    acc = account(spark, SF_SMALL)
    s = sp.stratified_split(acc, "labels").groupBy("labels").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("t")).collect()
    for r in s:
        assert r["t"] == round(0.2 * r["n"] + 1e-9)
    k = sp.stratified_kfold(acc, "labels", k=5)
    assert k.count() == acc.count()
    sizes = k.groupBy("labels", "fold").count().collect()
    by_label = {}
    for r in sizes:
        by_label.setdefault(r["labels"], []).append(r["count"])
    for v in by_label.values():
        assert max(v) - min(v) <= 1


def test_cumulative_buckets_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(int(y), float(s)) for y, s in zip(rng.integers(0, 2, 400), np.round(rng.random(400), 3))]
    df = spark.createDataFrame(rows, "label int, score double")
    got = {r["score"]: (r["tp"], r["fp"]) for r in mx.cumulative(df, "label", "score", buckets=16).collect()}
    for s in set(x for _, x in rows):
        tp = sum(1 for y, x in rows if x >= s and y == 1)
        fp = sum(1 for y, x in rows if x >= s and y == 0)
        assert got[s] == (tp, fp)


def test_grid_f1_equals_brute_force(spark):
    df = scored(spark, SF_SMALL)
    rows = df.select("label", "score").collect()
    grid = mx.grid(30, 70, 1, 100)
    got = {r["threshold"]: r for r in mx.threshold_grid_f1(df, "label", "score", grid, ">").collect()}
    for t in grid:
        tp = sum(1 for r in rows if r["score"] > t and r["label"] == 1)
        fp = sum(1 for r in rows if r["score"] > t and r["label"] == 0)
        assert (got[t]["tp"], got[t]["fp"]) == (tp, fp)


def test_grouped_quantile_equals_median(spark):
    from scorewright.operators.profile import grouped_quantile
    li = table(spark, SF_MID, "lineitem")
    got = {r["l_returnflag"]: r["q"] for r in
           grouped_quantile(li, "l_returnflag", "l_extendedprice", 0.5).collect()}
    ref = {r["l_returnflag"]: r["m"] for r in
           li.groupBy("l_returnflag").agg(F.median("l_extendedprice").alias("m")).collect()}
    assert got == ref


def test_account_deals_rows_by_count(spark, tmp_path, monkeypatch):
    """Tables beyond a task's rows are dealt by their counts, and the rows stay the same: null,
    repeated and unmatched keys, a customer with most orders, a supplier met many times."""
    from scorewright.sources import fixtures
    n = 3000
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(F.col("id"), F.lit(900)).cast("int"))
    key = F.when(F.col("id") % 97 != 0, F.col("id"))
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.pmod(F.col("id") * 7, F.lit(210)))
    ids = spark.range(n)
    tables = {
        "customer": spark.range(200).union(spark.range(5)).select(
            F.when(F.col("id") != 9, F.col("id")).alias("c_custkey"), (F.col("id") % 4).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")),
        "orders": ids.select(key.alias("o_orderkey"), F.when(F.col("id") % 41 != 0, hot).cast("long").alias("o_custkey"),
                             F.when(F.col("id") % 2 == 0, F.lit("F")).otherwise(F.lit("O")).alias("o_orderstatus"),
                             (F.col("id") * 100.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(4 * n).select(F.pmod(F.col("id"), F.lit(n + 50)).alias("k"), "id").select(
            F.when(F.col("k") % 89 != 0, F.col("k")).alias("l_orderkey"), F.when(F.col("id") % 13 != 0, F.col("id") % 50).alias("l_suppkey"),
            F.when(F.col("id") % 5 == 0, F.lit("R")).otherwise(F.lit("N")).alias("l_returnflag")),
        "nation": spark.range(4).select(F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 2).cast("int").alias("n_regionkey")),
        "region": spark.createDataFrame([(0, "AMERICA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    plain = account(spark, str(tmp_path)).collect()
    monkeypatch.setattr(fixtures, "LINES_A_TASK", 250)      # 48 parts
    monkeypatch.setattr(fixtures, "CUSTOMERS_A_TASK", 5)    # 41 parts
    dealt = account(spark, str(tmp_path))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    for part in ("l_orderkey", "o_orderkey", "c_custkey", "cust", "o_custkey"):
        assert any(part in line and line.split("), REPARTITION")[0].endswith((" 48", " 41"))
                   for line in plan.splitlines() if "REPARTITION_BY_NUM" in line), part
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, plain))
    assert len(plain) == 205
