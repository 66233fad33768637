"""Registered queries: sources / sinks (S1, S5, S6, S8), stream scoring (R1),
ANOVA selection, leave-one-out group rates, prediction-file vote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics as mx
from ..operators import select as sel
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..sources.fixtures import SCORE_INPUTS, account, account_m, score_expr, scored
from ..sources.tables import ENTITY_SCHEMA, read_csv
from ..operators import split as sp
from ..streaming.scoring import score_alerts
from .oracle_fixtures import with_fixtures
from .registry import register

LOCATIONS = [("is_CA", "CA"), ("is_NY", "NY"), ("is_MA", "MA"), ("is_TX", "TX"), ("is_otherstate", "other")]
SECTORS = ["software", "web", "mobile", "enterprise", "advertising", "gamesvideo", "ecommerce", "biotech",
           "consulting", "othercategory"]


def out_dir(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/out/{name}-{uuid.uuid4().hex}"


# S5
register("score_output", sql=with_fixtures(
    "SELECT id, CAST(score >= 0.5 AS INTEGER) AS labels FROM scored", "scored"))(
    lambda spark, d: sinks.predictions_frame(mx.predict(scored(spark, d), "score", 0.5)))

# S6 / J1
register("template_fill", sql=with_fixtures("""
SELECT t.id, p.labels FROM (SELECT id FROM account_split WHERE is_test = 1) t
LEFT JOIN (SELECT id, CAST(score >= 0.5 AS INTEGER) AS labels FROM scored) p ON t.id = p.id""",
                                          "account_split", "scored"))(
    lambda spark, d: sinks.fill_template(
        sp.stratified_split(account_m(spark, d), "labels").where(F.col("is_test") == 1),
        sinks.predictions_frame(mx.predict(scored(spark, d), "score", 0.5))))

# S8
register("score_probabilities", doubles=("probability",), sql=with_fixtures(
    "SELECT id, score AS probability, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored", "scored"))(
    lambda spark, d: sinks.probabilities_frame(mx.predict(scored(spark, d), "score", 0.5), prob="score"))


# CSV written from the tables, read back with the explicit entity schema
def scan_profile(spark, d):
    path = out_dir(spark, "entity_csv")
    acc = account(spark, d).select(*ENTITY_SCHEMA.fieldNames(), "labels")
    sinks.write_csv(acc, path)
    back = read_csv(spark, path, with_label="labels")
    row = back.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in back.columns])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null"), F.col("_rows").alias("n_rows"))
        for c in back.columns])).alias("s")).select("s.*")


register("scan_profile", sql=with_fixtures(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows FROM account"
    for c in ENTITY_SCHEMA.fieldNames() + ["labels"]), "account"))(scan_profile)


# R1
def stream_score_alerts(spark, d, threshold=0.8):
    src = out_dir(spark, "stream_in")
    # new records land as several files; the stream picks them up file by file
    account(spark, d).select(*SCORE_INPUTS).repartition(4).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    return score_alerts(spark, src, schema, lambda s: s.withColumn("score", score_expr()),
                        out_dir(spark, "stream_alerts"), out_dir(spark, "stream_ckpt"),
                        threshold=threshold, max_files_per_trigger=1)


register("stream_score_alerts", doubles=("score",), sql=with_fixtures(
    "SELECT id, score FROM scored WHERE score > 0.8::DOUBLE", "scored"))(stream_score_alerts)

# F-ANOVA
ANOVA_COLS = ["age_first_funding_year", "age_last_funding_year", "age_first_milestone_year",
              "age_last_milestone_year", "relationships", "funding_rounds", "funding_total_usd", "milestones",
              "avg_participants", "is_CA", "is_NY", "is_MA", "has_VC", "has_angel", "has_roundA", "has_roundB"]
ANOVA_K = 10


def _anova_sql():
    parts = []
    for i, c in enumerate(ANOVA_COLS):
        parts.append(f"""SELECT '{c}' AS feature, {i} AS position, sum(n) AS n, sum(s) AS s, sum(q) AS q,
  sum(s * s / n) AS between, count(*) AS k
FROM (SELECT labels, count({c})::DOUBLE AS n, sum({c}::DOUBLE) AS s, sum({c}::DOUBLE * {c}::DOUBLE) AS q
      FROM account GROUP BY labels)""")
    f = """CASE WHEN k > 1 AND (q - s * s / n) - (between - s * s / n) > 0 THEN
  ((between - s * s / n) / (k - 1)) / (((q - s * s / n) - (between - s * s / n)) / (n - k)) END"""
    return with_fixtures(f"""
SELECT feature, position, f_stat, rank, rank <= {ANOVA_K} AS selected FROM (
  SELECT feature, position, f_stat, CAST(row_number() OVER (ORDER BY f_stat DESC NULLS LAST, position) AS INTEGER) AS rank
  FROM (SELECT feature, position, {f} AS f_stat FROM ({" UNION ALL ".join(parts)})))""", "account")


register("select_k_anova", doubles=("f_stat",), sql=_anova_sql())(
    lambda spark, d: sel.select_k_best(account(spark, d), "labels", ANOVA_COLS, ANOVA_K))


# re-aimed hard-coded group success rates: leave-one-out per-group label mean
def _group_of(pairs):
    expr = F.lit(None).cast("string")
    for flag_col, name in reversed(pairs):
        expr = F.when(F.col(flag_col) == 1, F.lit(name)).otherwise(expr)
    return expr


def group_success_rate(spark, d):
    a = account(spark, d).select(
        "id", "labels", _group_of(LOCATIONS).alias("location"),
        _group_of([(f"is_{s}", s) for s in SECTORS]).alias("sector"))
    out = a
    for g in ("location", "sector"):
        # one row per group: bounded by the number of flag columns
        stats = a.groupBy(g).agg(F.sum("labels").alias(f"_s_{g}"), F.count(F.lit(1)).alias(f"_n_{g}"))
        out = out.join(F.broadcast(stats), g, "left").withColumn(
            f"{g}_rate", F.when(F.col(f"_n_{g}") > 1,
                                (F.col(f"_s_{g}") - F.col("labels")) / (F.col(f"_n_{g}") - 1)))
        out = out.drop(f"_s_{g}", f"_n_{g}")
    return out.select("id", "location", "location_rate", "sector", "sector_rate")


def _case(pairs):
    return "CASE " + " ".join(f"WHEN {f} = 1 THEN '{n}'" for f, n in pairs) + " END"


register("group_success_rate", doubles=("location_rate", "sector_rate"), sql=with_fixtures(f"""
SELECT g.id, g.location,
       CASE WHEN l.n > 1 THEN (l.s - g.labels)::DOUBLE / (l.n - 1) END AS location_rate, g.sector,
       CASE WHEN t.n > 1 THEN (t.s - g.labels)::DOUBLE / (t.n - 1) END AS sector_rate
FROM (SELECT id, labels, {_case(LOCATIONS)} AS location, {_case([(f"is_{s}", s) for s in SECTORS])} AS sector
      FROM account) g
LEFT JOIN (SELECT {_case(LOCATIONS)} AS location, sum(labels) AS s, count(*) AS n FROM account GROUP BY 1) l
  ON g.location IS NOT DISTINCT FROM l.location
LEFT JOIN (SELECT {_case([(f"is_{s}", s) for s in SECTORS])} AS sector, sum(labels) AS s, count(*) AS n
           FROM account GROUP BY 1) t ON g.sector IS NOT DISTINCT FROM t.sector""", "account"))(group_success_rate)

# E-BLEND: majority vote over prediction files (one file per decision rule)
VOTE_RULES = (0.3, 0.5, 0.7)


def prediction_vote(spark, d):
    s = scored(spark, d)
    files = [sinks.predictions_frame(mx.predict(s, "score", t)) for t in VOTE_RULES]
    allp = files[0]
    for f in files[1:]:
        allp = allp.unionByName(f)
    return allp.groupBy("id").agg(F.count(F.lit(1)).alias("n_votes"),
                                  (F.avg("labels") > 0.5).cast("int").alias("labels"))


register("prediction_vote", sql=with_fixtures("SELECT id, count(*) AS n_votes, CAST(avg(labels) > 0.5 AS INTEGER) AS labels FROM ("
                                              + " UNION ALL ".join(f"SELECT id, CAST(score >= {t}::DOUBLE AS INTEGER) AS labels FROM scored"
                                                                   for t in VOTE_RULES) + ") GROUP BY id", "scored"))(prediction_vote)
