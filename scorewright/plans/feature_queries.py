"""Registered queries: feature derivation (sets A-E) and the flagship summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fx
from ..operators import profile as pf
from ..sources.fixtures import account, account_m
from .oracle_fixtures import with_fixtures
from .registry import register

D = "::DOUBLE"


def _num(x) -> str:
    return f"{x}{D}"


# ----------------------------------------------------------------- flagship
def category_summary(spark, sf_dir):
    acc = account_m(spark, sf_dir)
    feats = fx.derive_base(acc, fx.fit_base(acc))
    summary = feats.groupBy("category_code").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.avg("labels").alias("success_rate"),
        F.avg("funding_per_round").alias("avg_funding_per_round"),
        F.sum("is_high_funding").cast("bigint").alias("n_high_funding"),
    )
    # exact per-category median without a per-group value map (one row per category)
    medians = pf.grouped_quantile(acc, "category_code", "funding_total_usd", 0.5, "funding_median")
    return summary.join(medians, "category_code", "left")


register("category_summary", doubles=("success_rate", "funding_median", "avg_funding_per_round"),
         sql=with_fixtures("""
SELECT category_code,
       count(*) AS n_accounts,
       avg(labels) AS success_rate,
       median(funding_total_usd) AS funding_median,
       avg(funding_total_usd / (funding_rounds + 1e-9::DOUBLE)) AS avg_funding_per_round,
       CAST(sum(CAST(coalesce(funding_total_usd > (SELECT median(funding_total_usd) FROM account), false) AS INTEGER)) AS BIGINT) AS n_high_funding
FROM account GROUP BY category_code""", "account"))(category_summary)


# ------------------------------------------------------------------ Set A
def features_base(spark, sf_dir):
    acc = account_m(spark, sf_dir)
    return fx.derive_base(acc, fx.fit_base(acc)).select("id", *fx.BASE_COLUMNS)


register("features_base", doubles=(
    "funding_per_round", "milestones_per_year", "funding_per_year", "participants_per_round",
    "relationships_per_round", "time_to_first_milestone_after_funding", "milestone_per_million"),
    sql=with_fixtures("""
SELECT id,
  funding_total_usd / (funding_rounds + 1e-9::DOUBLE) AS funding_per_round,
  milestones / (coalesce(age_last_milestone_year, (SELECT median(age_last_milestone_year) FROM account)) + 1) AS milestones_per_year,
  funding_total_usd / (coalesce(age_last_funding_year, (SELECT median(age_last_funding_year) FROM account)) + 1) AS funding_per_year,
  avg_participants / (funding_rounds + 1e-9::DOUBLE) AS participants_per_round,
  relationships / (funding_rounds + 1e-9::DOUBLE) AS relationships_per_round,
  is_CA * is_software AS is_CA_software,
  is_NY * is_advertising AS is_NY_advertising,
  is_MA * is_biotech AS is_MA_biotech,
  CAST(coalesce(funding_total_usd > (SELECT median(funding_total_usd) FROM account), false) AS INTEGER) AS is_high_funding,
  CAST(coalesce(milestones > (SELECT median(milestones) FROM account), false) AS INTEGER) AS is_high_milestones,
  age_first_milestone_year - age_first_funding_year AS time_to_first_milestone_after_funding,
  milestones / (funding_total_usd / 1000000.0::DOUBLE + 1) AS milestone_per_million
FROM account""", "account"))(features_base)


# ------------------------------------------------------------------ Set B
def features_extended(spark, sf_dir):
    acc = account_m(spark, sf_dir)
    return fx.derive_extended(acc, fx.fit_extended(acc)).select("id", *fx.EXTENDED_COLUMNS)


register("features_extended", doubles=(
    "funding_velocity", "milestone_momentum", "network_density", "traction_score",
    "efficiency_ratio", "capital_efficiency", "funding_milestone_alignment",
    "sustainable_growth_pattern", "competitive_moat", "market_position_strength"),
    sql=with_fixtures("""
SELECT id,
  CAST(coalesce(has_VC + has_angel >= 2, false) AS INTEGER) AS has_multiple_funding_types,
  CAST(coalesce(has_roundC + has_roundD >= 1, false) AS INTEGER) AS advanced_funding_rounds,
  has_roundA + has_roundB + has_roundC + has_roundD AS funding_progression_score,
  funding_total_usd / (coalesce(age_last_funding_year, 1.0::DOUBLE) + 1) AS funding_velocity,
  milestones / (coalesce(age_last_milestone_year, 1.0::DOUBLE) + 1) AS milestone_momentum,
  relationships * avg_participants / (funding_rounds + 1) AS network_density,
  relationships + milestones + funding_rounds AS ecosystem_strength,
  funding_total_usd / 1000000.0::DOUBLE * milestones * relationships AS traction_score,
  CAST(coalesce(funding_total_usd / 1000000.0::DOUBLE * milestones * relationships >
       (SELECT quantile_cont(funding_total_usd / 1000000.0::DOUBLE * milestones * relationships, 0.75) FROM account), false) AS INTEGER) AS is_high_traction,
  milestones / (funding_total_usd / 1000000.0::DOUBLE + 1) AS efficiency_ratio,
  relationships / (funding_total_usd / 1000000.0::DOUBLE + 1) AS capital_efficiency,
  abs(coalesce(age_last_funding_year, 0.0::DOUBLE) - coalesce(age_last_milestone_year, 0.0::DOUBLE)) AS funding_milestone_alignment,
  CAST(coalesce(abs(coalesce(age_last_funding_year, 0.0::DOUBLE) - coalesce(age_last_milestone_year, 0.0::DOUBLE)) <= 1, false) AS INTEGER) AS is_well_timed_funding,
  is_software + is_biotech + is_mobile + is_enterprise AS is_high_growth_sector,
  is_consulting + is_advertising AS is_traditional_sector,
  is_CA + is_NY + is_MA AS is_innovation_hub,
  (is_CA + is_NY + is_MA) * (is_software + is_biotech + is_mobile + is_enterprise) AS innovation_hub_tech,
  CAST(coalesce(funding_rounds >= 3, false) AS INTEGER)
    + CAST(coalesce(relationships >= (SELECT median(relationships) FROM account), false) AS INTEGER)
    + CAST(coalesce(milestones >= (SELECT median(milestones) FROM account), false) AS INTEGER) AS scale_readiness,
  (has_roundA + has_roundB + has_roundC + has_roundD)
    * CAST(coalesce(has_VC + has_angel >= 2, false) AS INTEGER) AS diversified_funding,
  CAST(coalesce(abs(coalesce(age_last_funding_year, 0.0::DOUBLE) - coalesce(age_last_milestone_year, 0.0::DOUBLE)) <= 1, false) AS INTEGER)
    * (milestones / (funding_total_usd / 1000000.0::DOUBLE + 1))
    * (relationships * avg_participants / (funding_rounds + 1)) AS sustainable_growth_pattern,
  milestones * relationships / (funding_rounds + 1) AS competitive_moat,
  funding_total_usd / ((SELECT median(funding_total_usd) FROM account) + 1)
    * (milestones / (coalesce(age_last_milestone_year, 1.0::DOUBLE) + 1)) AS market_position_strength
FROM account""", "account"))(features_extended)


# ---------------------------------------------------------- Set C and D core
_CORE_SQL = """
  milestones / (funding_rounds + 0.1::DOUBLE) AS milestones_per_funding_round,
  funding_total_usd / (funding_rounds + 0.1::DOUBLE) AS avg_funding_per_round,
  relationships / (milestones + 0.1::DOUBLE) AS relationships_per_milestone,
  coalesce(age_first_funding_year, 999.0::DOUBLE) AS time_to_first_funding,
  coalesce(age_last_funding_year - age_first_funding_year, 0.0::DOUBLE) AS funding_duration,
  coalesce(age_first_milestone_year, 999.0::DOUBLE) AS time_to_first_milestone,
  coalesce(age_last_milestone_year - age_first_milestone_year, 0.0::DOUBLE) AS milestone_duration,
  has_roundA * 1 + has_roundB * 2 + has_roundC * 3 + has_roundD * 4 AS funding_progression_score,
  has_VC + has_angel AS funding_diversity,
  CAST(coalesce(has_roundC = 1, false) OR coalesce(has_roundD = 1, false) AS INTEGER) AS has_later_stage"""

_CORE_DOUBLES = ("milestones_per_funding_round", "avg_funding_per_round",
                 "relationships_per_milestone", "time_to_first_funding", "funding_duration",
                 "time_to_first_milestone", "milestone_duration")


SCORED_LIST = f"""{_CORE_SQL},
  is_MA * 0.82::DOUBLE + is_NY * 0.70::DOUBLE + is_CA * 0.69::DOUBLE + is_TX * 0.46::DOUBLE
    + is_otherstate * 0.46::DOUBLE AS location_success_score,
  CAST(coalesce(is_CA = 1, false) OR coalesce(is_NY = 1, false) OR coalesce(is_MA = 1, false) AS INTEGER) AS is_top_tier_location,
  is_enterprise * 0.75::DOUBLE + is_advertising * 0.69::DOUBLE + is_web * 0.68::DOUBLE
    + is_biotech * 0.68::DOUBLE + is_mobile * 0.66::DOUBLE + is_software * 0.64::DOUBLE
    + is_gamesvideo * 0.62::DOUBLE + is_othercategory * 0.62::DOUBLE
    + is_consulting * 0.50::DOUBLE + is_ecommerce * 0.40::DOUBLE AS sector_success_score,
  CAST(coalesce(is_enterprise = 1, false) OR coalesce(is_advertising = 1, false)
       OR coalesce(is_web = 1, false) OR coalesce(is_biotech = 1, false) AS INTEGER) AS is_high_success_sector,
  relationships + milestones + funding_rounds AS total_activity_score,
  relationships / (funding_total_usd / 1000000.0::DOUBLE + 0.1::DOUBLE) AS funding_efficiency,
  CAST(coalesce(milestones >= 2, false) AND coalesce(funding_rounds >= 2, false) AS INTEGER) AS is_mature_startup,
  is_top_tier_location * (is_software + is_web + is_mobile) AS location_tech_interaction,
  funding_progression_score * relationships AS funding_relationships_interaction,
  is_mature_startup * ln(1 + funding_total_usd) AS maturity_funding_interaction,
  CAST(coalesce(coalesce(age_last_milestone_year, 999.0::DOUBLE) <= 3, false) AS INTEGER) AS has_recent_milestones
"""


def features_scored(spark, sf_dir):
    return fx.derive_scored(account(spark, sf_dir)).select("id", *fx.SCORED_COLUMNS)


register("features_scored", doubles=_CORE_DOUBLES + (
    "location_success_score", "sector_success_score", "funding_efficiency",
    "maturity_funding_interaction"),
    sql=with_fixtures(f"SELECT id, {SCORED_LIST}\nFROM account", "account"))(features_scored)


def features_improved(spark, sf_dir):
    acc = account_m(spark, sf_dir)
    return fx.derive_improved(acc, fx.fit_improved(acc)).select("id", *fx.IMPROVED_COLUMNS)


register("features_improved", doubles=_CORE_DOUBLES + (
    "network_density", "relationship_efficiency", "team_network_strength",
    "founder_experience_proxy", "team_size_proxy", "capital_efficiency", "funding_momentum",
    "funding_velocity", "burn_rate_proxy", "runway_efficiency", "traction_proxy",
    "development_speed", "customer_traction_proxy", "product_maturity",
    "funding_concentration_risk", "funding_gap_risk", "funding_consistency",
    "location_funding_synergy", "team_market_fit", "execution_capability",
    "overall_health_score", "investment_attractiveness", "funding_recency",
    "milestone_recency", "activity_recency_score"),
    sql=with_fixtures(f"""
SELECT id, {_CORE_SQL},
  CAST(coalesce(is_CA = 1, false) OR coalesce(is_NY = 1, false) OR coalesce(is_MA = 1, false) AS INTEGER) AS is_innovation_hub,
  CAST(coalesce(is_TX = 1, false) AS INTEGER) AS is_secondary_hub,
  CAST(coalesce(is_software = 1, false) OR coalesce(is_web = 1, false) OR coalesce(is_mobile = 1, false) AS INTEGER) AS is_tech_sector,
  CAST(coalesce(is_biotech = 1, false) OR coalesce(is_enterprise = 1, false) AS INTEGER) AS is_high_capital_sector,
  CAST(coalesce(is_ecommerce = 1, false) OR coalesce(is_advertising = 1, false) OR coalesce(is_gamesvideo = 1, false) AS INTEGER) AS is_consumer_facing,
  relationships / (funding_rounds + 1) AS network_density,
  milestones / (relationships + 0.1::DOUBLE) AS relationship_efficiency,
  relationships * milestones / 10 AS team_network_strength,
  CASE WHEN relationships IS NOT NULL THEN least(relationships / 5, 3.0::DOUBLE) END AS founder_experience_proxy,
  ln(1 + relationships) / 2 AS team_size_proxy,
  milestones / (funding_total_usd / 1000000.0::DOUBLE + 0.1::DOUBLE) AS capital_efficiency,
  funding_rounds / (age_last_funding_year + 0.1::DOUBLE) AS funding_momentum,
  funding_total_usd / (age_last_funding_year + 0.1::DOUBLE) AS funding_velocity,
  funding_total_usd / (funding_duration + 0.1::DOUBLE) AS burn_rate_proxy,
  milestones / (burn_rate_proxy + 0.1::DOUBLE) AS runway_efficiency,
  milestones / (time_to_first_funding + 1) AS traction_proxy,
  milestones / (funding_rounds + 0.1::DOUBLE) AS development_speed,
  CAST(coalesce(milestones > 0, false) AS INTEGER) + CAST(coalesce(funding_rounds > 1, false) AS INTEGER)
    + CAST(coalesce(has_VC = 1, false) AS INTEGER) AS market_validation_score,
  relationships * milestones / (funding_rounds + 1) AS customer_traction_proxy,
  least(milestone_duration / 2, 5.0::DOUBLE) AS product_maturity,
  avg_funding_per_round / (funding_total_usd + 0.1::DOUBLE) AS funding_concentration_risk,
  CAST(coalesce(coalesce(age_last_milestone_year, 999.0::DOUBLE) > 3, false) AS INTEGER) AS milestone_stagnation_risk,
  CAST(coalesce(time_to_first_funding > 2, false) AS INTEGER) AS late_funding_risk,
  CASE WHEN age_last_funding_year IS NOT NULL THEN greatest(0.0::DOUBLE, age_last_funding_year - 2) END AS funding_gap_risk,
  CAST(coalesce(milestones = 0, false) OR coalesce(relationships < 3, false) AS INTEGER) AS low_activity_risk,
  CAST(coalesce(milestones >= 1, false) AS INTEGER) + CAST(coalesce(funding_rounds >= 2, false) AS INTEGER)
    + CAST(coalesce(relationships >= 5, false) AS INTEGER) + CAST(coalesce(has_later_stage = 1, false) AS INTEGER) * 2 AS startup_maturity_score,
  CAST(coalesce(funding_progression_score >= 2, false) AND coalesce(milestones >= 2, false)
       AND coalesce(relationships >= 3, false) AS INTEGER) AS scale_readiness,
  least(funding_progression_score + startup_maturity_score, 8) AS growth_stage_indicator,
  CAST(coalesce(time_to_first_funding >= 0.5, false) AND coalesce(time_to_first_funding <= 2.0, false) AS INTEGER) AS optimal_funding_timing,
  1.0::DOUBLE / (funding_duration + 0.1::DOUBLE) AS funding_consistency,
  is_innovation_hub * 2 + is_tech_sector
    + CAST(coalesce(funding_total_usd > st.f_med, false) AS INTEGER) AS competitive_positioning,
  is_innovation_hub * ln(1 + funding_total_usd) AS location_funding_synergy,
  is_high_capital_sector * funding_progression_score AS sector_funding_fit,
  network_density * market_validation_score AS team_market_fit,
  development_speed * capital_efficiency AS execution_capability,
  startup_maturity_score * 0.3::DOUBLE + market_validation_score * 0.4::DOUBLE
    + competitive_positioning * 0.3::DOUBLE AS overall_health_score,
  funding_progression_score * 0.4::DOUBLE + capital_efficiency * 0.3::DOUBLE
    + network_density * 0.3::DOUBLE AS investment_attractiveness,
  10.0::DOUBLE - coalesce(age_last_funding_year, 10.0::DOUBLE) AS funding_recency,
  10.0::DOUBLE - coalesce(age_last_milestone_year, 10.0::DOUBLE) AS milestone_recency,
  funding_recency + milestone_recency AS activity_recency_score,
  CAST(coalesce(relationships > st.l_q75, false) AS INTEGER) AS high_quality_network,
  has_later_stage + is_innovation_hub + high_quality_network AS success_signals
FROM account, (SELECT median(funding_total_usd) AS f_med, quantile_cont(relationships, 0.75) AS l_q75 FROM account) st""", "account"))(features_improved)


# ------------------------------------------------------------------ Set E
_AUTO_EXCLUDE = ("id", "labels", "labels_planted")


def features_auto(spark, sf_dir):
    acc = account(spark, sf_dir)
    derived = fx.derive_auto(acc, exclude=_AUTO_EXCLUDE)
    return derived.select("id", *[c for c in derived.columns if c not in acc.columns])


def _auto_sql() -> str:
    from ..sources.fixtures import ACCOUNT_COLUMNS
    nums = [c for c in ACCOUNT_COLUMNS if c not in _AUTO_EXCLUDE and c != "category_code"]
    sel = []
    for i, a in enumerate(nums[:3]):
        for b in nums[i + 1:4]:
            sel.append(f"{a} * {b} AS {a}_x_{b}")
            sel.append(f"{a} / ({b} + 1e-8::DOUBLE) AS {a}_div_{b}")
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in nums)
    s = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0::DOUBLE)" for c in nums)
    sel.append(f"0.0::DOUBLE + {s} AS numeric_sum")
    sel.append(f"CASE WHEN ({n}) > 0 THEN numeric_sum / ({n}) END AS numeric_mean")
    sq = " + ".join(
        f"coalesce((CAST({c} AS DOUBLE) - numeric_mean) * (CAST({c} AS DOUBLE) - numeric_mean), 0.0::DOUBLE)"
        for c in nums)
    sel.append(f"CASE WHEN ({n}) > 1 THEN sqrt((0.0::DOUBLE + {sq}) / (({n}) - 1)) END AS numeric_std")
    return with_fixtures("SELECT id,\n  " + ",\n  ".join(sel) + "\nFROM account", "account")


def _auto_doubles():
    from ..sources.fixtures import ACCOUNT_COLUMNS
    nums = [c for c in ACCOUNT_COLUMNS if c not in _AUTO_EXCLUDE and c != "category_code"]
    out = []
    for i, a in enumerate(nums[:3]):
        for b in nums[i + 1:4]:
            out += [f"{a}_x_{b}", f"{a}_div_{b}"]
    return tuple(out) + ("numeric_sum", "numeric_mean", "numeric_std")


register("features_auto", doubles=_auto_doubles(), sql=_auto_sql())(features_auto)
