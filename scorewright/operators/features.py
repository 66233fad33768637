"""Feature derivation sets A-E as pure column expressions.

Each set is one ``withColumns`` projection (Catalyst collapses it into the scan's
codegen stage).  Sets with table statistics follow fit / apply:
``fit_x(train) -> dict`` (one aggregate job, a few scalars read back) and
``derive_x(df, stats)`` (a projection with the scalars as literals), so the
statistics of the training part are reused for the scoring part.

Abbreviations below: F funding_total_usd, R funding_rounds, M milestones,
L relationships, P avg_participants, aff/alf/afm/alm age first/last
funding/milestone year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nullsafe import all_of, any_of, flag, np_maximum, np_minimum, nz, row_stats
from ..functions.quantiles import exact_quantiles

c = F.col

FUND, ROUNDS, MILES, RELS, PART = (
    "funding_total_usd", "funding_rounds", "milestones", "relationships", "avg_participants")
AFF, ALF, AFM, ALM = (
    "age_first_funding_year", "age_last_funding_year", "age_first_milestone_year",
    "age_last_milestone_year")

# Per-location and per-sector success rates hard-coded in the reference's
# scored feature set (location_success_score, sector_success_score), in its order.
LOCATION_RATES = [("is_MA", 0.82), ("is_NY", 0.70), ("is_CA", 0.69), ("is_TX", 0.46),
                  ("is_otherstate", 0.46)]
SECTOR_RATES = [("is_enterprise", 0.75), ("is_advertising", 0.69), ("is_web", 0.68),
                ("is_biotech", 0.68), ("is_mobile", 0.66), ("is_software", 0.64),
                ("is_gamesvideo", 0.62), ("is_othercategory", 0.62), ("is_consulting", 0.50),
                ("is_ecommerce", 0.40)]


def _weighted(pairs) -> Column:
    out = None
    for name, w in pairs:
        term = c(name) * F.lit(w)
        out = term if out is None else out + term
    return out


def _per_million(x) -> Column:
    return c(FUND) / F.lit(1e6) + F.lit(x)


# ---------------------------------------------------------------- Set A: base
def fit_base(df: DataFrame) -> dict:
    return exact_quantiles(df, {
        "alm_median": (ALM, 0.5), "alf_median": (ALF, 0.5),
        "funding_median": (FUND, 0.5), "milestones_median": (MILES, 0.5)})


def derive_base(df: DataFrame, stats: dict) -> DataFrame:
    s = stats
    eps = F.lit(1e-9)
    return df.withColumns({
        "funding_per_round": c(FUND) / (c(ROUNDS) + eps),
        "milestones_per_year": c(MILES) / (nz(ALM, s["alm_median"]) + 1),
        "funding_per_year": c(FUND) / (nz(ALF, s["alf_median"]) + 1),
        "participants_per_round": c(PART) / (c(ROUNDS) + eps),
        "relationships_per_round": c(RELS) / (c(ROUNDS) + eps),
        "is_CA_software": c("is_CA") * c("is_software"),
        "is_NY_advertising": c("is_NY") * c("is_advertising"),
        "is_MA_biotech": c("is_MA") * c("is_biotech"),
        "is_high_funding": flag(c(FUND) > F.lit(s["funding_median"])),
        "is_high_milestones": flag(c(MILES) > F.lit(s["milestones_median"])),
        "time_to_first_milestone_after_funding": c(AFM) - c(AFF),
        "milestone_per_million": c(MILES) / _per_million(1.0),
    })


BASE_COLUMNS = ["funding_per_round", "milestones_per_year", "funding_per_year",
                "participants_per_round", "relationships_per_round", "is_CA_software",
                "is_NY_advertising", "is_MA_biotech", "is_high_funding", "is_high_milestones",
                "time_to_first_milestone_after_funding", "milestone_per_million"]


# ------------------------------------------------------------ Set B: extended
def _traction() -> Column:
    return c(FUND) / F.lit(1e6) * c(MILES) * c(RELS)


def fit_extended(df: DataFrame) -> dict:
    return exact_quantiles(df, {
        "traction_q75": (_traction(), 0.75), "relationships_median": (RELS, 0.5),
        "milestones_median": (MILES, 0.5), "funding_median": (FUND, 0.5)})


def derive_extended(df: DataFrame, stats: dict) -> DataFrame:
    s = stats
    step1 = df.withColumns({
        "has_multiple_funding_types": flag(c("has_VC") + c("has_angel") >= 2),
        "advanced_funding_rounds": flag(c("has_roundC") + c("has_roundD") >= 1),
        "funding_progression_score": c("has_roundA") + c("has_roundB") + c("has_roundC") + c("has_roundD"),
        "funding_velocity": c(FUND) / (nz(ALF, 1.0) + 1),
        "milestone_momentum": c(MILES) / (nz(ALM, 1.0) + 1),
        "network_density": c(RELS) * c(PART) / (c(ROUNDS) + 1),
        "ecosystem_strength": c(RELS) + c(MILES) + c(ROUNDS),
        "traction_score": _traction(),
        "efficiency_ratio": c(MILES) / _per_million(1.0),
        "capital_efficiency": c(RELS) / _per_million(1.0),
        "funding_milestone_alignment": F.abs(nz(ALF, 0.0) - nz(ALM, 0.0)),
        "is_high_growth_sector": c("is_software") + c("is_biotech") + c("is_mobile") + c("is_enterprise"),
        "is_traditional_sector": c("is_consulting") + c("is_advertising"),
        "is_innovation_hub": c("is_CA") + c("is_NY") + c("is_MA"),
        "scale_readiness": flag(c(ROUNDS) >= 3) + flag(c(RELS) >= F.lit(s["relationships_median"]))
        + flag(c(MILES) >= F.lit(s["milestones_median"])),
        "competitive_moat": c(MILES) * c(RELS) / (c(ROUNDS) + 1),
    })
    step2 = step1.withColumns({
        "is_high_traction": flag(c("traction_score") > F.lit(s["traction_q75"])),
        "is_well_timed_funding": flag(c("funding_milestone_alignment") <= 1),
        "innovation_hub_tech": c("is_innovation_hub") * c("is_high_growth_sector"),
        "diversified_funding": c("funding_progression_score") * c("has_multiple_funding_types"),
        "market_position_strength": c(FUND) / (F.lit(s["funding_median"]) + 1) * c("milestone_momentum"),
    })
    return step2.withColumn(
        "sustainable_growth_pattern",
        c("is_well_timed_funding") * c("efficiency_ratio") * c("network_density"))


EXTENDED_COLUMNS = [
    "has_multiple_funding_types", "advanced_funding_rounds", "funding_progression_score",
    "funding_velocity", "milestone_momentum", "network_density", "ecosystem_strength",
    "traction_score", "is_high_traction", "efficiency_ratio", "capital_efficiency",
    "funding_milestone_alignment", "is_well_timed_funding", "is_high_growth_sector",
    "is_traditional_sector", "is_innovation_hub", "innovation_hub_tech", "scale_readiness",
    "diversified_funding", "sustainable_growth_pattern", "competitive_moat",
    "market_position_strength"]


# ------------------------------------------------- Set C / D shared
def _shared_core() -> dict[str, Column]:
    return {
        "milestones_per_funding_round": c(MILES) / (c(ROUNDS) + 0.1),
        "avg_funding_per_round": c(FUND) / (c(ROUNDS) + 0.1),
        "relationships_per_milestone": c(RELS) / (c(MILES) + 0.1),
        "time_to_first_funding": nz(AFF, 999.0),
        "funding_duration": nz(c(ALF) - c(AFF), 0.0),
        "time_to_first_milestone": nz(AFM, 999.0),
        "milestone_duration": nz(c(ALM) - c(AFM), 0.0),
        "funding_progression_score": c("has_roundA") * 1 + c("has_roundB") * 2
        + c("has_roundC") * 3 + c("has_roundD") * 4,
        "funding_diversity": c("has_VC") + c("has_angel"),
        "has_later_stage": any_of(c("has_roundC") == 1, c("has_roundD") == 1),
    }


# -------------------------------------------------------------- Set C: scored
def derive_scored(df: DataFrame) -> DataFrame:
    step1 = df.withColumns({
        **_shared_core(),
        "location_success_score": _weighted(LOCATION_RATES),
        "is_top_tier_location": any_of(c("is_CA") == 1, c("is_NY") == 1, c("is_MA") == 1),
        "sector_success_score": _weighted(SECTOR_RATES),
        "is_high_success_sector": any_of(c("is_enterprise") == 1, c("is_advertising") == 1,
                                         c("is_web") == 1, c("is_biotech") == 1),
        "total_activity_score": c(RELS) + c(MILES) + c(ROUNDS),
        "funding_efficiency": c(RELS) / _per_million(0.1),
        "is_mature_startup": all_of(c(MILES) >= 2, c(ROUNDS) >= 2),
        "has_recent_milestones": flag(nz(ALM, 999.0) <= 3),
    })
    return step1.withColumns({
        "location_tech_interaction": c("is_top_tier_location")
        * (c("is_software") + c("is_web") + c("is_mobile")),
        "funding_relationships_interaction": c("funding_progression_score") * c(RELS),
        "maturity_funding_interaction": c("is_mature_startup") * F.log1p(c(FUND)),
    })


SCORED_COLUMNS = [
    "milestones_per_funding_round", "avg_funding_per_round", "relationships_per_milestone",
    "time_to_first_funding", "funding_duration", "time_to_first_milestone",
    "milestone_duration", "funding_progression_score", "funding_diversity", "has_later_stage",
    "location_success_score", "is_top_tier_location", "sector_success_score",
    "is_high_success_sector", "total_activity_score", "funding_efficiency", "is_mature_startup",
    "location_tech_interaction", "funding_relationships_interaction",
    "maturity_funding_interaction", "has_recent_milestones"]


# ------------------------------------------------------------ Set D: improved
def fit_improved(df: DataFrame) -> dict:
    return exact_quantiles(df, {"funding_median": (FUND, 0.5), "relationships_q75": (RELS, 0.75)})


SUCCESS_SIGNALS = ("has_later_stage", "is_innovation_hub", "high_quality_network")


def derive_improved(df: DataFrame, stats: dict, success_signals: Sequence[str] = SUCCESS_SIGNALS) -> DataFrame:
    """Set D.  The reference reads three columns it never creates; ``milestone_recency``
    is defined by analogy with ``funding_recency`` and the other two are left out of
    ``success_signals`` (a parameter)."""
    s = stats
    step1 = df.withColumns({
        **_shared_core(),
        "is_innovation_hub": any_of(c("is_CA") == 1, c("is_NY") == 1, c("is_MA") == 1),
        "is_secondary_hub": flag(c("is_TX") == 1),
        "is_tech_sector": any_of(c("is_software") == 1, c("is_web") == 1, c("is_mobile") == 1),
        "is_high_capital_sector": any_of(c("is_biotech") == 1, c("is_enterprise") == 1),
        "is_consumer_facing": any_of(c("is_ecommerce") == 1, c("is_advertising") == 1,
                                     c("is_gamesvideo") == 1),
        "network_density": c(RELS) / (c(ROUNDS) + 1),
        "relationship_efficiency": c(MILES) / (c(RELS) + 0.1),
        "team_network_strength": c(RELS) * c(MILES) / 10,
        "founder_experience_proxy": np_minimum(c(RELS) / 5, F.lit(3.0)),
        "team_size_proxy": F.log1p(c(RELS)) / 2,
        "capital_efficiency": c(MILES) / _per_million(0.1),
        "funding_momentum": c(ROUNDS) / (c(ALF) + 0.1),
        "funding_velocity": c(FUND) / (c(ALF) + 0.1),
        "development_speed": c(MILES) / (c(ROUNDS) + 0.1),
        "market_validation_score": flag(c(MILES) > 0) + flag(c(ROUNDS) > 1) + flag(c("has_VC") == 1),
        "customer_traction_proxy": c(RELS) * c(MILES) / (c(ROUNDS) + 1),
        "milestone_stagnation_risk": flag(nz(ALM, 999.0) > 3),
        "funding_gap_risk": np_maximum(F.lit(0.0), c(ALF) - 2),
        "low_activity_risk": any_of(c(MILES) == 0, c(RELS) < 3),
        "funding_recency": F.lit(10.0) - nz(ALF, 10.0),
        "milestone_recency": F.lit(10.0) - nz(ALM, 10.0),
        "high_quality_network": flag(c(RELS) > F.lit(s["relationships_q75"])),
    })
    step2 = step1.withColumns({
        "burn_rate_proxy": c(FUND) / (c("funding_duration") + 0.1),
        "traction_proxy": c(MILES) / (c("time_to_first_funding") + 1),
        "product_maturity": np_minimum(c("milestone_duration") / 2, F.lit(5.0)),
        "funding_concentration_risk": c("avg_funding_per_round") / (c(FUND) + 0.1),
        "late_funding_risk": flag(c("time_to_first_funding") > 2),
        "startup_maturity_score": flag(c(MILES) >= 1) + flag(c(ROUNDS) >= 2) + flag(c(RELS) >= 5)
        + flag(c("has_later_stage") == 1) * 2,
        "scale_readiness": all_of(c("funding_progression_score") >= 2, c(MILES) >= 2, c(RELS) >= 3),
        "optimal_funding_timing": all_of(c("time_to_first_funding") >= 0.5,
                                         c("time_to_first_funding") <= 2.0),
        "funding_consistency": F.lit(1.0) / (c("funding_duration") + 0.1),
        "competitive_positioning": c("is_innovation_hub") * 2 + c("is_tech_sector")
        + flag(c(FUND) > F.lit(s["funding_median"])),
        "location_funding_synergy": c("is_innovation_hub") * F.log1p(c(FUND)),
        "sector_funding_fit": c("is_high_capital_sector") * c("funding_progression_score"),
        "team_market_fit": c("network_density") * c("market_validation_score"),
        "execution_capability": c("development_speed") * c("capital_efficiency"),
        "activity_recency_score": c("funding_recency") + c("milestone_recency"),
    })
    signals = None
    for name in success_signals:
        signals = c(name) if signals is None else signals + c(name)
    return step2.withColumns({
        "runway_efficiency": c(MILES) / (c("burn_rate_proxy") + 0.1),
        "growth_stage_indicator": np_minimum(
            c("funding_progression_score") + c("startup_maturity_score"), F.lit(8)),
        "overall_health_score": c("startup_maturity_score") * 0.3 + c("market_validation_score") * 0.4
        + c("competitive_positioning") * 0.3,
        "investment_attractiveness": c("funding_progression_score") * 0.4 + c("capital_efficiency") * 0.3
        + c("network_density") * 0.3,
        "success_signals": signals,
    })


IMPROVED_COLUMNS = [
    "milestones_per_funding_round", "avg_funding_per_round", "relationships_per_milestone",
    "time_to_first_funding", "funding_duration", "time_to_first_milestone", "milestone_duration",
    "funding_progression_score", "funding_diversity", "has_later_stage", "is_innovation_hub",
    "is_secondary_hub", "is_tech_sector", "is_high_capital_sector", "is_consumer_facing",
    "network_density", "relationship_efficiency", "team_network_strength",
    "founder_experience_proxy", "team_size_proxy", "capital_efficiency", "funding_momentum",
    "funding_velocity", "burn_rate_proxy", "runway_efficiency", "traction_proxy",
    "development_speed", "market_validation_score", "customer_traction_proxy",
    "product_maturity", "funding_concentration_risk", "milestone_stagnation_risk",
    "late_funding_risk", "funding_gap_risk", "low_activity_risk", "startup_maturity_score",
    "scale_readiness", "growth_stage_indicator", "optimal_funding_timing", "funding_consistency",
    "competitive_positioning", "location_funding_synergy", "sector_funding_fit",
    "team_market_fit", "execution_capability", "overall_health_score",
    "investment_attractiveness", "funding_recency", "milestone_recency",
    "activity_recency_score", "high_quality_network", "success_signals"]


# ------------------------------------------------------------ Set E: automatic
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def auto_numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]


def derive_auto(df: DataFrame, exclude: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise products / ratios of the first numeric columns and row statistics.

    Keys and targets belong in ``exclude`` (the reference keeps its id here);
    ``columns`` fixes the inputs (fitted once, replayed on scoring data).
    """
    nums = list(columns) if columns is not None else auto_numeric_columns(df, exclude)
    if len(nums) <= 1:
        return df
    new: dict[str, Column] = {}
    for i, a in enumerate(nums[:3]):
        for b in nums[i + 1:4]:
            new[f"{a}_x_{b}"] = c(a) * c(b)
            new[f"{a}_div_{b}"] = c(a) / (c(b) + F.lit(1e-8))
    stats = row_stats(nums)
    new["numeric_sum"] = stats["sum"]
    new["numeric_mean"] = stats["mean"]
    new["numeric_std"] = stats["std"]
    return df.withColumns(new)
