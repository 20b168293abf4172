"""Outages, safety observations, crew shifts, spend and the cross-domain scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .core import band, col, contains_any, flag, in_flag, lookup, rounded_ratio


# outages
def duration_bucket(hours: Column | str) -> Column:
    return band(hours, rules.DURATION_BUCKET, rules.DURATION_BUCKET_ELSE)


def outage_type(cause: Column | str) -> Column:
    """Planned when the text contains 'planned' in any case, so 'Unplanned' counts as Planned too."""
    return F.when(contains_any(cause, rules.PLANNED_WORDS), F.lit("Planned")).otherwise(F.lit("Unplanned"))


def customer_impact_tier(customers: Column | str) -> Column:
    return band(customers, rules.CUSTOMER_IMPACT_TIER, rules.CUSTOMER_IMPACT_TIER_ELSE)


def customer_minutes_lost(customers: Column | str, hours: Column | str) -> Column:
    return F.round(col(customers) * col(hours) * 60, 0)


def outage_severity(
    customers: Column | str,
    hours: Column | str,
    steps: Sequence[tuple] = rules.OUTAGE_SEVERITY,
    otherwise: int = rules.OUTAGE_SEVERITY_ELSE,
) -> Column:
    """Lowest score whose two limits are both above the values."""
    chain = F
    for max_customers, max_hours, score in steps:
        chain = chain.when((col(customers) < max_customers) & (col(hours) < max_hours), F.lit(score))
    return chain.otherwise(F.lit(otherwise))


def weather_driven(cause: Column | str) -> Column:
    return in_flag(cause, rules.WEATHER_CAUSES)


# safety
def observation_category(observation: Column | str) -> Column:
    return F.when(col(observation) == "Positive Observation", F.lit("Positive")).otherwise(F.lit("Negative"))


def severity_score(severity: Column | str) -> Column:
    return lookup(severity, rules.SEVERITY_SCORE, default=0)


def closure_speed(days: Column | str) -> Column:
    return band(days, rules.CLOSURE_SPEED, rules.CLOSURE_SPEED_ELSE)


def safety_risk_index(score: Column | str, weather_risk: Column | str) -> Column:
    return F.round(col(score) * (col(weather_risk) + 1).cast("double"), 1)


def overdue(severity: Column | str, days: Column | str, allowed: Mapping[str, int] = rules.OVERDUE_DAYS) -> Column:
    chain = F
    for level, limit in allowed.items():
        chain = chain.when((col(severity) == level) & (col(days) > limit), F.lit(1))
    return chain.otherwise(F.lit(0))


def incident(observation: Column | str) -> Column:
    return in_flag(observation, rules.INCIDENT_TYPES)


# crew shifts
def shift_type(is_overtime: Column | str) -> Column:
    return F.when(col(is_overtime) == 1, F.lit("Overtime")).otherwise(F.lit("Regular"))


def cost_tier(labor_cost: Column | str) -> Column:
    return band(labor_cost, rules.COST_TIER, rules.COST_TIER_ELSE)


def emergency_deployment(job: Column | str) -> Column:
    return flag(contains_any(job, rules.EMERGENCY_WORDS))


def overtime_premium(is_overtime: Column | str, labor_cost: Column | str, hours: Column | str, rate: Column | str) -> Column:
    premium = F.round(col(labor_cost) - col(hours) * col(rate), 2)
    return F.when(col(is_overtime) == 1, premium).otherwise(F.lit(0.0))


def shift_length_bucket(hours: Column | str) -> Column:
    return band(hours, rules.SHIFT_LENGTH_BUCKET, rules.SHIFT_LENGTH_BUCKET_ELSE)


def labor_cost(hours: Column | str, rate: Column | str, is_overtime: Column | str) -> Column:
    factor = F.when(col(is_overtime) == 1, F.lit(rules.OVERTIME_FACTOR)).otherwise(F.lit(1.0))
    return F.round(col(hours) * col(rate) * factor, 2)


def crew_id(city: Column | str, number: Column | str) -> Column:
    """'DE-CREW-07' from a city name and a crew number."""
    digits = F.when(col(number) < 100, F.lpad(col(number).cast("string"), 2, "0")).otherwise(col(number).cast("string"))
    return F.concat(F.upper(F.substring(col(city), 1, 2)), F.lit("-CREW-"), digits)


# spend
def spend_tier(amount: Column | str) -> Column:
    return band(amount, rules.SPEND_TIER, rules.SPEND_TIER_ELSE)


def asset_category(asset: Column | str) -> Column:
    return F.when(col(asset).isin(rules.INFRASTRUCTURE_ASSETS), F.lit("Infrastructure")).otherwise(F.lit("Operational"))


def cost_per_risk_point(amount: Column | str, risk: Column | str) -> Column:
    return rounded_ratio(col(amount), col(risk), 2, otherwise=col(amount))


def high_spend(amount: Column | str, above: float = rules.HIGH_SPEND_ABOVE_USD) -> Column:
    return flag(col(amount) > above)


def risk_multiplier(mean_risk: Column | str, step: float = rules.RISK_COST_STEP) -> Column:
    return F.lit(1.0) + col(mean_risk) * F.lit(step)


def base_amount(amount: Column | str, asset: Column | str, cost_category: Column | str, mean_risk: Column | str) -> Column:
    """Amount with the asset, category and risk multipliers taken out; NULL for an unknown asset or category."""
    factor = (
        lookup(asset, rules.ASSET_MULTIPLIER)
        * lookup(cost_category, rules.CATEGORY_MULTIPLIER)
        * risk_multiplier(mean_risk)
    )
    return F.round(col(amount) / F.nullif(factor, F.lit(0.0)), 2)


# expectations by weather risk
def expected_outages(risk: Column | str, table: Mapping = rules.EXPECTED_OUTAGES) -> Column:
    return lookup(risk, table)


def expected_observations(risk: Column | str, table: Mapping = rules.EXPECTED_OBSERVATIONS) -> Column:
    return lookup(risk, table)


def required_crews(city: Column | str, risk: Column | str, base: Mapping = rules.BASE_CREWS, extra: Mapping = rules.EXTRA_CREWS) -> Column:
    return lookup(city, base) + lookup(risk, extra)


# cross-domain
def labor_cost_per_outage(labor: Column | str, outages: Column | str) -> Column:
    """0 without outages; NULL when there are outages but no labour was recorded."""
    outages = F.coalesce(col(outages), F.lit(0))
    return rounded_ratio(col(labor), outages, 2, otherwise=0.0)


def incident_rate_per_crew(incidents: Column | str, crews: Column | str) -> Column:
    crews = F.coalesce(col(crews), F.lit(0))
    return rounded_ratio(F.coalesce(col(incidents), F.lit(0)), crews, 4, otherwise=0.0)


def operational_stress(risk: Column | str, max_severity: Column | str, mean_severity: Column | str) -> Column:
    return F.round(
        col(risk) * F.lit(rules.STRESS_RISK_WEIGHT)
        + F.coalesce(col(max_severity), F.lit(0))
        + F.coalesce(col(mean_severity), F.lit(0.0)),
        1,
    )


def city_risk_label(mean_stress: Column | str) -> Column:
    return band(mean_stress, rules.CITY_RISK_LABEL, rules.CITY_RISK_LABEL_ELSE)


def clean_place(name: Column | str) -> Column:
    return F.regexp_replace(col(name), "_", " ")
