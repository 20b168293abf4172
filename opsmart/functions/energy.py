"""Demand, generation fleet and retail sales."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .core import band, category, col, in_flag, lookup, rounded_ratio


def load_tier(peak: Column | str) -> Column:
    """A NaN or NULL peak is a normal load."""
    peak = col(peak)
    return band(F.nanvl(peak, F.lit(None).cast("double")), rules.LOAD_TIER, rules.LOAD_TIER_ELSE)


def demand_swing(peak: Column | str, low: Column | str) -> Column:
    return F.round(col(peak) - col(low), 1)


def critical_peak(tier: Column | str) -> Column:
    return in_flag(tier, [rules.LOAD_TIER[0][2]])


def high_load(tier: Column | str) -> Column:
    return in_flag(tier, [step[2] for step in rules.LOAD_TIER[:2]])


def mwh_per_degree(peak: Column | str, degree_days: Column | str) -> Column:
    return rounded_ratio(col(peak), col(degree_days), 1)


def demand_pressure(peak: Column | str, reference_mw: float = rules.DEMAND_REFERENCE_MW) -> Column:
    """Peak on a 0-10 scale of the reference peak; it may exceed 10."""
    return F.round(col(peak) / F.lit(reference_mw) * 10, 2)


def operational_condition(
    mean_temp: Column | str,
    peak: Column | str,
    is_critical: Column | str,
    is_high: Column | str,
    hot: float = rules.HEAT_WAVE_F,
    cold: float = rules.COLD_SNAP_F,
    stressed: float = rules.STRESSED_PEAK_MWH,
) -> Column:
    busy = col(peak) >= stressed
    return (
        F.when((col(mean_temp) >= hot) & busy, F.lit("Heat Wave Stress"))
        .when((col(mean_temp) <= cold) & busy, F.lit("Cold Snap Stress"))
        .when(col(is_critical) == 1, F.lit("Grid Critical"))
        .when(col(is_high) == 1, F.lit("High Demand"))
        .otherwise(F.lit("Normal Operations"))
    )


def fuel_type(code: Column | str, table: Mapping[str, str] = rules.FUEL_BY_CODE) -> Column:
    """Readable fuel name; an unknown code is kept as it is."""
    return lookup(code, table, default=col(code))


def capacity_efficiency(net: Column | str, nameplate: Column | str) -> Column:
    return rounded_ratio(col(net), col(nameplate), 1, scale=100)


def clean_energy(fuel: Column | str) -> Column:
    return in_flag(fuel, rules.CLEAN_FUELS)


def dispatchable(fuel: Column | str) -> Column:
    return in_flag(fuel, rules.DISPATCHABLE_FUELS)


def generator_size_tier(net: Column | str) -> Column:
    return band(net, rules.GENERATOR_SIZE_TIER, rules.GENERATOR_SIZE_TIER_ELSE)


def fuel_category(fuel: Column | str) -> Column:
    return category(fuel, rules.FUEL_CATEGORIES, rules.FUEL_CATEGORY_ELSE)


def grid_dependency(share_pct: Column | str) -> Column:
    return band(share_pct, rules.GRID_DEPENDENCY_LABEL, rules.GRID_DEPENDENCY_LABEL_ELSE)


def sales_mwh(million_kwh: Column | str) -> Column:
    return F.round(col(million_kwh) * 1000, 0)


def revenue_usd(million_usd: Column | str) -> Column:
    return F.round(col(million_usd) * 1000000, 0)


def price_usd(cents: Column | str) -> Column:
    return F.round(col(cents) / 100, 4)


def revenue_per_customer(million_usd: Column | str, customers: Column | str) -> Column:
    return rounded_ratio(col(million_usd) * 1000000, col(customers), 2)


def sector_display(sector: Column | str, name: Column | str) -> Column:
    return lookup(sector, rules.SECTOR_DISPLAY, default=col(name))


def price_tier(cents: Column | str) -> Column:
    return band(cents, rules.PRICE_TIER, rules.PRICE_TIER_ELSE)
