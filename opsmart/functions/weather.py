"""Daily weather: description, risk flags, risk score and regime."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .core import band, col, flag


def mean_temperature(high: Column | str, low: Column | str) -> Column:
    return F.round((col(high) + col(low)) / 2, 1)


def description(code: Column | str) -> Column:
    return band(code, rules.WEATHER_DESCRIPTION, rules.WEATHER_DESCRIPTION_ELSE)


def freeze_risk(low: Column | str, below: float = rules.FREEZE_BELOW_F) -> Column:
    return flag(col(low) < below)


def heat_alert(high: Column | str, above: float = rules.HEAT_ABOVE_F) -> Column:
    return flag(col(high) > above)


def high_wind(speed: Column | str, above: float = rules.WIND_ABOVE_MPH) -> Column:
    return flag(col(speed) > above)


def heavy_precip(amount: Column | str, above: float = rules.PRECIP_ABOVE, unit_scale: float = 1.0) -> Column:
    """``unit_scale`` converts the stored unit (for example 1/25.4 for millimetres) before the comparison."""
    amount = col(amount) if unit_scale == 1.0 else col(amount) * F.lit(unit_scale)
    return flag(amount > above)


def risk_score(*flags: Column | str) -> Column:
    return sum((col(f) for f in flags[1:]), col(flags[0]))


def risk_label(score: Column | str) -> Column:
    return band(score, rules.OPS_RISK_LABEL, rules.OPS_RISK_LABEL_ELSE)


def regime(
    order: Sequence[str] = rules.OUTAGE_REGIME_ORDER,
    wind: Column | str = "is_high_wind",
    freeze: Column | str = "is_freeze_risk",
    precip: Column | str = "is_heavy_precip",
    heat: Column | str = "is_heat_alert",
) -> Column:
    """Name of the first raised flag in ``order``; 'none' on a calm day."""
    flags = {"wind": wind, "freeze": freeze, "precip": precip, "heat": heat}
    chain = F
    for name in order:
        chain = chain.when(col(flags[name]) == 1, F.lit(name))
    return chain.otherwise(F.lit("none"))
