"""Dates: seasons, names, ISO weeks, periods and degree days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .core import category, col, flag, lookup


def season(month: Column | str, null_to_fall: bool = False) -> Column:
    """Season of a month number. With ``null_to_fall`` everything outside the first three seasons is Fall."""
    if null_to_fall:
        return category(month, rules.SEASONS[:3], rules.SEASONS[3][0])
    return category(month, rules.SEASONS)


def day_name(date: Column | str) -> Column:
    return F.date_format(col(date), "EEEE")


def is_weekend(date: Column | str) -> Column:
    return flag(F.dayofweek(col(date)).isin(1, 7))


def day_of_week(date: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(col(date)) - 1


def iso_week(date: Column | str) -> Column:
    return F.weekofyear(col(date))


def month_short(date: Column | str) -> Column:
    return F.date_format(col(date), "MMM")


def month_long(month: Column | str) -> Column:
    """Full month name of a month number, NULL outside 1..12."""
    return lookup(month, dict(enumerate(rules.MONTH_NAMES, start=1)))


def period_to_month(period: Column | str) -> Column:
    """First day of a 'yyyy-MM' period; NULL for any other text, such as a bare year."""
    return F.try_to_date(col(period), "yyyy-MM")


def month_to_period(date: Column | str) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def within_last_months(date: Column | str, latest: Column, months: int = 12) -> Column:
    """1 when the date is not before ``latest - months``; both ends count, so 12 spans 13 month starts."""
    return flag(col(date) >= F.add_months(latest, -months))


def heating_degree_days(mean_temp: Column | str, base: float = rules.DEGREE_DAY_BASE_F) -> Column:
    mean_temp = col(mean_temp)
    return F.when(mean_temp < base, F.round(F.lit(base) - mean_temp, 1)).otherwise(F.lit(0.0))


def cooling_degree_days(mean_temp: Column | str, base: float = rules.DEGREE_DAY_BASE_F) -> Column:
    mean_temp = col(mean_temp)
    return F.when(mean_temp > base, F.round(mean_temp - F.lit(base), 1)).otherwise(F.lit(0.0))
