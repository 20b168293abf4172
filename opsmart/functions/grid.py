"""Network nodes and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .core import band, col, flag


def criticality_tier(betweenness: Column | str) -> Column:
    return band(betweenness, rules.CRITICALITY_TIER, rules.CRITICALITY_TIER_ELSE)


def voltage_class(kv: Column | str) -> Column:
    return band(kv, rules.VOLTAGE_CLASS, rules.VOLTAGE_CLASS_ELSE)


def major_hub(degree: Column | str, at_least: float = rules.MAJOR_HUB_DEGREE) -> Column:
    return flag(col(degree) >= at_least)


def line_capacity_tier(mw: Column | str) -> Column:
    return band(mw, rules.LINE_CAPACITY_TIER, rules.LINE_CAPACITY_TIER_ELSE)


def line_distance_bucket(miles: Column | str) -> Column:
    return band(miles, rules.LINE_DISTANCE_BUCKET, rules.LINE_DISTANCE_BUCKET_ELSE)


def importance_score(degree: Column | str, betweenness: Column | str, weight: float = rules.IMPORTANCE_WEIGHT) -> Column:
    return F.round(col(degree) * weight + col(betweenness) * weight, 1)


def throughput_ratio(line_mw: Column | str, node_mw: Column | str) -> Column:
    """Line capacity in percent of node capacity; NULL for a node without capacity."""
    return F.round(F.coalesce(col(line_mw), F.lit(0)) / F.nullif(col(node_mw), F.lit(0)) * 100, 1)
