"""Ordered rules as when-chains: states, classes, bands, health."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """As doubles; null where the divisor is zero or null."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def first_of(*pairs: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    out = F.lit(otherwise)
    for condition, value in reversed(pairs):
        out = F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The names of all conditions that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in pairs)))


def schedule_band(day: Column, as_of: Column) -> Column:
    left = F.datediff(day, as_of)
    return first_of((left < 0, "PAST"), (left <= 30, "CRITICAL"), (left <= 90, "LATE"), (left <= 180, "MID"), otherwise="EARLY")


def lead_bucket(days: Column) -> Column:
    return first_of((days < 0, "AFTER"), (days <= 7, "0_7"), (days <= 30, "8_30"), (days <= 60, "31_60"), (days <= 90, "61_90"), otherwise="90_PLUS")


def evidence_class(issued: Column, cutoff: Column, target: Column) -> Column:
    """BACKTEST if issued after the target began, PROSPECTIVE if before it on data that ended in time, else SHADOW."""
    return first_of((issued >= target, "BACKTEST"), (cutoff <= issued, "PROSPECTIVE"), otherwise="SHADOW")


def freshness(lag_hours: Column, sla_hours: float) -> Column:
    return first_of((lag_hours.isNull(), "UNKNOWN"), (lag_hours <= sla_hours, "OK"), (lag_hours <= 1.5 * sla_hours, "WARN"), otherwise="FAIL")


def risk_score(days: Column, contacted: Column, interactions: Column, blocked: Column) -> Column:
    """At most one: age, no contact, few interactions and a block add up."""
    return F.least(F.lit(1.0), F.when(days > 60, 0.4).when(days > 30, 0.25).otherwise(0.1) + F.when(~contacted, 0.25).otherwise(0.0) + F.when(interactions < 2, 0.2).otherwise(0.0) + F.when(blocked, 0.3).otherwise(0.0))


def expected_value(p: Column, value: Column, cost: Column, effect: Column) -> Column:
    """What acting adds: value at the raised chance, clamped to [0, 1], less value at the plain one and the cost."""
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return clamp(p + effect) * value - clamp(p) * value - cost
