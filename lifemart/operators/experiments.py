"""Experiments by intention to treat: maturity, rates, lift with an interval, contamination, and value that is only told when it is complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio


def _arm(arm: str, x: Column) -> Column:
    return F.when(F.col("arm") == arm, x)


def performance(units: DataFrame, keys: list[str], z: float = 1.96) -> DataFrame:
    """A row for each group of units (keys, arm of TREATED or CONTROL, outcome of 0, 1 or null until it is ripe, recommended, acted): what treating did.

    Rates are those of ripe units, the difference is in points with a normal interval, the lift is relative to the control. A control unit with a
    recommendation or an action contaminates the group. Nothing is told of effects until both arms have ripe units.
    """
    n = lambda arm, x: F.count(_arm(arm, x))
    parts = []
    for arm, name in (("TREATED", "treated"), ("CONTROL", "control")):
        parts += [n(arm, F.lit(1)).alias(f"{name}_assigned"), n(arm, F.col("outcome")).alias(f"{name}_matured"), F.coalesce(F.sum(_arm(arm, F.col("outcome"))), F.lit(0)).alias(f"{name}_positive"), F.count(F.when((F.col("arm") == arm) & F.col("recommended"), 1)).alias(f"{name}_recommended"), F.count(F.when((F.col("arm") == arm) & F.col("acted"), 1)).alias(f"{name}_acted")]
    g = units.groupBy(*keys).agg(*parts)
    pt, pc = ratio(F.col("treated_positive"), F.col("treated_matured")), ratio(F.col("control_positive"), F.col("control_matured"))
    se = F.sqrt(pt * (1 - pt) / F.col("treated_matured") + pc * (1 - pc) / F.col("control_matured"))
    ripe = (F.col("treated_matured") > 0) & (F.col("control_matured") > 0)
    told = lambda x: F.when(ripe, x)
    dirty = (F.col("control_recommended") > 0) | (F.col("control_acted") > 0)
    status = first_of(((F.col("treated_assigned") == 0) | (F.col("control_assigned") == 0), "NO_COMPARISON_GROUP"), (~ripe, "WAITING_MATURITY"), (dirty, "CONTROL_CONTAMINATION"), otherwise="READY_FOR_ITT_REVIEW")
    return g.withColumns(
        {
            "treated_rate": pt,
            "control_rate": pc,
            "itt_points": told(100 * (pt - pc)),
            "itt_low": told(100 * (pt - pc - z * se)),
            "itt_high": told(100 * (pt - pc + z * se)),
            "lift": told(ratio(pt, pc) - 1),
            "treated_maturity": ratio(F.col("treated_matured"), F.col("treated_assigned")),
            "control_maturity": ratio(F.col("control_matured"), F.col("control_assigned")),
            "action_rate": ratio(F.col("treated_acted"), F.col("treated_assigned")),
            "contaminated": dirty,
            "status": status,
        }
    )


def economic_value(units: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each group of units (keys, arm, outcome, value of what came of it, cost of its action): what treating was worth.

    The value is that of ripe treated units against the control's mean, and is null until every ripe unit of both arms has a value; net of the treated arm's
    costs, and as a return on them.
    """
    parts = []
    for arm, name in (("TREATED", "treated"), ("CONTROL", "control")):
        ripe = F.when(F.col("outcome").isNotNull(), F.col("value"))
        parts += [F.count(_arm(arm, F.lit(1))).alias(f"{name}_assigned"), F.count(_arm(arm, F.col("outcome"))).alias(f"{name}_matured"), F.count(_arm(arm, ripe)).alias(f"{name}_valued"), F.avg(_arm(arm, ripe)).alias(f"{name}_mean_value")]
    g = units.groupBy(*keys).agg(*parts, F.coalesce(F.sum(_arm("TREATED", F.col("cost"))), F.lit(0.0)).alias("action_cost"))
    ripe = (F.col("treated_matured") > 0) & (F.col("control_matured") > 0)
    whole = (F.col("treated_valued") == F.col("treated_matured")) & (F.col("control_valued") == F.col("control_matured"))
    gain = F.when(ripe & whole, (F.col("treated_mean_value") - F.col("control_mean_value")) * F.col("treated_matured"))
    status = first_of(((F.col("treated_assigned") == 0) | (F.col("control_assigned") == 0), "WAITING_COMPARISON_GROUP"), (~ripe, "WAITING_OUTCOME_MATURITY"), (~whole, "WAITING_REALIZED_VALUE"), otherwise="READY_FOR_ECONOMIC_ITT_REVIEW")
    return g.withColumns({"incremental_value": gain, "net_value": gain - F.col("action_cost"), "return_on_cost": F.when(F.col("action_cost") > 0, (gain - F.col("action_cost")) / F.col("action_cost")), "status": status})
