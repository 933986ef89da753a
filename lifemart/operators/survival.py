"""Time to event: proportional hazards on covariates, and cumulative incidence of competing events."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .regression import Fit, _inverse, _pairs, _square, usable


def cox(df: DataFrame, time: str, event: str, columns: list[str], rounds: int = 50, tolerance: float = 1e-10) -> Fit:
    """Coefficients of a proportional hazard, by Newton steps on the partial likelihood with tied events taken as Breslow does.

    A step sums exp(x b), its products with the columns and with pairs of them by time; the risk sets are those sums added up from the
    last time backwards, so a step costs one pass over the table and a sort of one row for each different time, never a pair of rows. Times
    should be days or another grid, as a row for each time is sorted in one task. Columns are centred, which changes no coefficient.
    """
    rows = usable(df, [time, event, *columns])
    k = len(columns)
    moments = rows.agg(F.count("*"), *(f(F.col(c).cast("double")) for c in columns for f in (F.avg, F.stddev_pop))).first()
    n, centre, scale = moments[0], list(moments[1::2]), [s or 1.0 for s in moments[2::2]]
    x = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, centre, scale, strict=True)] if n else []
    if not n:
        raise ValueError("no rows")
    hit = (F.col(event).cast("double") == 1).cast("double")
    coef = np.zeros(k)
    back = Window.orderBy(F.desc("_t")).rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(rounds):
        risk = F.exp(reduce(add, (F.lit(float(b)) * v for b, v in zip(coef, x, strict=True))))
        sums = [F.sum("_r").alias("s"), F.sum(hit).alias("d"), *(F.sum(F.col("_r") * v).alias(f"s{i}") for i, v in enumerate(x)), *(F.sum(hit * v).alias(f"d{i}") for i, v in enumerate(x)), *(F.sum(F.col("_r") * x[i] * x[j]).alias(f"s{i}_{j}") for i, j in _pairs(k))]
        by_time = rows.withColumn("_r", risk).groupBy(F.col(time).alias("_t")).agg(*sums)
        held = by_time.select("d", *(f"d{i}" for i in range(k)), *(F.sum(c).over(back).alias(c) for c in ["s", *(f"s{i}" for i in range(k)), *(f"s{i}_{j}" for i, j in _pairs(k))]))
        s, d = F.col("s"), F.col("d")
        gradient = [F.sum(F.col(f"d{i}") - d * F.col(f"s{i}") / s) for i in range(k)]
        information = [F.sum(d * (F.col(f"s{i}_{j}") / s - F.col(f"s{i}") * F.col(f"s{j}") / (s * s))) for i, j in _pairs(k)]
        found = held.where("d > 0").agg(*gradient, *information).first()
        if found[0] is None:
            raise ValueError("no events")
        inverse = _inverse(_square(found[k:], k))
        step = inverse @ np.array(found[:k])
        coef = coef + step
        if np.abs(step).max() < tolerance:
            break
    else:
        raise ValueError("the hazard did not settle")
    plain = np.diag([1 / v for v in scale])
    return Fit(list(columns), plain @ coef, plain @ inverse @ plain.T, n)


def cumulative_incidence(df: DataFrame, by: list[str], time: str, cause: str) -> DataFrame:
    """by, time, cause, at_risk, events, incidence: the chance that an event of the cause has come by then, when others may come first.

    cause is null for rows that were only seen up to their time. At each time the hazard of a cause, events over rows at risk, counts for the share that
    no event has reached before (Aalen and Johansen). Everything is running sums and a running product of a row for each time, by the columns in by.
    """
    rows = df.where(F.col(time).isNotNull())
    days = rows.groupBy(*by, time).agg(F.count("*").alias("_n"), F.count(cause).alias("_all"))
    w = Window.partitionBy(*by).orderBy(time)
    days = days.withColumn("at_risk", F.sum("_n").over(w.rowsBetween(0, Window.unboundedFollowing)))
    left = F.when(F.col("_all") < F.col("at_risk"), F.log(1 - F.col("_all") / F.col("at_risk"))).otherwise(-1000.0)
    before = F.coalesce(F.exp(F.sum(left).over(w.rowsBetween(Window.unboundedPreceding, -1))), F.lit(1.0))
    days = days.withColumn("_before", before)
    events = rows.where(F.col(cause).isNotNull()).groupBy(*by, time, cause).agg(F.count("*").alias("events"))
    jumps = events.join(days, [*by, time]).withColumn("_jump", F.col("_before") * F.col("events") / F.col("at_risk"))
    upto = F.sum("_jump").over(Window.partitionBy(*by, cause).orderBy(time).rowsBetween(Window.unboundedPreceding, 0))
    return jumps.select(*by, time, cause, "at_risk", "events", upto.alias("incidence"))
