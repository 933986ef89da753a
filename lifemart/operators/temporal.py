"""Joins and windows in time: latest, as-of, interval, calendars, rolling balances.

As-of joins merge both sides into one sorted stream per key (one shuffle, no blow-up by range); interval joins explode an
event to the days it counts for, which bounds the rows by the window's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in this order (say null placement explicitly)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def calendar(first, last, name: str = "day") -> Column:
    return F.explode(F.sequence(first, last)).alias(name)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def as_of_before(left: DataFrame, right: DataFrame, keys: list[str], at: str, when: str, values: list[str], strict: bool = True) -> DataFrame:
    """left with, for each row, the values of the last right row of its key before (or at) the time."""
    order = F.lit(0 if strict else 1)
    a = left.withColumn("_t", F.col(at)).withColumn("_side", order)
    held = F.struct(*values).alias("_held")
    b = right.where(F.col(when).isNotNull()).select(*keys, F.col(when).alias("_t"), F.lit(1 if strict else 0).alias("_side"), held)
    both = a.unionByName(b, allowMissingColumns=True)
    prior = F.last("_held", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("_prior", prior).where(F.col("_side") == order)
    return out.select(*left.columns, *(F.col("_prior")[v].alias(v) for v in values))


def first_after(left: DataFrame, right: DataFrame, keys: list[str], at: str, when: str, values: list[str]) -> DataFrame:
    """left with, for each row, the values of the first right row of its key at or after the time."""
    a = left.withColumn("_t", F.col(at)).withColumn("_side", F.lit(0))
    b = right.where(F.col(when).isNotNull()).select(*keys, F.col(when).alias("_t"), F.lit(1).alias("_side"), F.struct(*values).alias("_held"))
    both = a.unionByName(b, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_side"), *(F.col("_held")[v].asc_nulls_last() for v in values)]
    following = F.first("_held", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing))
    out = both.withColumn("_next", following).where("_side = 0")
    return out.select(*left.columns, *(F.col("_next")[v].alias(v) for v in values))


def days_affected(events: DataFrame, day: str, window: int) -> DataFrame:
    """Each event once for each of the window days that count it: its own and those after it."""
    return events.withColumn("counted_on", F.explode(F.sequence(F.col(day), F.date_add(F.col(day), window - 1))))


def running(keys: list[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def trailing(keys: list[str], order: str, rows: int) -> Window:
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)
