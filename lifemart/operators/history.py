"""What was known of a scope (a client, a project, an adviser, all) when a row came, without looking ahead."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Past:
    """A figure over the rows of a scope in the days before: their number, or the mean of a label that ripens after some days."""

    name: str
    days: int
    label: str | None = None
    ripe: int = 1


def with_past(rows: DataFrame, scope: str | None, day: str, figures: list[Past]) -> DataFrame:
    """rows with a column for each figure, over the rows of their scope (all rows, if None) from `days` to 1 day before their day.

    A label counts once it is ripe: rows of `ripe` days before or earlier, if their label is not null. A row without a scope has nulls.
    Rows are summed by scope and day first; windows run over those sums, a row a day, and are joined back, so neither a large scope nor the
    whole table is one window of rows.
    """
    keys = [scope] if scope else []
    labels = {p.label for p in figures if p.label}
    sums = [F.count("*").alias("_n"), *(F.sum(F.col(c).cast("double")).alias(f"_s_{c}") for c in labels), *(F.count(c).alias(f"_c_{c}") for c in labels)]
    known = rows.where(F.col(day).isNotNull())
    daily = (known.where(F.col(scope).isNotNull()) if scope else known).groupBy(*keys, day).agg(*sums).withColumn("_day", F.unix_date(day))
    order = Window.partitionBy(*keys).orderBy("_day")
    columns = {}
    for p in figures:
        span = order.rangeBetween(-p.days, -max(p.ripe, 1))
        if p.label is None:
            columns[p.name] = F.coalesce(F.sum("_n").over(span), F.lit(0))
        else:
            columns[p.name] = F.sum(f"_s_{p.label}").over(span) / F.nullif(F.sum(f"_c_{p.label}").over(span), F.lit(0))
    return rows.join(daily.withColumns(columns).select(*keys, day, *columns), [*keys, day], "left")
