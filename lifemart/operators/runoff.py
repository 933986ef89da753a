"""Month by month run-off of a stock whose price follows what earlier months have sold."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _factor(scenario: str, month: Column, scenarios: Iterable[tuple[str, int, int, float]]) -> Column:
    """The first range of the scenario that holds the month; 1 outside all."""
    out = F.lit(1.0)
    for _, first, last, factor in sorted((s for s in scenarios if s[0] == scenario), key=lambda s: s[1], reverse=True):
        out = F.when(month.between(first, last), float(factor)).otherwise(out)
    return out


def projected_runoff(base: DataFrame, keys: list[str], scenarios: Iterable[tuple[str, int, int, float]], milestones: Iterable[tuple[int, int, float, float]], months: int) -> DataFrame:
    """A row for each row of base (keys, stock, price, monthly), scenario and month: opening, sold, closing, sold_share, milestones, price, revenue, stockout.

    scenarios: (name, first month, last month, factor on monthly sales). milestones: (number, month, sold share, rise): from the month on,
    or once the share is sold, the price is higher by the rise, a share of the base price. A month sells what is left at most; revenue adds up.
    One fold over the months of a row carries stock, sales and revenue from month to month, so nothing is shuffled and a row's work is that of its months.
    A stock of zero or null sells nothing; a null price gives null prices and revenue.
    """
    scenarios, milestones = list(scenarios), list(milestones)
    shape = "array<struct<month:int,opening:double,sold:double,closing:double,sold_share:double,milestones:int,price:double,revenue:double,stockout:boolean>>"
    names = sorted({s[0] for s in scenarios})
    rows = base.withColumn("stock", F.coalesce(F.col("stock").cast("double"), F.lit(0.0))).withColumn("scenario", F.explode(F.array(*map(F.lit, names))))

    def step(acc: Column, month: Column) -> Column:
        factor = F.lit(1.0)
        for name in names:
            factor = F.when(F.col("scenario") == name, _factor(name, month, scenarios)).otherwise(factor)
        opening, cumulative, revenue = acc["stock"], acc["sold"], acc["revenue"]
        sold = F.when(opening <= 0, 0.0).otherwise(F.least(opening, F.coalesce(F.col("monthly"), F.lit(0.0)) * factor))
        done = cumulative + sold
        share = F.when(F.col("stock") > 0, done / F.col("stock"))
        met = [(month >= m) | F.coalesce(share >= float(s), F.lit(False)) for _, m, s, _ in milestones]
        rise = sum((F.when(hit, float(r)).otherwise(0.0) for hit, (_, _, _, r) in zip(met, milestones, strict=True)), F.lit(0.0))
        price = F.col("price") * (1 + rise)
        total = revenue + sold * price
        closing = F.greatest(F.lit(0.0), opening - sold)
        row = F.struct(month.alias("month"), opening.alias("opening"), sold.alias("sold"), closing.alias("closing"), share.alias("sold_share"), sum((hit.cast("int") for hit in met), F.lit(0)).alias("milestones"), price.alias("price"), total.alias("revenue"), (closing <= 0).alias("stockout"))
        return F.struct(closing.alias("stock"), done.alias("sold"), total.alias("revenue"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.col("stock").alias("stock"), F.lit(0.0).alias("sold"), F.lit(0.0).alias("revenue"), F.array().cast(shape).alias("rows"))
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(months)), start, step, lambda acc: acc["rows"])
    return rows.select(*keys, "scenario", F.inline(folded))
