"""Daily stock and absorption of any slice of the ledger: projects, projects by unit type, or others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio
from .temporal import running, trailing

MOVES = ("entries", "reservations", "falls", "sales", "delta_stock", "delta_reserved", "delta_sold")


def daily_stock(ledger: DataFrame, keys: list[str], last: Column | None = None) -> DataFrame:
    """keys, day, opening, entries, reservations, falls, sales, delta_stock, closing, reserved, sold: each day from a slice's first applied event to
    its last one (or to `last`, if that is later). Only applied events move stock; what is reserved or sold follows from the states."""
    applied = ledger.where("applied")
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    state = lambda name: F.sum((F.col("after_state") == name).cast("int") - (F.col("before_state") == name).cast("int"))
    moves = applied.groupBy(*keys, F.col("d").alias("day")).agg(n("ALTA").alias("entries"), n("SEPARACION").alias("reservations"), n("CAIDA").alias("falls"), n("VENTA").alias("sales"), F.sum("delta_stock").alias("delta_stock"), state("SEPARATED").alias("delta_reserved"), state("SOLD").alias("delta_sold"))
    ends = moves.groupBy(*keys).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = ends.select(*keys, F.explode(F.sequence("lo", F.greatest("hi", last) if last is not None else F.col("hi"))).alias("day"))
    rows = days.join(moves, [*keys, "day"], "left").select(*keys, "day", *(F.coalesce(c, F.lit(0)).alias(c) for c in MOVES))
    total = lambda c: F.sum(c).over(running(keys, "day"))
    rows = rows.withColumns({"closing": total("delta_stock"), "reserved": total("delta_reserved"), "sold": total("delta_sold")})
    return rows.select(*keys, "day", (F.col("closing") - F.col("delta_stock")).alias("opening"), *MOVES[:5], "closing", "reserved", "sold")


def absorption(stock: DataFrame, keys: list[str], spans: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """A row for each day of daily_stock and span: sums over the span's days, and rates on the stock before the span.

    gross, net and fall rates, conversion (sales of reservations), velocity (sales a day), months of stock at the span's sales, and the mean of
    opening and closing. Rates are null where there is nothing to divide by.
    """
    w = Window.partitionBy(*keys).orderBy("day")
    parts = []
    for n in spans:
        over = trailing(keys, "day", n)
        parts.append(F.struct(F.lit(n).alias("days"), F.sum("reservations").over(over).alias("gross"), F.sum("falls").over(over).alias("fallen"), F.sum("sales").over(over).alias("sold_n"), F.lag("closing", n).over(w).alias("start")))
    rows = stock.select(*keys, "day", "closing", ((F.col("opening") + F.col("closing")) / 2).alias("mean_stock"), *(p.alias(f"_p{i}") for i, p in enumerate(parts)))
    rows = rows.select(*keys, "day", "closing", "mean_stock", F.inline(F.array(*(f"_p{i}" for i in range(len(spans))))))
    gross, fallen, sold, start, days = map(F.col, ("gross", "fallen", "sold_n", "start", "days"))
    return rows.select(
        *keys, "day", "days", "closing", "mean_stock", "gross", "fallen", (gross - fallen).alias("net"), sold.alias("sales"), "start",
        ratio(gross, start).alias("gross_rate"), ratio(gross - fallen, start).alias("net_rate"), ratio(sold, gross).alias("conversion"), ratio(fallen, gross).alias("fall_rate"),
        (sold / days).alias("velocity"), (ratio(F.col("closing"), sold) * days / 30).alias("months_of_stock"),
    )


def coverage(stock: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ledger_stock, snapshot_stock, gap, quality: the last day's stock by the ledger against a snapshot's count (keys, n), in either or both."""
    last = stock.groupBy(*keys).agg(F.max_by("closing", "day").alias("ledger_stock"))
    both = last.join(snapshot.select(*keys, F.col("n").alias("snapshot_stock")), keys, "full_outer")
    a, b = F.col("ledger_stock"), F.col("snapshot_stock")
    gap = F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    quality = first_of((a.isNull(), "SIN_LEDGER"), (b.isNull(), "SIN_SNAPSHOT"), (gap == 0, "COMPLETA"), (F.abs(gap) <= 0.1 * F.greatest(a, b), "PARCIAL"), otherwise="INSUFICIENTE")
    return both.select(*keys, "ledger_stock", "snapshot_stock", gap.alias("gap"), quality.alias("quality"))
