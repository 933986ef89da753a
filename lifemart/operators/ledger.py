"""The inventory state machine of a unit, by windows over its ordered events.

A unit starts as not offered; its first ALTA makes it available. From then on CAIDA makes it available again whatever it
was, so a unit's events fall into stretches that begin available: the first SEPARACION of a stretch separates the unit, and
the first VENTA after that sells it. Running flags of a stretch are the state: one exchange by key, two sorts, no join.

Keys of more than HOT events don't meet in one task. Their events are cut into chunks of a week. Inside a chunk two sorted passes give
the state after each event for each of the four states that the chunk may begin with; the last event's four states are the chunk's
effect, and a chunk's begin follows from the effects of the chunks before it. Both forms give the same rows, and both are linear in events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATES = ("NOT_OFFERED", "AVAILABLE", "SEPARATED", "SOLD")
#: Events of a key that one task sorts.
HOT = 1_000_000


def inventory_ledger(events: DataFrame, keys: list[str], time: str = "ts", tie: str = "event_id", hot: int = HOT) -> DataFrame:
    """events with event_order, before_state, after_state, applied, delta_stock. Invalid events stay, without effect."""
    large = events.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select(*keys)
    if large.isEmpty():
        return _by_key(events, keys, time, tie)
    named = large.select(*(F.col(k).alias(f"_{k}") for k in keys))  # at most a row for each HOT events
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return _by_key(events.join(named, same, "left_anti"), keys, time, tie).unionByName(_by_week(events.join(named, same, "left_semi"), keys, time, tie))


def _finished(rows: DataFrame, keys: list[str], columns: list[str], order, was, then) -> DataFrame:
    names = F.array(*map(F.lit, STATES))
    applied = was != then
    delta = F.when(~applied, 0).when(F.col("kind").isin("ALTA", "CAIDA"), 1).when(F.col("kind") == "SEPARACION", -1).otherwise(0)
    return rows.select(*keys, *(c for c in columns if c not in keys), order.alias("event_order"), F.element_at(names, was + 1).alias("before_state"), F.element_at(names, then + 1).alias("after_state"), applied.alias("applied"), delta.alias("delta_stock"))


def _by_key(events: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    is_ = lambda kind: F.col("kind") == kind
    ever = lambda c, over: F.coalesce(F.max(c).over(over), F.lit(False))
    order = Window.partitionBy(*keys).orderBy(time, tie)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = events.withColumns({"_alive": ever(is_("ALTA"), upto), "_stretch": F.count_if(is_("CAIDA")).over(upto), "_place": F.row_number().over(order).cast("long")})
    stretch = Window.partitionBy(*keys, "_stretch").orderBy(time, tie)
    now, before = stretch.rowsBetween(Window.unboundedPreceding, 0), stretch.rowsBetween(Window.unboundedPreceding, -1)
    apart = is_("SEPARACION") & F.col("_alive")
    rows = rows.withColumns({"_apart": ever(apart, now), "_can": is_("VENTA") & ever(apart, before)}).withColumn("_sold", ever(F.col("_can"), now))
    rows = rows.withColumn("_state", F.when(~F.col("_alive"), 0).when(F.col("_sold"), 3).when(F.col("_apart"), 2).otherwise(1))
    again = Window.partitionBy(*keys).orderBy("_stretch", time, tie)  # the order that the rows have
    rows = rows.withColumn("_was", F.coalesce(F.lag("_state").over(again), F.lit(0)))
    return _finished(rows, keys, events.columns, F.col("_place"), F.col("_was"), F.col("_state"))


def _by_week(events: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    is_ = lambda kind: F.col("kind") == kind
    chunk = [*keys, "_chunk"]
    order = Window.partitionBy(*chunk).orderBy(time, tie)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = events.withColumn("_chunk", F.date_trunc("week", time))
    rows = rows.withColumns({"_alive": F.max(is_("ALTA")).over(upto), "_stretch": F.count_if(is_("CAIDA")).over(upto), "_place": F.row_number().over(order)})
    stretch = Window.partitionBy(*chunk, "_stretch").orderBy(time, tie)
    now, before = stretch.rowsBetween(Window.unboundedPreceding, 0), stretch.rowsBetween(Window.unboundedPreceding, -1)
    ever = lambda c, over: F.coalesce(F.max(c).over(over), F.lit(False))
    apart, apart0 = is_("SEPARACION"), is_("SEPARACION") & F.col("_alive")
    rows = rows.withColumns({"_apart": ever(apart, now), "_apart0": ever(apart0, now), "_can": is_("VENTA") & ever(apart, before), "_can0": is_("VENTA") & ever(apart0, before), "_venta": ever(is_("VENTA"), now)})
    rows = rows.withColumns({"_sold": ever(F.col("_can"), now), "_sold0": ever(F.col("_can0"), now)})
    begun = F.when(F.col("_sold"), 3).when(F.col("_apart"), 2).otherwise(1)  # the state if the chunk began available
    first = F.col("_stretch") == 0
    states = F.array(
        F.when(~F.col("_alive"), 0).when(F.col("_sold0"), 3).when(F.col("_apart0"), 2).otherwise(1),
        begun,
        F.when(first, F.when(F.col("_venta"), 3).otherwise(2)).otherwise(begun),
        F.when(first, 3).otherwise(begun),
    )
    rows = rows.withColumn("_states", states)
    same = F.array(*map(F.lit, range(len(STATES))))
    rows = rows.select(*events.columns, "_chunk", "_place", "_states", F.coalesce(F.lag("_states").over(order), same).alias("_before"), F.lead(tie).over(order).isNull().alias("_last"))
    effects = rows.where("_last").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_chunk", F.col("_place").alias("n"), F.col("_states").alias("map")))).alias("chunks"))
    start = F.struct(F.array(F.lit(0)).alias("state"), F.array(F.lit(0).cast("long")).alias("ahead"))
    begins = F.aggregate("chunks", start, lambda acc, c: F.struct(F.concat(acc["state"], F.array(F.element_at(c["map"], F.element_at(acc["state"], -1) + 1))).alias("state"), F.concat(acc["ahead"], F.array(F.element_at(acc["ahead"], -1) + c["n"])).alias("ahead")))
    begins = effects.select(*keys, F.col("chunks._chunk").alias("chunk"), begins.alias("b")).select(*keys, F.explode(F.arrays_zip("chunk", F.col("b.state").alias("state"), F.col("b.ahead").alias("ahead"))).alias("x"))
    begins = begins.where("x.chunk is not null").select(*keys, F.col("x.chunk").alias("_chunk"), F.col("x.state").alias("_state"), F.col("x.ahead").alias("_ahead"))
    both = rows.join(begins, chunk)
    was, then = F.element_at("_before", F.col("_state") + 1), F.element_at("_states", F.col("_state") + 1)
    return _finished(both, keys, events.columns, F.col("_ahead") + F.col("_place"), was, then)
