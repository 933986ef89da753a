"""Connected components of a table of links, by contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _flat(point: DataFrame) -> DataFrame:
    """point: a, low with low < a. Follows the pointers to their ends, by doubling."""
    point = materialise(point, "pointers")
    while True:
        up = point.select(F.col("a").alias("low"), F.col("low").alias("top"))
        point = materialise(point.select("a", "low").join(up, "low", "left").select("a", F.coalesce("top", "low").alias("low"), F.col("top").isNotNull().alias("moved")), "pointers")
        if point.where("moved").isEmpty():
            return point.select("a", "low")
        point = point.select("a", "low")


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Returns id, component (the smallest id reachable) of each id with a link to another one.

    Each round points every id at its smallest neighbour below it, follows the pointers to their ends, and puts
    the ends in place of the ids in the links; links inside one group go. Copies and hubs meet as one link per
    pair. Tables are written between steps; the driver only asks whether a table is empty. Null ids have no links.
    """
    pair = lambda a, b: (F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = materialise(links.where("a <> b").select(*pair("a", "b")).distinct(), "links")
    known = None
    while known is None or not edges.isEmpty():
        point = _flat(edges.groupBy("a").agg(F.min("b").alias("low")))
        step = point.select(F.col("a").alias("low"), F.col("low").alias("end"))
        if known is not None:
            known = known.join(step, "low", "left").select("a", F.coalesce("end", "low").alias("low")).unionByName(point)
        known = materialise(point if known is None else known, "known")
        ends = edges.join(point.withColumnRenamed("low", "x"), "a").select("x", F.col("b").alias("low")).join(step, "low", "left").select("x", F.coalesce("end", "low").alias("y"))
        edges = materialise(ends.where("x <> y").select(*pair("x", "y")).distinct(), "links")
    return known.select(F.col("a").alias("id"), F.col("low").alias("component")).unionByName(known.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())
