"""Rows that are far from the others in several columns at once, and columns dealt anew among all rows."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

#: Hash ranges in which rows are numbered: a shuffle's offsets are so many rows.
HASH_BITS = 12


def mahalanobis(df: DataFrame, columns: list[str], name: str = "distance") -> DataFrame:
    """df with the squared distance of each row from the mean, in units of the columns' joint spread; null where a column is null or NaN.

    One scan sums means, one more the centred products. The inverse of the Cholesky factor turns a row into uncorrelated columns of unit
    variance, whose squares add up to the distance. Columns that are linear combinations of each other are an error.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    whole = reduce(lambda a, b: a & b, (v.isNotNull() for v in value.values()))
    means = df.where(whole).agg(*(F.avg(v) for v in value.values())).first()
    if means[0] is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    d = [v - F.lit(m) for v, m in zip(value.values(), means, strict=True)]
    k = len(columns)
    places = [(i, j) for i in range(k) for j in range(i + 1)]
    sums = df.where(whole).agg(F.count("*"), *(F.sum(d[i] * d[j]) for i, j in places)).first()
    cov = np.zeros((k, k))
    for (i, j), s in zip(places, sums[1:], strict=True):
        cov[i, j] = cov[j, i] = s / max(sums[0] - 1, 1)
    spread = np.sqrt(np.diag(cov))
    if (spread <= 0).any() or np.linalg.cond(cov / np.outer(spread, spread)) > 1e12:
        raise ValueError("columns without spread, or linear combinations of each other")
    turn = np.linalg.inv(np.linalg.cholesky(cov))
    white = [reduce(add, (F.lit(float(turn[i, j])) * d[j] for j in range(i + 1))) for i in range(k)]
    return df.withColumn(name, F.when(whole, reduce(add, (w * w for w in white))))


def farthest(df: DataFrame, columns: list[str], contamination: float) -> DataFrame:
    """The rows of df whose mahalanobis distance is above its exact quantile at 1 - contamination, with distance."""
    scored = mahalanobis(df, columns)
    cut = exact_quantiles(scored, ["distance"], [1 - contamination])["distance", 1 - contamination]
    return scored.where(F.col("distance") > F.lit(cut)) if cut is not None else scored.limit(0)


def numbered(df: DataFrame, key: str, seed: str, name: str) -> DataFrame:
    """df with a number from 1 for each row, in the order of a hash of key and seed: no sort in one task, as hash ranges are numbered apart.

    Rows that repeat a key are told apart by their other columns only, so key should be one's own.
    """
    hashed = df.withColumn("_h", F.xxhash64(key, F.lit(seed))).withColumn("_range", F.shiftrightunsigned("_h", 64 - HASH_BITS))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = hashed.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))  # 2 ** HASH_BITS rows at most
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_h", key))
    return hashed.withColumn("_place", place).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_place") + F.col("_before")).drop("_h", "_range", "_place", "_before")


def dealt_anew(df: DataFrame, key: str, columns: list[str], seed: str = "deal") -> DataFrame:
    """df with the values of columns exchanged among all its rows: each row takes those of the row that has its number under another hash."""
    taken = numbered(df.select(key, *columns), key, f"{seed}-from", "_i").select("_i", *(F.col(c).alias(f"_{c}") for c in columns))
    both = numbered(df, key, f"{seed}-to", "_i").join(taken, "_i")
    return both.select(*(F.col(f"_{c}").alias(c) if c in columns else F.col(c) for c in df.columns))
