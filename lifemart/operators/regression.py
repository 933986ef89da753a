"""Linear and logistic regressions with parameter tables, summed over the table by Spark.

The table is only ever added up: normal equations, gradients and sandwich matrices have a number for each pair of columns,
and are solved on the driver. Rows with a null or NaN in a used column take no part. Columns that are linear
combinations of others are an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERCEPT = "intercept"
SHAPE = "parameter string, coef double, std_err double, z double, p_value double, ci_low double, ci_high double"


@dataclass
class Fit:
    """Coefficients and their covariance; columns are the regressors, the intercept first."""

    columns: list[str]
    coef: np.ndarray
    covariance: np.ndarray
    n: int

    def linear(self) -> Column:
        """The linear predictor of a row."""
        return reduce(add, (F.lit(float(b)) * x for b, x in zip(self.coef, design(self.columns), strict=True)))

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.linear()))

    def rows(self, z: float = 1.959963984540054) -> list[tuple]:
        se = np.sqrt(np.diag(self.covariance))
        out = []
        for name, b, s in zip(self.columns, self.coef, se, strict=True):
            ratio = b / s if s else math.nan
            out.append((name, float(b), float(s), float(ratio), math.erfc(abs(ratio) / math.sqrt(2)), float(b - z * s), float(b + z * s)))
        return out

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows(), SHAPE).withColumn("n", F.lit(self.n))


def design(columns: list[str]) -> list[Column]:
    return [F.lit(1.0) if c == INTERCEPT else F.col(c).cast("double") for c in columns]


def usable(df: DataFrame, names: list[str]) -> DataFrame:
    keep = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in names))
    return df.where(keep)


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _square(values, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    for (i, j), v in zip(_pairs(k), values, strict=True):
        out[i, j] = out[j, i] = v or 0.0
    return out


def _inverse(m: np.ndarray) -> np.ndarray:
    """The inverse of a symmetric matrix of sums, scaled by its diagonal."""
    scale = np.sqrt(np.maximum(np.diag(m), 1e-300))
    scaled = m / np.outer(scale, scale)
    if not len(m) or np.linalg.cond(scaled) > 1e13:
        raise ValueError("columns of the regression are linear combinations of each other, or have no rows")
    return np.linalg.inv(scaled) / np.outer(scale, scale)


def quadratic(x: list[Column], m: np.ndarray) -> Column:
    """x' m x of each row."""
    return reduce(add, ((F.lit(float(m[i, j])) * (1 if i == j else 2)) * x[i] * x[j] for i, j in _pairs(len(x))))


def ols(df: DataFrame, y: str, columns: list[str], covariance: str = "HC3") -> Fit:
    """Least squares of y on columns and an intercept, with HC3, HC1 or classical covariance.

    One pass sums the normal equations; a second one, with the coefficients and leverages x' (X'X)^-1 x in its expressions, sums the
    sandwich. Columns are centred in the sums, so large levels lose nothing.
    """
    rows = usable(df, [y, *columns])
    means = rows.agg(F.count("*"), *(F.avg(F.col(c).cast("double")) for c in [*columns, y])).first()
    n, centre = means[0], [m or 0.0 for m in means[1:]]
    k = len(columns) + 1
    if n <= k:
        raise ValueError("fewer rows than a regression needs")
    x = [F.lit(1.0)] + [F.col(c).cast("double") - F.lit(m) for c, m in zip(columns, centre, strict=False)]
    target = F.col(y).cast("double") - F.lit(centre[-1])
    sums = rows.agg(*(F.sum(x[i] * x[j]) for i, j in _pairs(k)), *(F.sum(v * target) for v in x)).first()
    inverse = _inverse(_square(sums[: len(_pairs(k))], k))
    coef = inverse @ np.array(sums[len(_pairs(k)) :])
    fitted = reduce(add, (F.lit(float(b)) * v for b, v in zip(coef, x, strict=True)))
    error = target - fitted
    if covariance == "HC3":
        weight = error * error / F.pow(1.0 - quadratic(x, inverse), F.lit(2))
    elif covariance == "HC1":
        weight = error * error * (n / (n - k))
    else:
        weight = None
    if weight is None:
        sigma = rows.agg(F.sum(error * error)).first()[0] / (n - k)
        spread = sigma * inverse
    else:
        meat = _square(rows.agg(*(F.sum(weight * x[i] * x[j]) for i, j in _pairs(k))).first(), k)
        spread = inverse @ meat @ inverse
    back = np.eye(k)  # from centred columns to plain ones: only the intercept changes
    back[0, 1:] = [-m for m in centre[:-1]]
    coef = back @ coef
    coef[0] += centre[-1]
    return Fit([INTERCEPT, *columns], coef, back @ spread @ back.T, n)


def logit(df: DataFrame, y: str, columns: list[str], rounds: int = 50, tolerance: float = 1e-10) -> Fit:
    """Maximum likelihood of a 0/1 column y by Newton steps, each one pass that sums gradient and information.

    Columns are standardised in the sums. A fit that hasn't settled after so many rounds (as when a column separates the classes) is an error.
    """
    rows = usable(df, [y, *columns])
    moments = rows.agg(F.count("*"), F.avg(F.col(y).cast("double")), *(f(F.col(c).cast("double")) for c in columns for f in (F.avg, F.stddev_pop))).first()
    n, share = moments[0], moments[1]
    if not n or share in (0.0, 1.0):
        raise ValueError("a logistic fit needs rows of both classes")
    centre, scale = list(moments[2::2]), [s or 1.0 for s in moments[3::2]]
    k = len(columns) + 1
    x = [F.lit(1.0)] + [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, centre, scale, strict=True)]
    target = F.col(y).cast("double")
    coef = np.zeros(k)
    coef[0] = math.log(share / (1 - share))
    for _ in range(rounds):
        p = 1.0 / (1.0 + F.exp(-reduce(add, (F.lit(float(b)) * v for b, v in zip(coef, x, strict=True)))))
        sums = rows.withColumn("_p", p).agg(*(F.sum(F.col("_p") * (1 - F.col("_p")) * x[i] * x[j]) for i, j in _pairs(k)), *(F.sum((target - F.col("_p")) * v) for v in x)).first()
        inverse = _inverse(_square(sums[: len(_pairs(k))], k))
        step = inverse @ np.array(sums[len(_pairs(k)) :])
        coef = coef + step
        if np.abs(step).max() < tolerance:
            break
    else:
        raise ValueError("the logistic fit did not settle")
    back = np.diag([1.0, *(1 / s for s in scale)])
    back[0, 1:] = [-m / s for m, s in zip(centre, scale, strict=True)]
    return Fit([INTERCEPT, *columns], back @ coef, back @ inverse @ back.T, n)


def marginal_effects(df: DataFrame, fit: Fit) -> DataFrame:
    """parameter, effect: the mean change of the probability with each column of a logit fit."""
    p = fit.probability()
    named = [F.struct(F.lit(c).alias("parameter"), (F.col("s") * F.lit(float(b))).alias("effect")) for c, b in zip(fit.columns[1:], fit.coef[1:], strict=True)]
    return usable(df, fit.columns[1:]).agg(F.avg(p * (1 - p)).alias("s")).select(F.inline(F.array(*named)))


def logit_by_group(df: DataFrame, group: str, y: str, columns: list[str], rounds: int = 25, least: int = 100) -> DataFrame:
    """group, n, and a coefficient for the intercept and each column, fitted to each group of at least so many rows of both classes.

    All groups take their Newton steps together: a pass sums gradient and information by group, so a hot group is partial sums like any
    other. A small row for each group is solved on the driver. Groups whose fit doesn't settle are left out.
    """
    rows = usable(df, [y, *columns]).where(F.col(group).isNotNull())
    k = len(columns) + 1
    x = design([INTERCEPT, *columns])
    target = F.col(y).cast("double")
    kind = df.schema[group].dataType.simpleString()
    spark = df.sparkSession
    seen = rows.groupBy(group).agg(F.count("*").alias("n"), F.avg(target).alias("share")).where((F.col("n") >= least) & (F.col("share") > 0) & (F.col("share") < 1))
    found = seen.collect()  # a row for each group
    n = {r[group]: r["n"] for r in found}
    live, done = {r[group]: np.array([math.log(r["share"] / (1 - r["share"])), *[0.0] * (k - 1)]) for r in found}, {}
    for _ in range(rounds):
        if not live:
            break
        table = spark.createDataFrame([(g, list(map(float, b))) for g, b in live.items()], f"{group} {kind}, _b array<double>")
        p = 1.0 / (1.0 + F.exp(-reduce(add, (F.col("_b")[i] * v for i, v in enumerate(x)))))
        sums = rows.join(F.broadcast(table), group).withColumn("_p", p)
        sums = sums.groupBy(group).agg(*(F.sum(F.col("_p") * (1 - F.col("_p")) * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in _pairs(k)), *(F.sum((target - F.col("_p")) * v).alias(f"g{i}") for i, v in enumerate(x)))
        for r in sums.collect():
            g = r[group]
            try:
                step = _inverse(_square(r[1 : 1 + len(_pairs(k))], k)) @ np.array(r[1 + len(_pairs(k)) :])
            except ValueError:
                live.pop(g)
                continue
            live[g] = live[g] + step
            if np.abs(step).max() < 1e-9:
                done[g] = live.pop(g)
    return spark.createDataFrame([(g, n[g], *map(float, b)) for g, b in done.items()], f"{group} {kind}, n long, {INTERCEPT} double, " + ", ".join(f"{c} double" for c in columns))
