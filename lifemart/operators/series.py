"""Profiles of many series at once: each series is a group that one task sees whole, a row for each month."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHAPE = "n long, missing long, zero_rate double, acf1 double, acf12 double, slope double, seasonal_strength double, adi double, cv2 double, pattern string, adf_t double, kpss double, models array<string>"


def _flat(y: np.ndarray, scale: np.ndarray) -> bool:
    """Whether y varies by no more than rounding does to numbers like those in scale."""
    return bool(y.std() <= 1e-9 * max(1.0, np.abs(scale).max(initial=0.0)))


def _corr(y: np.ndarray, lag: int) -> float:
    """The correlation of a series with itself so many steps before; NaN where there is none."""
    if len(y) <= lag + 1 or _flat(y[:-lag], y) or _flat(y[lag:], y):
        return np.nan
    return float(np.corrcoef(y[:-lag], y[lag:])[0, 1])


def seasonal_strength(y: np.ndarray, period: int = 12) -> float:
    """The share of what a straight line leaves that the means of the period's places explain; NaN below two periods."""
    if len(y) < 2 * period:
        return np.nan
    x = np.arange(len(y))
    rest = y - np.polyval(np.polyfit(x, y, 1), x)
    means = np.array([rest[x % period == k].mean() for k in range(period)])
    return 0.0 if _flat(rest, y) else float(max(0.0, 1 - (rest - means[x % period]).var() / rest.var()))


def demand_pattern(y: np.ndarray) -> tuple[float, float, str]:
    """The mean gap between non-zero values, the squared variation of those, and the kind of demand that both make."""
    some = y[y != 0]
    if not len(some):
        return np.nan, np.nan, "ALL_ZERO"
    gap, cv2 = len(y) / len(some), float((some.std() / some.mean()) ** 2) if some.mean() else np.nan
    kinds = {(True, True): "SMOOTH", (True, False): "ERRATIC", (False, True): "INTERMITTENT", (False, False): "LUMPY"}
    return gap, cv2, kinds[bool(gap < 1.32), bool(cv2 < 0.49)]


def dickey_fuller(y: np.ndarray, lags: int = 1) -> float:
    """The t-value of the level in a regression of steps on level, a constant and earlier steps: far below zero where the series returns to its mean."""
    d = np.diff(y)
    if len(d) < lags + 8 or _flat(y, y):
        return np.nan
    x = np.column_stack([y[lags:-1], np.ones(len(d) - lags), *(d[lags - k : -k] for k in range(1, lags + 1))])
    target = d[lags:]
    coef, _, rank, _ = np.linalg.lstsq(x, target, rcond=None)
    if rank < x.shape[1]:
        return np.nan
    error = target - x @ coef
    se = np.sqrt(error @ error / (len(target) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    return float(coef[0] / se) if se > 0 else np.nan


def kpss(y: np.ndarray) -> float:
    """How far the running sums of what the mean leaves wander, against the long-run variance (Bartlett weights): large where the level moves."""
    n = len(y)
    if n < 10 or _flat(y, y):
        return np.nan
    e = y - y.mean()
    lags = int(np.ceil(12 * (n / 100) ** 0.25))
    long_run = e @ e / n + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n for k in range(1, min(lags, n - 1) + 1))
    return float((np.cumsum(e) ** 2).sum() / n**2 / long_run) if long_run > 0 else np.nan


def eligible_models(n: int, zero_rate: float, missing: int, pattern: str) -> list[str]:
    """The models that a series has enough history for."""
    sparse = pattern in ("INTERMITTENT", "LUMPY", "ALL_ZERO")
    rules = (("moving_average_3", n >= 3), ("seasonal_naive_12", n >= 24 and not missing), ("ets", n >= 8 and zero_rate < 0.8 and not missing), ("croston_sba", n >= 12 and sparse and not missing), ("dynamic_regression", n >= 36 and not sparse and not missing), ("global_tree_lags", n >= 12 and not missing))
    return [name for name, fits in rules if fits]


def profile_row(y: np.ndarray, months: np.ndarray) -> tuple:
    """SHAPE of a series in order; months are month numbers."""
    n, missing = len(y), int(months[-1] - months[0] + 1 - len(months)) if len(months) else 0
    zero = float((y == 0).mean()) if n else np.nan
    gap, cv2, pattern = demand_pattern(y)
    slope = float(np.polyfit(np.arange(n), y, 1)[0]) if n > 1 else np.nan
    return n, missing, zero, _corr(y, 1), _corr(y, 12), slope, seasonal_strength(y), gap, cv2, pattern, dickey_fuller(y), kpss(y), eligible_models(n, zero, missing, pattern)


def profiles(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """key and SHAPE of each series of df: a value for each month (the last one, if a month repeats); months without a value count as missing.

    Series should be of bounded length, as calendar months are. What a series is too short or too even for is null.
    """
    rows = df.where(F.col(month).isNotNull() & F.col(value).isNotNull()).select(key, (F.year(month) * 12 + F.month(month)).alias("_m"), F.col(value).cast("double").alias("_y"))
    names = [c.split(" ")[0] for c in SHAPE.split(", ")]

    def run(series: pd.DataFrame) -> pd.DataFrame:
        s = series.sort_values(["_m", "_y"]).drop_duplicates("_m", keep="last")
        row = profile_row(s["_y"].to_numpy(), s["_m"].to_numpy())
        return pd.DataFrame([(series[key].iloc[0], *(None if isinstance(v, float) and np.isnan(v) else v for v in row))], columns=[key, *names])

    return rows.groupBy(key).applyInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {SHAPE}")
