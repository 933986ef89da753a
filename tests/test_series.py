"""Series profiles against what they should say of made series, and of the given ones."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from lifemart.operators import series
from lifemart.plans import streams
from lifemart.plans.mapping import project_months
from lifemart.registry import Tables


def test_statistics_of_made_series():
    draw = np.random.default_rng(1)
    noise, walk = draw.normal(size=400), np.cumsum(draw.normal(size=400))
    assert series.dickey_fuller(noise) < -10 and series.dickey_fuller(walk) > -2.9  # the 5 % point is -2.87
    assert series.kpss(noise) < 0.463 < series.kpss(walk)  # the 5 % point
    t = np.arange(60)
    assert series.seasonal_strength(5 * np.sin(2 * np.pi * t / 12) + 0.3 * t) > 0.95 and series.seasonal_strength(noise[:60]) < 0.6
    assert math.isnan(series.seasonal_strength(t[:23].astype(float))) and series.seasonal_strength(np.full(30, 4.0)) == 0
    assert series.demand_pattern(np.zeros(5))[2] == "ALL_ZERO" and series.demand_pattern(np.full(9, 3.0)) == (1.0, 0.0, "SMOOTH")
    assert series.demand_pattern(np.array([0, 0, 5, 0, 0, 5.0])) == (3.0, 0.0, "INTERMITTENT")
    assert series.demand_pattern(np.array([1, 20, 1, 1, 30, 1.0]))[2] == "ERRATIC" and series.demand_pattern(np.array([0, 1, 0, 0, 30, 0.0]))[2] == "LUMPY"
    for short in (np.zeros(0), np.ones(1), np.arange(3.0)):
        row = series.profile_row(short, np.arange(len(short)))
        assert row[0] == len(short) and math.isnan(row[10]) and math.isnan(row[11])
    assert math.isnan(series.dickey_fuller(np.full(50, 2.0)))


def test_dickey_fuller_is_a_regression():
    y = np.cumsum(np.random.default_rng(2).normal(size=60)) + 100
    d = np.diff(y)
    frame = pd.DataFrame({"target": d[1:], "level": y[1:-1], "one": 1.0, "before": d[:-1]})
    x, target = frame[["level", "one", "before"]].to_numpy(), frame["target"].to_numpy()
    b = np.linalg.solve(x.T @ x, x.T @ target)
    e = target - x @ b
    t = b[0] / np.sqrt((e @ e / (len(e) - 3) * np.linalg.inv(x.T @ x))[0, 0])
    assert series.dickey_fuller(y) == pytest.approx(t)


def test_models_that_a_series_is_enough_for():
    everything = series.eligible_models(60, 0.0, 0, "SMOOTH")
    assert everything == ["moving_average_3", "seasonal_naive_12", "ets", "dynamic_regression", "global_tree_lags"]
    assert series.eligible_models(60, 0.0, 2, "SMOOTH") == ["moving_average_3"] and series.eligible_models(2, 0.0, 0, "SMOOTH") == []
    assert series.eligible_models(12, 0.9, 0, "LUMPY") == ["moving_average_3", "croston_sba", "global_tree_lags"]


def test_profiles_of_projects(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    rows = pd.DataFrame([(r["project"], r["month"], float(r["sales"])) for r in project_months(tables).collect()], columns=["project", "month", "sales"]).sort_values("month")
    found = {r["project"]: r for r in streams.udf04_profile(tables).collect()}
    assert set(found) == set(rows["project"])
    for project, own in rows.groupby("project"):
        r, y = found[project], own["sales"]
        months = [m.year * 12 + m.month for m in own["month"]]
        assert (r["n"], r["missing"], r["zero_rate"]) == (len(y), max(months) - min(months) + 1 - len(y), (y == 0).mean())
        for lag, name in ((1, "acf1"), (12, "acf12")):
            assert r[name] == pytest.approx(y.reset_index(drop=True).autocorr(lag))
        assert r["slope"] == pytest.approx(np.polyfit(range(len(y)), y, 1)[0]) and r["models"] == series.eligible_models(r["n"], r["zero_rate"], r["missing"], r["pattern"])


def test_series_with_repeats_and_nulls(spark):
    month = lambda i: dt.date(2020 + i // 12, i % 12 + 1, 5)
    rows = [("a", month(i), float(i)) for i in (0, 1, 3)] + [("a", month(1), 0.5), ("a", None, 1.0), ("a", month(9), None), ("b", month(2), 0.0), ("c", None, 1.0)]
    found = {r["k"]: r for r in series.profiles(spark.createDataFrame(rows, "k string, m date, v double"), "k", "m", "v").collect()}
    assert set(found) == {"a", "b"} and (found["a"]["n"], found["a"]["missing"]) == (3, 1)
    assert found["b"]["pattern"] == "ALL_ZERO" and found["b"]["slope"] is None and found["b"]["adi"] is None and found["b"]["models"] == []
