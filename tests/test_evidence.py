"""Order statistics, backtests, run-off, regressions, hazards and outliers against plain Python and numpy."""

import datetime as dt
import math
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lifemart.operators import backtests, outliers, quantiles, regression, runoff, survival
from lifemart.plans import inference
from lifemart.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


# order statistics

SHAPES = {
    "even": [float(i) for i in range(500)],
    "ties": [float(i % 3) for i in range(500)],
    "two": [0.0] * 250 + [1.0] * 251,
    "one": [7.0] * 40,
    "steep": [math.exp(i / 3) for i in range(500)],
    "signs": [(-1) ** i * 10.0 ** (i % 40 - 20) for i in range(500)],
    "ends": [float("-inf"), float("inf"), 0.0, 1.0, 2.0],
    "single": [3.5],
}


@pytest.mark.parametrize("small", [0, 5, 1000])
@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_exact_ranks(spark, shape, small, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 20)  # a sketch so coarse that counts must decide
    values = SHAPES[shape][:]
    random.Random(1).shuffle(values)
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    found = quantiles.exact_ranks(df, {"x": ranks}, {"x": len(values)}, small)
    assert found == {("x", r): sorted(values)[r] for r in ranks}


@pytest.mark.parametrize("small", [3, 1000])
def test_numeric_profile(spark, small, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    draw = random.Random(4)
    a = [draw.choice([None, 0.0, draw.gauss(5, 3)]) for _ in range(300)]
    b = [float("nan") if i % 7 == 0 else float(i) for i in range(300)]
    df = spark.createDataFrame(list(zip(a, b, [None] * 300, [2] * 300, strict=True)), "a double, b double, c double, d int")
    found = {r["column_name"]: r.asDict() for r in quantiles.numeric_profile(df, ["a", "b", "c", "d"], small).collect()}
    for name, values in (("a", a), ("b", b)):
        s = pd.Series(values, dtype=float)
        valid = s.dropna()
        want = {"observations": 300, "null_rate": s.isna().mean(), "zero_rate": valid.eq(0).mean(), "mean": valid.mean(), "sd": valid.std(), "lo": valid.min(), "hi": valid.max(), "skew": valid.skew(), "kurtosis": valid.kurt()}
        want |= {f"q{round(100 * q):02d}": valid.quantile(q) for q in (0.05, 0.25, 0.5, 0.75, 0.95)}
        for k, v in want.items():
            assert found[name][k] == pytest.approx(v, rel=1e-9, abs=1e-12), (name, k)
    assert found["c"]["null_rate"] == 1 and all(found["c"][k] is None for k in ("zero_rate", "mean", "sd", "lo", "q05", "q50", "hi", "skew", "kurtosis"))
    assert found["d"]["sd"] == 0 and found["d"]["q50"] == 2 and found["d"]["skew"] is None
    nothing = quantiles.numeric_profile(df.limit(0), ["a"], small).collect()
    assert nothing[0]["observations"] == 0 and nothing[0]["null_rate"] is None


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_ranks_as_of(spark, ranges):
    draw = random.Random(ranges)
    rows = [(draw.choice("ab"), month(draw.randrange(12)), draw.choice([draw.random(), 0.5, 100.0])) for _ in range(300)]
    asked = [(k, month(m), r) for k in "abz" for m in range(-1, 14) for r in (1, 2, 10, 60, 500)]
    values = spark.createDataFrame([*rows, ("a", None, 0.1), ("a", month(1), None)], "k string, t date, x double")
    found = quantiles.ranks_as_of(values, spark.createDataFrame(asked, "k string, at date, rank int"), ["k"], "t", "x", ranges=ranges)
    want = set()
    for k, at, r in asked:
        known = sorted(x for own, t, x in rows if own == k and t <= at)
        if r <= len(known):
            want.add((k, at, r, known[r - 1]))
    assert {(r["k"], r["at"], r["rank"], r["x"]) for r in found.collect()} == want
    assert found.count() == len(want)


# backtests


def kept_apart(origins, months):
    kept = []
    for o in sorted(set(origins)):
        if not kept or o >= (pd.Timestamp(kept[-1]) + pd.DateOffset(months=months)).date():
            kept.append(o)
    return len(kept)


def forecast_rows(seed, projects=3, months=16, horizon=3):
    draw = random.Random(seed)
    rows = []
    for p in range(projects):
        for o in range(months):
            for m in ("last", "mean3", "season12"):
                if m == "season12" and draw.random() < 0.3:
                    continue
                for h in range(1, horizon + 1):
                    if draw.random() < 0.05:
                        continue
                    actual = draw.randrange(50) if o + h < months else None
                    rows.append((p, month(o), h, month(o + h), m, draw.choice([5.0, 60 * draw.random()]), actual, 40.0 - o, float(draw.randrange(40))))
    return rows


SHAPE = "project int, origin date, h int, target date, model string, prediction double, actual long, stock double, naive double"


def test_intervals_know_only_what_had_come_out(spark):
    rows = forecast_rows(1)
    found = backtests.intervals_as_of(spark.createDataFrame(rows, SHAPE), ["model", "h"], least_errors=7).collect()
    assert len(found) == len(rows)
    got = {(r["project"], r["origin"], r["h"], r["model"]): r for r in found}
    supported = 0
    for p, origin, h, _, model, prediction, _, stock, _ in rows:
        pool = [(o, abs(f - a)) for _, o, hh, target, m, f, a, _, _ in rows if m == model and hh == h and a is not None and target <= origin]
        r, n = got[p, origin, h, model], len(pool)
        origins, separate = len({o for o, _ in pool}), kept_apart([o for o, _ in pool], h)
        assert (r["errors"] or 0, r["origins"] or 0, r["separate"] or 0) == (n, origins, separate)
        if n >= 7 and origins >= 3 and separate >= 2:
            supported += 1
            errors = sorted(e for _, e in pool)
            for c in (80, 95):
                margin = errors[-(-min(100 * n, (n + 1) * c) * (n - 1) // (100 * n))]
                assert margin == pytest.approx(float(np.quantile(errors, min(1, (n + 1) * c / 100 / n), method="higher")))
                assert r[f"low{c}"] == max(0, prediction - margin) and r[f"high{c}"] == min(stock, prediction + margin)
            assert r["interval_status"] == "EMPIRICAL_POOLED_NOT_GUARANTEED"
        else:
            assert r["low80"] is None and r["high95"] is None and r["interval_status"] == "INSUFFICIENT_TEMPORAL_SUPPORT"
    assert supported > 50


def test_intervals_do_not_see_later_outcomes(spark):
    rows = forecast_rows(2)
    poisoned = [r[:6] + (10_000 if r[6] is not None and r[3] > month(9) else r[6],) + r[7:] for r in rows]
    bands = lambda rs: {tuple(r) for r in backtests.intervals_as_of(spark.createDataFrame(rs, SHAPE), ["model", "h"], least_errors=7).where(F.col("origin") <= month(9)).drop("actual").collect()}
    assert bands(rows) == bands(poisoned)


def test_full_metrics(spark):
    rows = forecast_rows(3)
    frame = backtests.intervals_as_of(spark.createDataFrame(rows, SHAPE), ["model", "h"], least_errors=7)
    whole = pd.DataFrame([r.asDict() for r in frame.collect()])
    for r in frame.groupBy("model", "h").agg(*backtests.full_metrics()).collect():
        g = whole[(whole.model == r["model"]) & (whole.h == r["h"]) & whole.actual.notna()]
        e, e0 = (g.prediction - g.actual).abs(), (g.naive - g.actual).abs()
        inside = g[g.low80.notna()]
        want = {"n": len(g), "wape": e.sum() / g.actual.sum(), "bias": (g.prediction - g.actual).sum() / g.actual.sum(), "mae": e.mean(), "rmse": (e**2).mean() ** 0.5, "mape": (e / g.actual)[g.actual != 0].mean(), "naive_wape": e0.sum() / g.actual.sum(), "skill": 1 - e.sum() / e0.sum(), "beat_rate": (e < e0).mean()}
        want |= {"coverage80": ((inside.actual >= inside.low80) & (inside.actual <= inside.high80)).mean(), "width80": (inside.high80 - inside.low80).mean()}
        for k, v in want.items():
            assert r[k] == pytest.approx(v), k


def decided(rows, horizon, **limits):
    """project, candidate -> decision, whether it is used; and the chosen model, in plain Python."""
    limits = {"origins": 3, "separate": 2, "share": 0.8, "gain": 0.05} | limits
    paths = defaultdict(dict)
    for p, o, h, _, m, f, a, *_ in rows:
        if a is not None:
            paths[m, p, o][h] = (abs(f - a))
    paths = {k: v for k, v in paths.items() if sorted(v) == list(range(1, horizon + 1))}
    projects = {p for m, p, _ in paths if m == "mean3"}
    models = {m for m, *_ in ((r[4], 0) for r in rows if r[6] is not None)} - {"mean3"}
    decision, total = {}, {}
    for m in models:
        new, old = 0.0, 0.0
        for p in projects:
            mine = {o: sum(v.values()) for (mm, pp, o), v in paths.items() if (mm, pp) == ("mean3", p)}
            both = {o: (sum(paths[m, p, o].values()), e) for o, e in mine.items() if (m, p, o) in paths}
            e1, e0 = sum(a for a, _ in both.values()), sum(b for _, b in both.values())
            if len(both) < limits["origins"]:
                d = "INSUFFICIENT_ORIGINS"
            elif kept_apart(both, horizon) < limits["separate"]:
                d = "INSUFFICIENT_NONOVERLAPPING_ORIGINS"
            elif len(both) / len(mine) < limits["share"]:
                d = "INSUFFICIENT_CANDIDATE_COVERAGE"
            elif e0 == 0:
                d = "BASELINE_ALREADY_EXACT"
            elif e1 > e0 * (1 - limits["gain"]):
                d = "NO_VALIDATION_IMPROVEMENT"
            else:
                d = "VALIDATION_PROJECT_GATE"
            decision[p, m] = d
            old += sum(mine.values())
            new += sum(mine.values()) + (e1 - e0 if d == "VALIDATION_PROJECT_GATE" else 0)
        if any(decision[p, m] == "VALIDATION_PROJECT_GATE" for p in projects) and 1 - new / old >= limits["gain"]:
            total[m] = new
    return decision, min(total, key=lambda m: (total[m], m)) if total else "mean3"


@pytest.mark.parametrize("seed", range(4))
def test_policy_decisions(spark, seed):
    rows = [r for r in forecast_rows(seed + 10, projects=6, months=14) if r[6] is not None]
    if seed == 0:  # one project's candidate is exact
        rows = [r[:5] + (float(r[6]),) + r[6:] if r[4] == "last" and r[0] < 3 else r for r in rows]
    found = backtests.policy_decisions(spark.createDataFrame(rows, SHAPE), 3).collect()
    decision, model = decided(rows, 3)
    assert {(r["project"], r["candidate"]): r["decision"] for r in found} == decision
    assert {r["selected_model"] for r in found} == {model}
    assert {(r["project"], r["candidate"]) for r in found if r["use_candidate"]} == {k for k, d in decision.items() if d == "VALIDATION_PROJECT_GATE" and k[1] == model}
    assert seed or model == "last"


# run-off


def test_runoff_follows_the_loop(spark):
    base = [("a", 10.0, 100.0, 2.0), ("b", 0.0, 50.0, 1.0), ("c", 7.5, 80.0, 0.0), ("d", 5.0, None, 50.0), ("e", None, 1.0, 1.0), ("f", 30.0, 10.0, None)]
    scenarios = [("S", 2, 3, 0.5), ("S", 3, 9, 3.0), ("T", 1, 12, 1.0)]
    stones = [(1, 3, 0.25, 0.1), (2, 5, 0.5, 0.2), (3, 99, 1.0, 1.0)]
    found = {(r["k"], r["scenario"], r["month"]): r for r in runoff.projected_runoff(spark.createDataFrame(base, "k string, stock double, price double, monthly double"), ["k"], scenarios, stones, 6).collect()}
    assert len(found) == 6 * 2 * 6
    for k, stock, price, monthly in base:
        for s in "ST":
            left, done, revenue = stock or 0.0, 0.0, 0.0
            for m in range(1, 7):
                factor = next((f for n, a, b, f in sorted(scenarios) if n == s and a <= m <= b), 1.0)
                sold = min(left, (monthly or 0.0) * factor) if left > 0 else 0.0
                done += sold
                met = [m >= month or (bool(stock) and done / stock >= share) for _, month, share, _ in stones]
                now = None if price is None else price * (1 + sum(r for hit, (*_, r) in zip(met, stones, strict=True) if hit))
                revenue = None if now is None else revenue + sold * now
                r = found[k, s, m]
                assert (r["opening"], r["sold"], r["closing"]) == pytest.approx((left, sold, left - sold))
                left -= sold
                assert r["milestones"] == sum(met) and r["stockout"] == (left <= 0) and r["price"] == (now if now is None else pytest.approx(now)) and r["revenue"] == (revenue if revenue is None else pytest.approx(revenue))


# regressions


def design(rows, columns):
    return np.array([[1.0, *(float(r[c]) for c in columns)] for r in rows])


def newton(x, y, rounds=60):
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ b))
        h = x.T @ (x * (p * (1 - p))[:, None])
        b = b + np.linalg.solve(h, x.T @ (y - p))
    return b, np.linalg.inv(h)


def least_squares(x, y, kind):
    inverse = np.linalg.inv(x.T @ x)
    b = inverse @ x.T @ y
    e = y - x @ b
    if kind == "HC3":
        u = e / (1 - np.einsum("ij,jk,ik->i", x, inverse, x))
        return b, inverse @ (x.T @ (x * (u**2)[:, None])) @ inverse
    return b, inverse * (e @ e) / (len(y) - x.shape[1])


@pytest.mark.parametrize("kind", ["HC3", "classical"])
def test_ols(spark, kind):
    draw = np.random.default_rng(3)
    x = np.column_stack([draw.normal(1e6, 5, 200), draw.exponential(3, 200)])
    y = 2 + 0.3 * (x[:, 0] - 1e6) - x[:, 1] + draw.normal(size=200) * (1 + x[:, 1])
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)] + [(None, 1.0, 1.0), (1.0, float("nan"), 2.0)], "a double, b double, y double")
    fit = regression.ols(df, "y", ["a", "b"], kind)
    shifted = np.column_stack([np.ones(200), x[:, 0] - 1e6, x[:, 1]])
    b, cov = least_squares(shifted, y, kind)
    back = np.array([[1, -1e6, 0], [0, 1, 0], [0, 0, 1]])
    assert fit.n == 200 and fit.coef == pytest.approx(back @ b, rel=1e-6)
    assert np.diag(fit.covariance) == pytest.approx(np.diag(back @ cov @ back.T), rel=1e-6)
    row = fit.rows()[2]
    assert row[4] == pytest.approx(math.erfc(abs(row[1] / row[2]) / math.sqrt(2))) and row[5] < row[1] < row[6]
    with pytest.raises(ValueError, match="linear combinations"):
        regression.ols(df.withColumn("c", F.col("b") * 2), "y", ["b", "c"])


def test_logit_and_its_groups(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(600, 2)) * [1, 50] + [0, 1000]
    y = (draw.random(600) < 1 / (1 + np.exp(-(0.5 + x[:, 0] - 0.02 * (x[:, 1] - 1000))))).astype(int)
    group = np.arange(600) % 3
    y[group == 2] = 1  # one class only
    df = spark.createDataFrame([(int(g), float(a), float(b), int(v)) for g, (a, b), v in zip(group, x, y, strict=True)], "g int, a double, b double, y int")
    keep = group < 2
    fit = regression.logit(df.where("g < 2"), "y", ["a", "b"])
    full = np.column_stack([np.ones(keep.sum()), x[keep]])
    b, cov = newton(np.column_stack([np.ones(keep.sum()), x[keep] - [0, 1000]]), y[keep])
    back = np.array([[1, 0, -1000], [0, 1, 0], [0, 0, 1]])
    assert fit.coef == pytest.approx(back @ b, rel=1e-6) and np.diag(fit.covariance) == pytest.approx(np.diag(back @ cov @ back.T), rel=1e-5)
    p = 1 / (1 + np.exp(-full @ fit.coef))
    effects = {r["parameter"]: r["effect"] for r in regression.marginal_effects(df.where("g < 2"), fit).collect()}
    assert effects == {c: pytest.approx((p * (1 - p)).mean() * v) for c, v in zip("ab", fit.coef[1:], strict=True)}
    each = {r["g"]: r for r in regression.logit_by_group(df, "g", "y", ["a"]).collect()}
    assert set(each) == {0, 1}
    for g in (0, 1):
        b, _ = newton(np.column_stack([np.ones((group == g).sum()), x[group == g, 0]]), y[group == g])
        assert (each[g]["intercept"], each[g]["a"]) == pytest.approx(tuple(b), rel=1e-6) and each[g]["n"] == 200
    with pytest.raises(ValueError, match="both classes"):
        regression.logit(df.where("g = 2"), "y", ["a"])
    apart = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "a double, y int")
    with pytest.raises(ValueError, match="did not settle|linear combinations"):
        regression.logit(apart, "y", ["a"])


# hazards


def test_cox(spark):
    draw = np.random.default_rng(7)
    n = 300
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 2, n) * 100.0])
    time = np.ceil(draw.exponential(20 / np.exp(0.6 * x[:, 0] - 0.004 * x[:, 1]))).astype(int)
    event = (draw.random(n) < 0.7).astype(int)
    df = spark.createDataFrame([(int(t), int(e), float(a), float(b)) for t, e, (a, b) in zip(time, event, x, strict=True)] + [(5, 1, None, 1.0)], "t int, e int, a double, b double")
    fit = survival.cox(df, "t", "e", ["a", "b"])
    b = np.zeros(2)
    for _ in range(40):
        risk = np.exp(x @ b)
        gradient, information = np.zeros(2), np.zeros((2, 2))
        for i in np.flatnonzero(event):
            at = time >= time[i]
            mean = (risk[at, None] * x[at]).sum(0) / risk[at].sum()
            gradient += x[i] - mean
            information += (x[at].T @ (x[at] * risk[at, None])) / risk[at].sum() - np.outer(mean, mean)
        b = b + np.linalg.solve(information, gradient)
    assert fit.n == n and fit.coef == pytest.approx(b, rel=1e-6)
    assert np.diag(fit.covariance) == pytest.approx(np.diag(np.linalg.inv(information)), rel=1e-6)
    with pytest.raises(ValueError, match="no events"):
        survival.cox(df.withColumn("e", F.lit(0)), "t", "e", ["a"])


def test_cumulative_incidence(spark):
    draw = random.Random(2)
    rows = [(g, draw.randrange(1, 12), draw.choice(["sale", "sale", "move", None])) for g in "ab" for _ in range(60)]
    found = survival.cumulative_incidence(spark.createDataFrame(rows, "g string, day int, cause string"), ["g"], "day", "cause").collect()
    want = {}
    for g in "ab":
        left, chance = 1.0, defaultdict(float)
        for day in range(1, 12):
            at_risk = sum(1 for k, d, _ in rows if k == g and d >= day)
            hits = defaultdict(int)
            for k, d, c in rows:
                if (k, d) == (g, day) and c:
                    hits[c] += 1
            for c, k in hits.items():
                chance[c] += left * k / at_risk
                want[g, day, c] = (at_risk, k, chance[c])
            if at_risk:
                left *= 1 - sum(hits.values()) / at_risk
    assert {(r["g"], r["day"], r["cause"]) for r in found} == set(want)
    for r in found:
        assert (r["at_risk"], r["events"], r["incidence"]) == pytest.approx(want[r["g"], r["day"], r["cause"]], abs=1e-9)


# outliers and exchanged columns


def test_mahalanobis(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 3)) @ np.array([[1, 2, 0], [0, 1, 100], [0, 0, 5]]) + [1e6, 0, -3]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(900, None, 1.0, 1.0)], "i long, a double, b double, c double")
    found = {r["i"]: r["distance"] for r in outliers.mahalanobis(df, ["a", "b", "c"]).collect()}
    d = x - x.mean(0)
    want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(np.cov(x.T)), d)
    assert found.pop(900) is None and [found[i] for i in range(400)] == pytest.approx(list(want), rel=1e-5)
    far = {r["i"] for r in outliers.farthest(df, ["a", "b", "c"], 0.05).collect()}
    assert far == set(np.flatnonzero(want > np.quantile(want, 0.95)).tolist())
    assert outliers.farthest(df.limit(0), ["a"], 0.05).count() == 0
    with pytest.raises(ValueError, match="without spread"):
        outliers.mahalanobis(df.withColumn("k", F.lit(1.0)), ["a", "k"])


def test_dealt_anew_is_a_permutation(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.col("id").alias("w"))
    found = outliers.dealt_anew(df, "k", ["v"]).collect()
    assert sorted(r["k"] for r in found) == list(range(3000)) == sorted(r["v"] // 2 for r in found)
    assert all(r["w"] == r["k"] for r in found)
    moved = sum(r["v"] != 2 * r["k"] for r in found)
    assert moved > 2950 and abs(np.corrcoef([r["k"] for r in found], [r["v"] for r in found])[0, 1]) < 0.1
    numbers = [r["n"] for r in outliers.numbered(df, "k", "s", "n").select("n").collect()]
    assert sorted(numbers) == list(range(1, 3001))


# queries without SQL


def features(tables):
    return inference.lead_features(tables).collect()


def test_parameter_queries(tables):
    rows = features(tables)
    ripe = [r for r in rows if r["days"] is not None and r["days"] >= 0]
    b, cov = least_squares(design(ripe, inference.FEATURES), np.array([float(r["days"]) for r in ripe]), "HC3")
    found = {r["parameter"]: r for r in inference.ml06_ols(tables).collect()}
    for i, c in enumerate(["intercept", *inference.FEATURES]):
        assert (found[c]["coef"], found[c]["std_err"]) == pytest.approx((b[i], cov[i, i] ** 0.5), rel=1e-6), c
    x, y = design(rows, inference.FEATURES), np.array([float(r["y"]) for r in rows])
    b, cov = newton(x, y)
    p = 1 / (1 + np.exp(-x @ b))
    found = {r["parameter"]: r for r in inference.ml06_logit(tables).collect()}
    for i, c in enumerate(["intercept", *inference.FEATURES]):
        assert (found[c]["coef"], found[c]["std_err"]) == pytest.approx((b[i], cov[i, i] ** 0.5), rel=1e-5), c
        assert found[c]["effect"] == (pytest.approx((p * (1 - p)).mean() * b[i]) if i else None)
    for r in inference.ml29_sensitivity(tables).collect():
        i = 1 + inference.FEATURES.index(r["feature"])
        move = np.std(x[:, i], ddof=1) * b[i]
        want = [(1 / (1 + np.exp(-(x @ b + s * move)))).mean() for s in (-1, 0, 1)]
        assert (r["low"], r["base"], r["high"], r["odds_ratio"]) == pytest.approx((*want, math.exp(b[i])), rel=1e-5)
    for r in inference.ml29_dependence(tables).collect():
        i = 1 + inference.FEATURES.index(r["feature"])
        there = x.copy()
        there[:, i] = r["value"]
        assert r["chance"] == pytest.approx((1 / (1 + np.exp(-there @ b))).mean(), rel=1e-5)
    assert inference.ml29_dependence(tables).count() == 60
    loss = {r["feature"]: r for r in inference.ml29_permutation(tables).collect()}
    assert loss["none"]["brier"] == pytest.approx(((p - y) ** 2).mean()) and set(loss) == {"none", *inference.FEATURES}
    groups = defaultdict(list)
    for r in rows:
        groups[r["project"]].append(r)
    each = {r["project"]: r for r in inference.ml06_projects(tables).collect()}
    for g, own in groups.items():
        if g in each:
            b, _ = newton(design(own, ["amount_k", "prior"]), np.array([float(r["y"]) for r in own]))
            assert [each[g][c] for c in ("intercept", "amount_k", "prior")] == pytest.approx(list(b), rel=1e-4, abs=1e-6)
    assert all(len(groups[g]) >= 100 for g in each)


def test_cox_query(tables):
    found = inference.ml19_cox(tables).collect()
    assert [r["parameter"] for r in found] == ["amount_k", "prior"]
    for r in found:
        assert r["hazard_ratio"] == pytest.approx(math.exp(r["coef"])) and r["std_err"] > 0 and abs(r["coef"]) < 10 * r["std_err"]
