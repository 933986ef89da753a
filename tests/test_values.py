"""Values of queries that no SQL holds, against plain Python and numpy."""

import hashlib
import hmac
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lifemart import registry
from lifemart.operators import models
from lifemart.plans import load_all, mapping
from lifemart.plans.forecast import pairs
from lifemart.plans.models import scored_leads

load_all()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return registry.Tables(spark, FOLDER)


@pytest.fixture(scope="module")
def months(tables):
    return mapping.project_months(tables).collect()


@pytest.fixture(scope="module")
def scored(tables):
    return scored_leads(tables).collect()


def run(spark, name):
    return registry.QUERIES[name](spark, FOLDER).collect()


def test_sanitized_project_month(spark, months):
    want = Counter((hmac.new(b"secret", str(r["project"]).encode(), hashlib.sha256).hexdigest(), r["month"], r["sales"], r["falls"]) for r in months)
    rows = run(spark, "src13_sanitized_project_month")
    assert Counter((r["project_hash"], r["month"], r["sales"], r["falls"]) for r in rows) == want
    for r in rows:
        text = f'{{"falls":{r["falls"]},"month":"{r["month"]}","project_hash":"{r["project_hash"]}","sales":{r["sales"]}}}'
        assert r["content_hash"] == hashlib.sha256(text.encode()).hexdigest()


def test_block_bootstrap(spark, tables):
    best = defaultdict(dict)
    for r in pairs(tables).where("actual is not null and h = 1").collect():
        best[r["project"], r["origin"]][r["model"]] = r["err"]
    blocks = defaultdict(list)
    for (_, origin), e in best.items():
        if "mean3" in e:
            blocks[origin.year, (origin.month - 1) // 3].append(e["last"] - e["mean3"])
    gains = [(sum(b), len(b)) for _, b in sorted(blocks.items())]
    size = len(gains)
    rows = run(spark, "fc21_block_bootstrap")
    assert len(rows) == 200
    draws = spark.range(1, 201).selectExpr("cast(id as int) as replicate").selectExpr("replicate", f"explode(sequence(1, {size})) as slot").selectExpr("replicate", f"pmod(xxhash64(replicate, slot), {size}) as i").collect()
    drawn = defaultdict(list)
    for r in draws:
        drawn[r["replicate"]].append(gains[r["i"]])
    for r in rows:
        got = drawn[r["replicate"]]
        assert abs(r["improvement"] - sum(g for g, _ in got) / sum(n for _, n in got)) < 1e-9


def test_trend_forecast(spark, months):
    series = defaultdict(list)
    for r in sorted(months, key=lambda r: r["month"]):
        series[r["project"]].append(float(r["sales"]))
    found = defaultdict(dict)
    for r in run(spark, "ml16_linear_trend_forecast"):
        found[r["project"]][r["h"]] = (r["forecast"], r["low"], r["high"])
    assert found.keys() == series.keys()
    for project, y in series.items():
        best = None
        for alpha in (0.2, 0.5, 0.8):
            for beta in (0.05, 0.2, 0.5):
                level, trend, sse = y[0], 0.0, 0.0
                for x in y[1:]:
                    error = x - level - trend
                    sse += error**2
                    level, trend = level + trend + alpha * error, trend + beta * alpha * error
                if best is None or sse < best[0] - 1e-9:
                    best = (sse, level, trend)
        sse, level, trend = best
        for h, (mean, low, high) in found[project].items():
            half = 1.96 * math.sqrt(sse / max(1, len(y) - 1)) * math.sqrt(h)
            assert np.allclose((mean, low, high), (level + trend * h, level + trend * h - half, level + trend * h + half), rtol=1e-6, atol=1e-6)


def test_poisson_counts(spark, months):
    x, y = (np.array([float(r[c]) for r in months]) for c in ("n_lines", "sales"))
    design, beta = np.stack([np.ones_like(x), x], 1), np.array([math.log(y.mean()), 0.0])
    for _ in range(100):
        mu = np.exp(design @ beta)
        beta = beta + np.linalg.solve(design.T @ (design * mu[:, None]), design.T @ (y - mu))
    row = run(spark, "ml18_poisson_counts")[0]
    mu = np.exp(design @ beta)
    deviance = 2 * np.sum(np.where(y > 0, y * np.log(np.maximum(y, 1e-300) / mu), 0) - (y - mu))
    assert np.allclose((row["intercept"], row["slope"]), beta, rtol=1e-3, atol=1e-4) and math.isclose(row["deviance"], deviance, rel_tol=1e-4)


def test_discontinuity(spark, scored):
    rows = [(r["amount"] - 100000) / 1e4 for r in scored], [r["y"] for r in scored]
    x, y = np.array(rows[0]), np.array(rows[1], float)
    x, y = x[np.abs(x) <= 5], y[np.abs(x) <= 5]
    over = (x >= 0).astype(float)
    design = np.stack([np.ones_like(x), over, x, over * x], 1)
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    error = y - design @ beta
    cov = np.linalg.inv(design.T @ design) * (error @ error) / (len(y) - 4)
    row = run(spark, "ml20_rdd")[0]
    assert row["n"] == len(y) and math.isclose(row["jump"], beta[1], rel_tol=1e-4, abs_tol=1e-6) and math.isclose(row["se"], math.sqrt(cov[1, 1]), rel_tol=1e-4)


def test_propensities_balance(spark, scored):
    row = run(spark, "ml07_ipw_ate")[0]
    treated = np.array([r["channel"] == "BUILDING" for r in scored])
    y, amount = np.array([r["y"] for r in scored], float), np.array([r["amount"] for r in scored])
    assert row["n"] == len(y) and math.isclose(row["crude"], y[treated].mean() - y[~treated].mean(), rel_tol=1e-9)
    spread = math.sqrt((amount[treated].var(ddof=1) + amount[~treated].var(ddof=1)) / 2)
    assert math.isclose(row["smd_before"], (amount[treated].mean() - amount[~treated].mean()) / spread, rel_tol=1e-9)
    assert abs(row["smd_after"]) < max(0.05, abs(row["smd_before"])) and abs(row["ate"] - row["crude"]) < 0.1


def test_models_are_sound(spark, scored):
    forest = {r["model"]: r for r in run(spark, "ml01_random_forest")}
    assert forest.keys() == {"random_forest", "gmm_analog"} and forest["random_forest"]["n"] == forest["gmm_analog"]["n"] and 2 <= forest["gmm_analog"]["components"] <= 4
    risk = {r["model"]: r for r in run(spark, "ml04_fall_risk_benchmark")}
    assert risk.keys() == {"logistic", "forest", "boosted", "base_rate"}
    later = [r["y"] for r in scored if str(r["d"]) >= "1999-01-01"]
    earlier = [r["y"] for r in scored if str(r["d"]) < "1999-01-01"]
    p = np.mean(earlier)
    assert math.isclose(risk["base_rate"]["brier"], np.mean((p - np.array(later)) ** 2), rel_tol=1e-9) and all(r["n"] == len(later) and 0 <= r["ece"] <= 1 and 0 <= r["roc_auc"] <= 1 for r in risk.values())
    curve = [r["inertia"] for r in sorted(run(spark, "ml27_inertia_curve"), key=lambda r: r["k"])]
    assert len(curve) == 5 and curve[0] > curve[-1]
    values = {r["metric"]: r["value"] for r in run(spark, "ml25_auto_baseline")}
    assert values.keys() == {"n", "accuracy", "base_rate"} and values["n"] == len(later) and math.isclose(values["base_rate"], np.mean(later), rel_tol=1e-9)
    values = {r["metric"]: r["value"] for r in run(spark, "ml25_auto_regression")}
    assert values.keys() == {"n", "mae", "rmse", "r2"} and values["mae"] <= values["rmse"]
    topics = run(spark, "ml13_reason_topics")
    assert topics and len({r["doc_id"] for r in topics}) == len(topics) and all(1 / 3 - 1e-6 <= r["weight"] <= 1 + 1e-9 and len(r["terms"]) == 5 for r in topics)


def test_area_of_separable_scores(spark):
    rows = spark.createDataFrame([(i, i / 1000, float(i >= 600)) for i in range(1000)], "lead long, p double, label double")
    r = models.binary_metrics(rows, "lead").first()
    assert math.isclose(r["roc_auc"], 1) and r["precision_top"] == 1 and math.isclose(r["brier"], np.mean([(i / 1000 - (i >= 600)) ** 2 for i in range(1000)]), rel_tol=1e-9)
