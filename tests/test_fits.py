"""Fitted models: conditions that an optimum meets, and figures recomputed from the rows they are of."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifemart.operators import models as fits
from lifemart.plans import marts, models
from lifemart.registry import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture(scope="module")
def scored(tables):
    return models.ml02(tables).collect()


def test_logistic_meets_its_optimum(tables):
    """Without a penalty on the intercept the weighted residuals of a fit add up to nothing: positives lack as much as negatives have."""
    train = models.scored_leads(tables).where("d < '1999-01-01'")
    model = fits.balanced_logistic(train, "y", ["amount"], ["channel", "seller"])
    rows = fits.probability(model, train).select("y", "p").collect()
    lack = np.mean([1 - r["p"] for r in rows if r["y"] == 1])
    assert lack == pytest.approx(np.mean([r["p"] for r in rows if r["y"] == 0]), abs=1e-3)


def test_logistic_scores_later_leads(tables, scored):
    later = {r["lead"]: r["y"] for r in models.scored_leads(tables).where("d >= '1999-01-01'").collect()}
    assert {r["lead"]: r["y"] for r in scored} == later and all(0 < r["p"] < 1 for r in scored)


def test_calibration_bins(tables, scored):
    bins = defaultdict(list)
    for r in scored:
        bins[min(9, int(r["p"] * 10))].append(r)
    found = {r["bin"]: r for r in models.ml12_bins(tables).collect()}
    assert set(found) == set(bins)
    for b, own in bins.items():
        want = (len(own), np.mean([r["p"] for r in own]), np.mean([r["y"] for r in own]))
        assert (found[b]["n"], found[b]["mean_p"], found[b]["rate"]) == pytest.approx(want)


def test_unit_sale_probability(tables):
    days = {r["lead"]: r["d"] for r in marts.lead_conversions(tables).select("lead", "d").collect()}
    rows = defaultdict(list)
    for r in marts.landmarks(tables).where("label is not null").collect():
        rows[r["l"]].append((str(days[r["lead"]]), r["label"]))
    found = models.ml03(tables).collect()
    assert [r["l"] for r in found] == [0, 30, 60]
    for r in found:
        base = np.mean([y for d, y in rows[r["l"]] if d < "1999-01-01"])
        test = [y for d, y in rows[r["l"]] if d >= "1999-04-01"]
        assert (r["n"], r["base"]) == pytest.approx((len(test), np.mean([(base - y) ** 2 for y in test])))
        assert r["used"] == ("MODEL" if r["model"] < 0.98 * r["base"] else "BASE_RATE") and 0 < r["model"] < 1


def test_latent_segments_keep_the_mean(tables):
    balances = [r["c_acctbal"] for r in tables.customer.select("c_acctbal").collect()]
    found = models.ml12(tables).collect()
    assert sum(r["n"] for r in found) == len(balances) and len({r["components"] for r in found}) == 1
    assert len(found) <= found[0]["components"] in (2, 3, 4)
    assert sum(r["n"] * r["mean_balance"] for r in found) / len(balances) == pytest.approx(np.mean(balances))


def test_latent_segments_are_those_of_all_rows(spark, tmp_path, monkeypatch):
    """Rounds pass over each different point once, dealt to all tasks, and fits, criterion and segments are those of the rows, which repeat unevenly here."""
    rows = spark.read.parquet(f"{FOLDER}/customer.parquet").withColumn("c_acctbal", F.when(F.col("c_custkey") % 50 > 0, F.col("c_acctbal")))
    rows = rows.where("c_acctbal is not null").withColumn("copy", F.explode(F.expr("sequence(1, 1 + c_custkey % 7)"))).unionByName(rows.where("c_acctbal is null").withColumn("copy", F.lit(1)))
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    seen = []

    class Recorded(models.GaussianMixture):
        def fit(self, data):
            seen.append((data, super().fit(data)))
            return seen[-1][1]

    monkeypatch.setattr(models, "GaussianMixture", Recorded)
    monkeypatch.setattr(fits, "POINTS", 20, raising=False)
    found = {r["segment"]: r for r in models.ml12(Tables(spark, str(tmp_path))).collect()}
    x = np.array([[r["c_acctbal"], r["c_nationkey"]] for r in rows.where("c_acctbal is not null").collect()])
    assert len(seen) == 3 and len(x) > len(np.unique(x, axis=0))
    bic = {}
    for data, fit in seen:
        assert data.count() == len(np.unique(x, axis=0)) and data.rdd.getNumPartitions() > 1
        means, spreads = ([g.toArray() for g in fit.gaussiansDF.toPandas()[c]] for c in ("mean", "cov"))
        means = [m.ravel() for m in means]
        assert sum(w * m for w, m in zip(fit.weights, means, strict=True)) == pytest.approx(x.mean(0))  # as after each step of a fit
        away = [x - m for m in means]
        part = np.array([w * np.exp(-0.5 * np.sum(a @ np.linalg.inv(v) * a, axis=1)) / (2 * np.pi * np.sqrt(np.linalg.det(v))) for w, a, v in zip(fit.weights, away, spreads, strict=True)])
        k = len(fit.weights)
        bic[k] = (-2 * np.log(part.sum(0)).sum() + (6 * k - 1) * np.log(len(x)), part.argmax(0))
        assert -2 * fit.summary.logLikelihood + (6 * k - 1) * np.log(len(x)) == pytest.approx(bic[k][0], abs=1)
    best = min(bic, key=lambda k: bic[k][0])
    segment = bic[best][1]
    assert {(s, r["n"], r["components"]) for s, r in found.items()} == {(s, int((segment == s).sum()), best) for s in np.unique(segment)}
    assert all(r["mean_balance"] == pytest.approx(x[segment == s, 0].mean()) for s, r in found.items())


def test_mixtures_weigh_points_by_their_rows(spark):
    """A chosen mixture is the same whether rows come in one partition or several, keeps their mean, and has their support, not that of different points."""
    rows = fits.assembled(spark.range(4_000, numPartitions=1).select((F.col("id") % 40 / 8.0 + F.when(F.col("id") % 4 == 0, 50).otherwise(0)).alias("a"), (F.col("id") * 7 % 5 + 0.0).alias("b")), ["a", "b"])
    k, mixture = fits.choose_mixture(rows, (2, 3), least=900)
    again = fits.choose_mixture(rows.repartition(5), (2, 3), least=900)[1]
    assert k == 2 and sorted(mixture.weights) == pytest.approx([0.25, 0.75]) and mixture.weights == pytest.approx(again.weights)
    mean = sum(w * m.toArray() for w, m in zip(mixture.weights, mixture.gaussiansDF.toPandas()["mean"], strict=True))
    assert mean == pytest.approx(np.mean([r["features"].toArray() for r in rows.collect()], axis=0))


def test_censored_durations(tables):
    count, events = defaultdict(int), defaultdict(int)
    for r in marts.lead_conversions(tables).where("d < '2001-06-01'").select("channel", "days").collect():
        count[r["channel"]] += 1
        events[r["channel"]] += r["days"] is not None
    found = models.ml19(tables).collect()
    assert {r["channel"]: (r["n"], pytest.approx(r["events"])) for r in found} == {c: (n, events[c] / n) for c, n in count.items()}
    assert len({(r["coefficient"], r["scale"]) for r in found}) == 1 and found[0]["scale"] > 0


def test_uplift_quantiles_are_those_of_two_models(tables):
    s = models.scored_leads(tables).withColumn("treated", (F.col("channel") == "BUILDING").cast("int"))
    p = {}
    for k in (1, 0):
        fit = fits.balanced_logistic(s.where(F.col("treated") == k), "y", ["amount"], ["seller"])
        p[k] = {r["lead"]: r["p"] for r in fits.probability(fit, s.select("lead", "seller", "amount", "y")).select("lead", "p").collect()}
    by = defaultdict(list)
    for r in s.select("lead", "seller").collect():
        by[r["seller"]].append(p[1][r["lead"]] - p[0][r["lead"]])
    found = {r["seller"]: r["q"] for r in models.ml22(tables).collect()}
    assert set(found) == set(by)
    for seller, lift in by.items():
        assert found[seller] == pytest.approx(list(np.quantile(lift, [0.1, 0.5, 0.9])), abs=1e-6)


def test_kmeans_segments(tables):
    scaled = models.scaled_parts(tables)
    x = np.array([r["features"].toArray() for r in scaled.select("features").collect()])
    found = models.ml27(tables).collect()
    inertia = {r["inertia"] for r in found}
    assert len(inertia) == 1 and sum(r["n"] for r in found) == len(x) and len(found) == 3
    assert 0 < inertia.pop() < ((x - x.mean(0)) ** 2).sum()


def test_permutation_importance(tables):
    s = models.scored_leads(tables)
    fit = fits.balanced_logistic(s, "y", ["amount"], ["channel"])
    plain = np.mean([(r["p"] - r["y"]) ** 2 for r in fits.probability(fit, s).select("p", "y").collect()])
    found = {r["feature"]: r["brier"] for r in models.ml29(tables).collect()}
    assert set(found) == {"none", "amount", "channel"} and found["none"] == pytest.approx(plain, rel=1e-6)
    assert all(0 < v < 1 for v in found.values())
