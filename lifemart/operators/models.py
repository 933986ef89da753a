"""Models and statistics on tables, by Spark ML and aggregates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .quantiles import discrete_quantiles

#: Different points of a mixture that a task holds at least.
POINTS = 10_000


def assembled(df: DataFrame, numeric: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="skip").transform(df)


def balanced_logistic(train: DataFrame, target: str, numeric: list[str], categorical: list[str]):
    """Fitted pipeline of scaled numbers and one-hot categories; each class weighs the same in all."""
    share = train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.5
    weighted = train.withColumn("_w", F.when(F.col(target) == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9)))
    stages = [StringIndexer(inputCols=categorical, outputCols=[f"{c}_i" for c in categorical], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_i" for c in categorical], outputCols=[f"{c}_v" for c in categorical])] if categorical else []
    stages += [VectorAssembler(inputCols=[*numeric, *(f"{c}_v" for c in categorical)], outputCol="raw", handleInvalid="keep"), StandardScaler(inputCol="raw", outputCol="features"), LogisticRegression(featuresCol="features", labelCol=target, weightCol="_w", maxIter=50, regParam=0.01)]
    return Pipeline(stages=stages).fit(weighted)


def probability(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def z_interval(p: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    half = z * F.sqrt(p * (1 - p) / n)
    return p - half, p + half


def psi(reference: DataFrame, current: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """Population stability index over the reference's quantile bins, with half a row added to each."""
    place = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda acc, e: acc + F.when(F.col(column) > e, 1).otherwise(0))
    n = lambda df, name: df.groupBy(place.alias("bin")).agg(F.count("*").alias(name))
    both = n(reference, "r").join(n(current, "c"), "bin", "full_outer").select("bin", (F.coalesce("r", F.lit(0)) + 0.5).alias("r"), (F.coalesce("c", F.lit(0)) + 0.5).alias("c"))
    total = both.agg(F.sum("r").alias("tr"), F.sum("c").alias("tc"))
    a, b = F.col("r") / F.col("tr"), F.col("c") / F.col("tc")
    return both.crossJoin(F.broadcast(total)).agg(F.sum((b - a) * F.log(b / a)).alias("psi"))


def holt(df: DataFrame, key: str, time: str, value: str, horizon: int) -> DataFrame:
    """Additive-trend smoothing of each series, parameters by a fixed grid, with an interval that widens as the root of the step."""

    def fit(series: pd.DataFrame) -> pd.DataFrame:
        y = series.sort_values(time)[value].to_numpy(float)
        best = (np.inf, 0.0, 0.0)
        for alpha in (0.2, 0.5, 0.8):
            for beta in (0.05, 0.2, 0.5):
                level, trend, sse = y[0], 0.0, 0.0
                for x in y[1:]:
                    ahead = level + trend
                    sse += (x - ahead) ** 2
                    new = ahead + alpha * (x - ahead)
                    trend += beta * (new - level - trend)
                    level = new
                best = min(best, (sse, level, trend))
        sse, level, trend = best if np.isfinite(best[0]) else (0.0, y[-1], 0.0)
        h = np.arange(1, horizon + 1)
        half = 1.96 * np.sqrt(sse / max(1, len(y) - 1)) * np.sqrt(h)
        mean = level + trend * h
        return pd.DataFrame({key: series[key].iloc[0], "h": h, "forecast": mean, "low": mean - half, "high": mean + half})

    return df.groupBy(key).applyInPandas(fit, f"{key} {df.schema[key].dataType.simpleString()}, h long, forecast double, low double, high double")


def points(rows: DataFrame) -> tuple[DataFrame, int]:
    """(features, n: each different point of rows once with the number of its rows; the number of rows). Weighted by n, a mixture of the points is one of the rows.

    A small file is few tasks however many rows it has, so points are dealt to as many tasks as run at once, POINTS at least to each; they are
    sorted there, since a fit draws its start by place.
    """
    different = written(rows.groupBy("features").agg(F.count("*").alias("n")), "points")
    size, n = different.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = min(max(1, size // POINTS), rows.sparkSession.sparkContext.defaultParallelism)
    return different.repartition(tasks, "features").sortWithinPartitions(vector_to_array("features")), n


def choose_mixture(rows: DataFrame, ks, least: float = 30.0, seed: int = 7):
    """(k, mixture) of the smallest BIC among those whose every component has the support of so many rows; the least k where none has."""
    (different, n), d, found = points(rows), rows.schema["features"].metadata.get("ml_attr", {}).get("num_attrs", 2), []
    for k in ks:
        fit = GaussianMixture(k=k, seed=seed, weightCol="n", featuresCol="features", predictionCol="component", probabilityCol="posterior").fit(different)
        support = fit.transform(different).select("n", F.posexplode(vector_to_array("posterior")).alias("c", "p")).groupBy("c").agg(F.sum(F.col("n") * F.col("p")).alias("s")).agg(F.min("s")).first()[0] or 0.0
        parameters = k - 1 + k * d + k * d * (d + 1) // 2
        found.append((support < least, -2 * fit.summary.logLikelihood + parameters * math.log(max(n, 1)), k, fit))
    return min(found, key=lambda x: x[:3])[2:] if any(not x[0] for x in found) else found[0][2:]


def analogue(mixture, train: DataFrame, test: DataFrame, label: str, prior: float = 5.0) -> DataFrame:
    """test with prediction: the components' mean labels, shrunk towards that of all by prior rows, weighted by the row's posterior."""
    mean = train.agg(F.avg(label)).first()[0] or 0.0
    parts = mixture.transform(train).select(label, F.posexplode(vector_to_array("posterior")).alias("c", "p")).groupBy("c").agg(((F.sum(F.col("p") * F.col(label)) + prior * mean) / (F.sum("p") + prior)).alias("rate"))
    rates = [r["rate"] for r in parts.orderBy("c").collect()]  # one for each component
    posterior = vector_to_array("posterior")
    return mixture.transform(test).withColumn("prediction", sum((posterior[i] * r for i, r in enumerate(rates)), F.lit(0.0)))


def binary_metrics(scored: DataFrame, tie: str, top: int = 100) -> DataFrame:
    """n, roc_auc, pr_auc, brier, ece, precision_top of scored (p, label): one row. The areas come from ten thousand bins of the chance."""
    raw = scored.withColumn("rawPrediction", F.col("p"))
    area = lambda m: F.lit(float(BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName=m, numBins=10_000).evaluate(raw)))
    bins = scored.groupBy(F.floor(F.col("p") * 10).alias("bin")).agg(F.count("*").alias("n"), F.sum("p").alias("p"), F.sum("label").alias("y"), F.sum((F.col("p") - F.col("label")) ** 2).alias("e"))
    first = scored.orderBy(F.desc("p"), tie).limit(top).agg(F.avg("label").alias("precision_top"))
    return bins.agg(F.sum("n").alias("n"), (F.sum("e") / F.sum("n")).alias("brier"), (F.sum(F.abs(F.col("p") - F.col("y"))) / F.sum("n")).alias("ece")).withColumns({"roc_auc": area("areaUnderROC"), "pr_auc": area("areaUnderPR")}).crossJoin(first)


def auto_baseline(df: DataFrame, target: str, time: str, cut: str, classes: int = 10) -> DataFrame:
    """metric, value of boosted trees fitted on rows before cut. Columns that look like ids (nearly all values differ) and dates are
    left out; strings are indexed; a target of few values is a class, else a number."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in (target, time)}
    usable = {c: k for c, k in kinds.items() if k in ("string", "int", "bigint", "double", "float", "boolean")}
    seen = df.agg(F.count("*").alias("n"), *(F.approx_count_distinct(c, 0.02).alias(c) for c in [*usable, target])).first()
    used = {c: k for c, k in usable.items() if seen[c] < 0.9 * max(seen["n"], 1) or k == "double"}
    text = [c for c, k in used.items() if k == "string"]
    numbers = [c for c in used if c not in text]
    stages = [StringIndexer(inputCols=text, outputCols=[f"{c}_i" for c in text], handleInvalid="keep")] if text else []
    stages.append(VectorAssembler(inputCols=[*numbers, *(f"{c}_i" for c in text)], outputCol="features", handleInvalid="keep"))
    rows = df.withColumn("label", F.col(target).cast("double")).where(F.col("label").isNotNull())
    train, test = rows.where(F.col(time) < cut), rows.where(F.col(time) >= cut)
    if seen[target] <= classes:
        out = Pipeline(stages=[*stages, GBTClassifier(maxIter=5, maxDepth=3, seed=7)]).fit(train).transform(test)
        values = out.agg(F.count("*").cast("double").alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("accuracy"), F.avg("label").alias("base_rate"))
    else:
        out = Pipeline(stages=[*stages, GBTRegressor(maxIter=5, maxDepth=3, seed=7)]).fit(train).transform(test)
        e = F.col("prediction") - F.col("label")
        values = out.agg(F.count("*").cast("double").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.avg(e * e) / F.var_pop("label")).alias("r2"))
    return values.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in values.columns))))


def robust_scores(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with score: the largest robust z (0.6745 |x - median| / median deviation) of the columns. Both medians are exact values of the columns (discrete_quantiles)."""
    middle = discrete_quantiles(df, columns, 0.5)
    away = {f"_away{i}": F.abs(F.col(c) - F.lit(middle[c]).cast("double")) for i, c in enumerate(columns)}
    spread = discrete_quantiles(df.select(*(x.alias(name) for name, x in away.items())), list(away), 0.5)
    scores = [x / F.nullif(F.lit(spread[name]).cast("double"), F.lit(0.0)) for name, x in away.items()]
    return df.withColumn("score", 0.6745 * (F.greatest(*scores) if len(scores) > 1 else scores[0]))


def lift_by_decile(scored: DataFrame, score: str, label: str, tie: str, by: str) -> DataFrame:
    decile = F.ntile(10).over(Window.partitionBy(by).orderBy(F.desc(score), tie))
    return scored.withColumn("decile", decile).groupBy("decile").agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))


def synthetic_weights(panel: DataFrame, treated: int, date: str, ridge: float = 0.001) -> DataFrame:
    """project, weight: non-negative ridge weights, sum 1, over all other projects of panel (project, month, sales), fitted on months before date.

    A project without a row in a month sold 0. The Gram matrix is summed by Spark and has one number for each pair of projects;
    descent by coordinates on it ends when no weight moves.
    """
    before = panel.where(F.col("month") < date)
    a, b = (before.select("month", F.col("project").alias(p), F.col("sales").cast("double").alias(v)) for p, v in (("p", "x"), ("q", "y")))
    gram = {(r["p"], r["q"]): r["s"] for r in a.join(b, "month").groupBy("p", "q").agg(F.sum(F.col("x") * F.col("y")).alias("s")).collect()}
    donors = sorted(r["project"] for r in panel.select("project").distinct().collect() if r["project"] is not None and r["project"] != treated)
    g = np.array([[gram.get((p, q), 0.0) for q in donors] for p in donors]).reshape(len(donors), len(donors))
    c = np.array([gram.get((treated, q), 0.0) for q in donors])
    w = np.zeros(len(donors))
    for _ in range(100_000):
        old = w.copy()
        for i in range(len(donors)):
            w[i] = max(0.0, w[i] + (c[i] - g[i] @ w - ridge * w[i]) / (g[i, i] + ridge))
        if np.abs(w - old).max(initial=0.0) < 1e-12:
            break
    w = w / w.sum() if w.sum() else w
    return panel.sparkSession.createDataFrame(list(zip(donors, map(float, w))), f"project {panel.schema['project'].dataType.simpleString()}, weight double")
