"""Backtests of forecasts: intervals from errors known at the origin, metrics against a baseline, choice of a policy by project.

Rows are forecasts (project, origin, h, target, model, prediction) with the actual of their target, null until it is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio
from .quantiles import ranks_as_of

KEY = ["project", "origin", "h"]


def separate_origins(origins: Column, months: Column) -> Column:
    """How many of the sorted dates in origins can be kept, each at least so many months after the one kept before: first come, first kept."""
    start = F.struct(F.lit(None).cast("date").alias("last"), F.lit(0).alias("n"))
    keep = lambda acc, o: F.when(acc["last"].isNull() | (o >= F.add_months(acc["last"], months)), F.struct(o.alias("last"), (acc["n"] + 1).alias("n"))).otherwise(acc)
    return F.aggregate(origins, start, keep, lambda acc: acc["n"])


def intervals_as_of(forecasts: DataFrame, keys: list[str], coverages: tuple[int, ...] = (80, 95), least_errors: int = 20, least_origins: int = 3, least_separate: int = 2) -> DataFrame:
    """forecasts (with actual and stock) with a band for each coverage from the absolute errors of their keys (model, h and maybe more) that were known at the origin.

    An error is known once its target month is not after the origin. Of n errors the margin is the next higher to share
    min(1, (n + 1) c / n); it needs so many errors, origins and origins at least h months apart. Bands stay within 0 and the stock. An origin's margin
    is found once for all its forecasts, and origins share running counts: no origin looks at the past again.
    """
    errors = forecasts.where("actual is not null").withColumn("error", F.abs(F.col("prediction") - F.col("actual")))
    own = [*keys] if "h" in keys else [*keys, "h"]
    by_target = errors.groupBy(*own, "target").agg(F.count("*").alias("n"))
    asked = forecasts.select(*own, "origin").distinct()
    moments = by_target.select(*own, F.col("target").alias("at"), "n", F.lit(False).alias("stop")).unionByName(asked.select(*own, F.col("origin").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("stop")))
    known = F.coalesce(F.sum("n").over(Window.partitionBy(*own).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    pools = moments.withColumn("errors", known).where("stop").select(*own, F.col("at").alias("origin"), "errors")
    seen = errors.groupBy(*own).agg(F.array_sort(F.collect_set("origin")).alias("all"))  # a date for each month
    then = F.filter(F.coalesce("all", F.array().cast("array<date>")), lambda o: F.add_months(o, F.col("h")) <= F.col("origin"))
    pools = pools.join(seen, own, "left").withColumn("then", then).select(*own, "origin", "errors", F.size("then").alias("origins"), separate_origins(F.col("then"), F.col("h")).alias("separate"))
    enough = (F.col("errors") >= least_errors) & (F.col("origins") >= least_origins) & (F.col("separate") >= least_separate)
    pools = pools.withColumn("supported", enough)
    n = F.col("errors")
    asked_ranks = pools.where("supported").select(*own, F.col("origin").alias("at"), F.inline(F.array(*(F.struct(F.lit(c).alias("coverage"), (F.ceil(F.least(100 * n, (n + 1) * c) * (n - 1) / (100 * n)) + 1).alias("rank")) for c in coverages))))
    margins = ranks_as_of(errors.select(*own, "target", "error"), asked_ranks, own, "target", "error")
    wide = margins.groupBy(*own, F.col("at").alias("origin")).agg(*(F.max(F.when(F.col("coverage") == c, F.col("error"))).alias(f"margin{c}") for c in coverages))
    bands = pools.join(wide, [*own, "origin"], "left")
    out = forecasts.join(bands, [*own, "origin"], "left")
    ends = {}
    for c in coverages:
        m = F.col(f"margin{c}")
        ends[f"low{c}"] = F.when(m.isNotNull(), F.greatest(F.lit(0.0), F.col("prediction") - m))
        ends[f"high{c}"] = F.when(m.isNotNull(), F.least(F.col("stock").cast("double"), F.col("prediction") + m))
    status = F.when(F.col("supported"), "EMPIRICAL_POOLED_NOT_GUARANTEED").otherwise("INSUFFICIENT_TEMPORAL_SUPPORT")
    return out.withColumns(ends).withColumn("interval_status", status).drop("supported", *(f"margin{c}" for c in coverages))


def full_metrics() -> list[Column]:
    """Aggregates over rows with prediction, actual, naive (the baseline's prediction for the same cell), low80 and high80."""
    e, e0, actual = F.abs(F.col("prediction") - F.col("actual")), F.abs(F.col("naive") - F.col("actual")), F.col("actual").cast("double")
    known = F.col("actual").isNotNull()
    sum_of = lambda x: F.sum(F.when(known, x))
    wape, naive = ratio(sum_of(e), sum_of(actual)), ratio(sum_of(e0), sum_of(actual))
    held = known & F.col("low80").isNotNull()
    return [
        F.count("actual").alias("n"),
        wape.alias("wape"),
        ratio(sum_of(F.col("prediction") - actual), sum_of(actual)).alias("bias"),
        F.avg(F.when(known, e)).alias("mae"),
        F.sqrt(F.avg(F.when(known, e * e))).alias("rmse"),
        F.avg(F.when(known & (actual != 0), e / actual)).alias("mape"),
        naive.alias("naive_wape"),
        (1 - ratio(wape, naive)).alias("skill"),
        F.avg(F.when(known, (e < e0).cast("int"))).alias("beat_rate"),
        F.avg(F.when(held, F.col("actual").between(F.col("low80"), F.col("high80")).cast("int"))).alias("coverage80"),
        F.avg(F.when(held, F.col("high80") - F.col("low80"))).alias("width80"),
    ]


def complete_paths(rows: DataFrame, horizon: int) -> DataFrame:
    """Rows (one for each model, project, origin and h) of the paths that have every h from 1 to horizon."""
    own = Window.partitionBy("model", "project", "origin")
    return rows.withColumn("_n", F.count("*").over(own)).withColumn("_far", F.max("h").over(own)).where((F.col("_n") == horizon) & (F.col("_far") == horizon)).drop("_n", "_far")


def policy_decisions(validation: DataFrame, horizon: int, baseline: str = "mean3", least_origins: int = 3, least_separate: int = 2, least_share: float = 0.8, least_gain: float = 0.05) -> DataFrame:
    """project, candidate, decision and its figures for each candidate model, and which candidate is chosen for all.

    Candidates are judged on complete paths only, on rows paired with the baseline's. A project takes a candidate if enough origins
    (and enough that don't overlap) and a large enough share of its baseline rows are paired and the error falls by least_gain. A candidate's policy is
    the baseline with the candidate's rows in the projects that take it; the best policy is chosen if it gains least_gain over all rows.
    """
    paths = complete_paths(validation, horizon)
    base = paths.where(F.col("model") == baseline).select(*KEY, "actual", F.abs(F.col("prediction") - F.col("actual")).alias("error0"))
    candidates = paths.where(F.col("model") != baseline).select(*KEY, F.col("model").alias("candidate"), F.abs(F.col("prediction") - F.col("actual")).alias("error"))
    pairs = base.join(candidates, KEY)
    of_project = base.groupBy("project").agg(F.count("*").alias("rows0"), F.sum("error0").alias("sum0"))
    names = validation.where(F.col("model") != baseline).select(F.col("model").alias("candidate")).distinct()
    paired = pairs.groupBy("project", "candidate").agg(F.count("*").alias("paired_rows"), F.sum("error").alias("sum1"), F.sum("error0").alias("sum_paired"), F.array_sort(F.collect_set("origin")).alias("seen"))
    rows = of_project.crossJoin(F.broadcast(names)).join(paired, ["project", "candidate"], "left")  # a row for each model
    n = F.coalesce("paired_rows", F.lit(0))
    rows = rows.select(
        "project", "candidate", "rows0", "sum0", n.alias("paired_rows"), "sum1", "sum_paired",
        F.coalesce(F.size("seen"), F.lit(0)).alias("origins"),
        F.coalesce(separate_origins(F.col("seen"), F.lit(horizon)), F.lit(0)).alias("nonoverlap_origins"),
        (n / F.col("rows0")).alias("candidate_fraction"),
        F.when(n > 0, F.col("sum1") / n).alias("candidate_mae"),
        F.when(n > 0, F.col("sum_paired") / n).alias("baseline_mae"),
    )
    decision = first_of(
        (F.col("origins") < least_origins, "INSUFFICIENT_ORIGINS"),
        (F.col("nonoverlap_origins") < least_separate, "INSUFFICIENT_NONOVERLAPPING_ORIGINS"),
        (F.col("candidate_fraction") < least_share, "INSUFFICIENT_CANDIDATE_COVERAGE"),
        (F.col("baseline_mae") == 0, "BASELINE_ALREADY_EXACT"),
        (F.col("candidate_mae") > F.col("baseline_mae") * (1 - least_gain), "NO_VALIDATION_IMPROVEMENT"),
        otherwise="VALIDATION_PROJECT_GATE",
    )
    rows = rows.withColumn("decision", decision).withColumn("takes", F.col("decision") == "VALIDATION_PROJECT_GATE")
    policies = rows.groupBy("candidate").agg(F.sum("rows0").alias("n"), F.sum("sum0").alias("e0"), F.sum(F.when(F.col("takes"), F.col("sum0") - F.col("sum_paired") + F.col("sum1")).otherwise(F.col("sum0"))).alias("e1"), F.count_if("takes").alias("projects"))
    policies = policies.withColumn("improvement", 1 - ratio(F.col("e1"), F.col("e0"))).withColumn("policy_mae", F.col("e1") / F.col("n"))
    good = F.when((F.col("projects") > 0) & (F.col("improvement") >= least_gain), F.struct(F.round("policy_mae", 9).alias("mae"), "candidate"))
    chosen = policies.agg(F.coalesce(F.min(good)["candidate"], F.lit(baseline)).alias("selected_model"))
    figures = policies.select("candidate", "policy_mae", "improvement").crossJoin(F.broadcast(chosen))
    return rows.join(F.broadcast(figures), "candidate").select("project", "candidate", "decision", "paired_rows", "origins", "nonoverlap_origins", "candidate_fraction", "candidate_mae", "baseline_mae", "policy_mae", "improvement", "selected_model", (F.col("takes") & (F.col("candidate") == F.col("selected_model"))).alias("use_candidate"))
