"""Forecast ledgers over project months: issue, maturity, evaluation, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio, reasons
from ..operators.temporal import latest
from ..registry import Tables, query
from .mapping import PM, project_months

HORIZONS = (1, 2, 3)
CELLS = f"""{PM}, b AS MATERIALIZED (SELECT project, month, sales, avg(sales) OVER w AS mean3, count(*) OVER w AS n3, first_value(sales) OVER w12 AS s12, count(*) OVER w12 AS n12 FROM pm WINDOW w AS (PARTITION BY project ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), w12 AS (PARTITION BY project ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
cells AS MATERIALIZED (SELECT project, month AS origin, h, CAST(month + INTERVAL (h) MONTH AS DATE) AS target, 'last' AS model, CAST(sales AS DOUBLE) AS prediction FROM b, (VALUES (1),(2),(3)) x(h)
 UNION ALL SELECT project, month, h, CAST(month + INTERVAL (h) MONTH AS DATE), 'mean3', mean3 FROM b, (VALUES (1),(2),(3)) x(h) WHERE n3=3
 UNION ALL SELECT project, month, h, CAST(month + INTERVAL (h) MONTH AS DATE), 'season12', CAST(s12 AS DOUBLE) FROM b, (VALUES (1),(2),(3)) x(h) WHERE n12=12),
pairs AS MATERIALIZED (SELECT c.*, p.sales AS actual, abs(c.prediction-p.sales) AS err FROM cells c LEFT JOIN pm p ON p.project=c.project AND p.month=c.target)"""
METRICS = """count(actual) AS n, round(sum(err) FILTER (actual IS NOT NULL)/nullif(CAST(sum(actual) AS DOUBLE),0),6) AS wape, round(sum(prediction-actual)/nullif(CAST(sum(actual) AS DOUBLE),0),6) AS bias, round(avg(err),6) AS mae, round(sqrt(avg(err*err)),6) AS rmse"""


def cells(t: Tables) -> DataFrame:
    """project, origin, h, target, model, prediction: three benchmarks known at the origin."""
    over = lambda n: Window.partitionBy("project").orderBy("month").rowsBetween(1 - n, 0)
    b = project_months(t).withColumns({"mean3": F.avg("sales").over(over(3)), "n3": F.count("*").over(over(3)), "s12": F.first("sales").over(over(12)), "n12": F.count("*").over(over(12))})
    models = F.array(
        F.struct(F.lit("last").alias("model"), F.col("sales").cast("double").alias("prediction")),
        F.struct(F.lit("mean3").alias("model"), F.when(F.col("n3") == 3, F.col("mean3")).alias("prediction")),
        F.struct(F.lit("season12").alias("model"), F.when(F.col("n12") == 12, F.col("s12").cast("double")).alias("prediction")),
    )
    rows = b.select("project", F.col("month").alias("origin"), F.inline(models)).where("prediction is not null")
    return rows.select("project", "origin", "model", "prediction", F.explode(F.array(*map(F.lit, HORIZONS))).alias("h")).withColumn("target", F.add_months("origin", F.col("h")))


def pairs(t: Tables) -> DataFrame:
    """Cells with the actual of their target, null until it is there."""
    actual = project_months(t).select("project", F.col("month").alias("target"), F.col("sales").alias("actual"))
    return cells(t).join(actual, ["project", "target"], "left").withColumn("err", F.abs(F.col("prediction") - F.col("actual")))


def metrics():
    known = F.when(F.col("actual").isNotNull(), F.col("err"))
    return (F.count("actual").alias("n"), F.round(ratio(F.sum(known), F.sum("actual")), 6).alias("wape"), F.round(ratio(F.sum(F.col("prediction") - F.col("actual")), F.sum("actual")), 6).alias("bias"), F.round(F.avg("err"), 6).alias("mae"), F.round(F.sqrt(F.avg(F.col("err") * F.col("err"))), 6).alias("rmse"))


@query("fc03_naive_benchmarks", f"WITH {CELLS} SELECT project, origin, h, target, model, round(prediction,6) AS prediction FROM cells")
def fc03(t: Tables) -> DataFrame:
    return cells(t).select("project", "origin", "h", "target", "model", F.round("prediction", 6).alias("prediction"))


@query("jn22_target_actual", f"WITH {CELLS} SELECT project, origin, h, model, actual, round(err,6) AS err FROM pairs")
def jn22(t: Tables) -> DataFrame:
    return pairs(t).select("project", "origin", "h", "model", "actual", F.round("err", 6).alias("err"))


@query("ag13_error_metrics", f"WITH {CELLS} SELECT model, h, {METRICS} FROM pairs GROUP BY 1,2")
def ag13(t: Tables) -> DataFrame:
    return pairs(t).groupBy("model", "h").agg(*metrics())


@query("fc07_performance", f"WITH {CELLS} SELECT project, h, {METRICS} FROM pairs WHERE model='mean3' GROUP BY 1,2")
def fc07(t: Tables) -> DataFrame:
    return pairs(t).where("model = 'mean3'").groupBy("project", "h").agg(*metrics())


@query("fc01_validate_panel", f"WITH {PM}, w AS (SELECT *, lag(month) OVER (PARTITION BY project ORDER BY month) AS prev FROM pm) SELECT project, count(*) AS months, count(*) FILTER (prev IS NOT NULL AND month<>CAST(prev+INTERVAL 1 MONTH AS DATE)) AS gaps, count(*) FILTER (sales<0) AS negative, count(*) FILTER (falls>sales) AS unbalanced, max(month)=(SELECT max(month) FROM pm) AS latest_there FROM w GROUP BY 1")
def fc01(t: Tables) -> DataFrame:
    pm = project_months(t).withColumn("prev", F.lag("month").over(Window.partitionBy("project").orderBy("month")))
    g = pm.groupBy("project").agg(F.count("*").alias("months"), F.count_if(F.col("prev").isNotNull() & (F.col("month") != F.add_months("prev", 1))).alias("gaps"), F.count_if(F.col("sales") < 0).alias("negative"), F.count_if(F.col("falls") > F.col("sales")).alias("unbalanced"), F.max("month").alias("hi"))
    return g.crossJoin(F.broadcast(g.agg(F.max("hi").alias("all_hi")))).select("project", "months", "gaps", "negative", "unbalanced", (F.col("hi") == F.col("all_hi")).alias("latest_there"))


@query("fc02_supervised_design", f"WITH {PM}, w AS (SELECT project, month, sales, avg(sales) OVER p3 AS mean3, lag(sales) OVER p AS lag1, sum(sales) OVER f6 AS ahead, count(*) OVER f6 AS n6, max(CASE WHEN falls>sales THEN 1 ELSE 0 END) OVER f6 AS oversold FROM pm WINDOW p AS (PARTITION BY project ORDER BY month), p3 AS (PARTITION BY project ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), f6 AS (PARTITION BY project ORDER BY month ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING)) SELECT project, month, round(mean3,6) AS mean3, lag1, CASE WHEN n6=6 AND oversold=0 THEN CAST(ahead AS BIGINT) END AS label FROM w")
def fc02(t: Tables) -> DataFrame:
    p = Window.partitionBy("project").orderBy("month")
    f6 = p.rowsBetween(1, 6)
    whole = (F.count("*").over(f6) == 6) & (F.max(F.when(F.col("falls") > F.col("sales"), 1).otherwise(0)).over(f6) == 0)
    return project_months(t).select("project", "month", F.round(F.avg("sales").over(p.rowsBetween(-2, 0)), 6).alias("mean3"), F.lag("sales").over(p).alias("lag1"), F.when(whole, F.sum("sales").over(f6)).alias("label"))


@query("fc04_issue_registry", f"WITH {CELLS}, r AS (SELECT *, row_number() OVER w AS rk, count(*) OVER (PARTITION BY project, target, h) AS options FROM cells WINDOW w AS (PARTITION BY project, target, h ORDER BY CASE model WHEN 'mean3' THEN 1 WHEN 'season12' THEN 2 ELSE 3 END, origin DESC)) SELECT project, target, h, model, options, sha256(project||'|'||target||'|'||h||'|'||model) AS signature FROM r WHERE rk=1")
def fc04(t: Tables) -> DataFrame:
    key = ["project", "target", "h"]
    order = first_of((F.col("model") == "mean3", 1), (F.col("model") == "season12", 2), otherwise=3)
    rows = cells(t).withColumn("options", F.count("*").over(Window.partitionBy(*key)))
    return latest(rows, key, order, F.col("origin").desc()).select(*key, "model", "options", F.sha2(F.concat_ws("|", *key, "model"), 256).alias("signature"))


@query("fc05_maturity_clock", f"WITH {CELLS} SELECT project, origin, h, model, CASE WHEN actual IS NOT NULL THEN 'EVALUATED' WHEN last_day(target)>=DATE '2001-10-01' THEN 'INCUBATING' WHEN project IS NULL THEN 'BLOCKED_SCOPE' ELSE 'OVERDUE' END AS clock FROM pairs")
def fc05(t: Tables) -> DataFrame:
    clock = first_of((F.col("actual").isNotNull(), "EVALUATED"), (F.last_day("target") >= "2001-10-01", "INCUBATING"), (F.col("project").isNull(), "BLOCKED_SCOPE"), otherwise="OVERDUE")
    return pairs(t).select("project", "origin", "h", "model", clock.alias("clock"))


@query("fc06_mature_pairs", f"WITH {CELLS} SELECT project, origin, h, model, round(err,6) AS err, round(err/nullif(actual,0),6) AS ape FROM pairs WHERE actual IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pm q WHERE q.project=pairs.project AND q.month=pairs.origin AND q.n_lines<2)")
def fc06(t: Tables) -> DataFrame:
    seen = project_months(t).where("n_lines < 2").select("project", F.col("month").alias("origin"))
    return pairs(t).where("actual is not null").join(seen, ["project", "origin"], "left_anti").select("project", "origin", "h", "model", F.round("err", 6).alias("err"), F.round(ratio(F.col("err"), F.col("actual")), 6).alias("ape"))


@query("fc08_defendability", f"WITH {CELLS}, g AS (SELECT model, {METRICS} FROM pairs GROUP BY 1) SELECT model, n, wape, CASE WHEN n<100 THEN 'BLOCK' WHEN wape<=0.6 AND abs(bias)<=0.1 THEN 'PASS' WHEN wape<=1 THEN 'WARN' ELSE 'BLOCK' END AS gate FROM g")
def fc08(t: Tables) -> DataFrame:
    g = pairs(t).groupBy("model").agg(*metrics())
    return g.select("model", "n", "wape", first_of((F.col("n") < 100, "BLOCK"), ((F.col("wape") <= 0.6) & (F.abs("bias") <= 0.1), "PASS"), (F.col("wape") <= 1, "WARN"), otherwise="BLOCK").alias("gate"))


@query("fc09_issue_quality", f"WITH {CELLS} SELECT origin, count(*) AS issued, count(DISTINCT project) AS projects, count(*) FILTER (prediction<0) AS negative, count(*) FILTER (actual IS NULL) AS open, CASE WHEN count(DISTINCT project)>=5 THEN 'READY' ELSE 'THIN' END AS readiness FROM pairs GROUP BY 1")
def fc09(t: Tables) -> DataFrame:
    g = pairs(t).groupBy("origin").agg(F.count("*").alias("issued"), F.count_distinct("project").alias("projects"), F.count_if(F.col("prediction") < 0).alias("negative"), F.count_if(F.col("actual").isNull()).alias("open"))
    return g.withColumn("readiness", F.when(F.col("projects") >= 5, "READY").otherwise("THIN"))


@query("fc12_issuance_clock", f"WITH {CELLS} SELECT target, min(origin) AS first_issue, max(origin) AS last_issue, count(*) AS cells FROM cells GROUP BY 1")
def fc12(t: Tables) -> DataFrame:
    return cells(t).groupBy("target").agg(F.min("origin").alias("first_issue"), F.max("origin").alias("last_issue"), F.count("*").alias("cells"))


SKILL = f"{CELLS}, ps AS (SELECT a.project, a.model, a.h, count(*) AS n, sum(a.err) AS e, sum(z.err) AS e0 FROM pairs a JOIN pairs z ON z.project=a.project AND z.origin=a.origin AND z.h=a.h AND z.model='last' WHERE a.actual IS NOT NULL AND a.model<>'last' GROUP BY 1,2,3), sk AS (SELECT *, round(1-e/nullif(e0,0),6) AS skill FROM ps)"


def skill(t: Tables) -> DataFrame:
    """Each model's errors beside those of the last value in the same cells: the models of a cell become columns in one shuffle, without a join of the pairs to themselves."""
    p = pairs(t).where("actual is not null")
    of = lambda m: F.max(F.when(F.col("model") == m, F.col("err")))
    models = ("mean3", "season12")
    wide = p.groupBy("project", "origin", "h").agg(of("last").alias("err0"), *(of(m).alias(m) for m in models)).where("err0 is not null")
    rows = wide.select("project", "h", "err0", F.inline(F.array(*(F.struct(F.lit(m).alias("model"), F.col(m).alias("err")) for m in models)))).where("err is not null")
    g = rows.groupBy("project", "model", "h").agg(F.count("*").alias("n"), F.sum("err").alias("e"), F.sum("err0").alias("e0"))
    return g.withColumn("skill", F.round(1 - ratio(F.col("e"), F.col("e0")), 6))


@query("fc13_scoreboard", f"WITH {SKILL} SELECT model, h, count(DISTINCT project) AS projects, CAST(sum(n) AS BIGINT) AS n, round(avg(skill),6) AS mean_skill, count(*) FILTER (skill>0)=count(*) AS beats_everywhere FROM sk GROUP BY 1,2")
def fc13(t: Tables) -> DataFrame:
    return skill(t).groupBy("model", "h").agg(F.count_distinct("project").alias("projects"), F.sum("n").alias("n"), F.round(F.avg("skill"), 6).alias("mean_skill"), (F.count_if(F.col("skill") > 0) == F.count("*")).alias("beats_everywhere"))


@query("tk06_challenger_pick", f"WITH {SKILL} SELECT project, h, model, skill FROM (SELECT *, row_number() OVER (PARTITION BY project, h ORDER BY skill DESC NULLS LAST, n DESC, model) r FROM sk) WHERE r=1")
def tk06(t: Tables) -> DataFrame:
    return latest(skill(t), ["project", "h"], F.col("skill").desc_nulls_last(), F.col("n").desc(), F.col("model")).select("project", "h", "model", "skill")


@query("ml05_promotion_gate", f"WITH {SKILL} SELECT project, model, h, concat_ws(',', CASE WHEN n<20 THEN 'FEW_ROWS' END, CASE WHEN skill IS NULL OR skill<=0 THEN 'NO_SKILL' END) AS why, n>=20 AND coalesce(skill,0)>0 AS promote FROM sk")
def ml05(t: Tables) -> DataFrame:
    why = reasons((F.col("n") < 20, "FEW_ROWS"), (F.col("skill").isNull() | (F.col("skill") <= 0), "NO_SKILL"))
    return skill(t).select("project", "model", "h", F.array_join(why, ",").alias("why"), (F.size(why) == 0).alias("promote"))


@query("fc14_source_diagnostic", f"WITH {CELLS} SELECT model, CASE WHEN actual IS NULL THEN 'OPEN' WHEN actual=0 THEN 'ZERO' WHEN err>actual THEN 'FAR' ELSE 'NEAR' END AS kind, count(*) AS n FROM pairs GROUP BY 1,2")
def fc14(t: Tables) -> DataFrame:
    kind = first_of((F.col("actual").isNull(), "OPEN"), (F.col("actual") == 0, "ZERO"), (F.col("err") > F.col("actual"), "FAR"), otherwise="NEAR")
    return pairs(t).groupBy("model", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("fc15_current_and_goals", f"WITH {CELLS}, c AS (SELECT *, row_number() OVER (PARTITION BY project, h ORDER BY origin DESC) r FROM cells WHERE model='mean3') SELECT project, h, origin, round(prediction,6) AS prediction, round(greatest(300-prediction,0),6) AS shortfall FROM c WHERE r=1")
def fc15(t: Tables) -> DataFrame:
    now = latest(cells(t).where("model = 'mean3'"), ["project", "h"], F.col("origin").desc())
    return now.select("project", "h", "origin", F.round("prediction", 6).alias("prediction"), F.round(F.greatest(300 - F.col("prediction"), F.lit(0.0)), 6).alias("shortfall"))


@query("fc10_scope_compatibility", f"WITH {PM}, w AS (SELECT project, month, sales, falls, lag(sales) OVER (PARTITION BY project ORDER BY month) AS op FROM pm) SELECT project, CAST(sum(greatest(sales-coalesce(op,0)+falls,0)) AS BIGINT) AS implied_inflow, CAST(sum(sales) AS BIGINT) AS sales, sum(greatest(sales-coalesce(op,0)+falls,0))<=sum(sales) AS compatible FROM w GROUP BY 1")
def fc10(t: Tables) -> DataFrame:
    op = F.coalesce(F.lag("sales").over(Window.partitionBy("project").orderBy("month")), F.lit(0))
    g = project_months(t).withColumn("inflow", F.greatest(F.col("sales") - op + F.col("falls"), F.lit(0))).groupBy("project").agg(F.sum("inflow").alias("implied_inflow"), F.sum("sales").alias("sales"))
    return g.withColumn("compatible", F.col("implied_inflow") <= F.col("sales"))


INCR = f"{CELLS}, cum AS (SELECT project, origin, h, prediction*h*(CASE WHEN project%7=0 AND h=2 THEN 0.4 ELSE 1 END) AS cumulative FROM cells WHERE model='mean3' AND NOT (project%5=0 AND h=2)), l AS (SELECT *, lag(cumulative) OVER w AS prior, lag(h) OVER w AS prior_h FROM cum WINDOW w AS (PARTITION BY project, origin ORDER BY h))"


def increments(t: Tables) -> DataFrame:
    cum = cells(t).where("model = 'mean3'").where(~((F.col("project") % 5 == 0) & (F.col("h") == 2))).withColumn("cumulative", F.col("prediction") * F.col("h") * F.when((F.col("project") % 7 == 0) & (F.col("h") == 2), 0.4).otherwise(1.0))
    w = Window.partitionBy("project", "origin").orderBy("h")
    return cum.withColumn("prior", F.lag("cumulative").over(w)).withColumn("prior_h", F.lag("h").over(w))


STATUS_SQL = "CASE WHEN h>1 AND (prior_h IS NULL OR prior_h<>h-1) THEN 'MISSING_PREDECESSOR' WHEN cumulative<coalesce(prior,0) THEN 'NEGATIVE_INCREMENT' ELSE 'OK' END"


@query("wn10_cumulative_to_increment", f"WITH {INCR} SELECT project, origin, h, CASE WHEN {STATUS_SQL}='OK' THEN round(cumulative-coalesce(prior,0),6) END AS increment, {STATUS_SQL} AS status FROM l")
def wn10(t: Tables) -> DataFrame:
    status = first_of(((F.col("h") > 1) & (F.col("prior_h").isNull() | (F.col("prior_h") != F.col("h") - 1)), "MISSING_PREDECESSOR"), (F.col("cumulative") < F.coalesce("prior", F.lit(0.0)), "NEGATIVE_INCREMENT"), otherwise="OK")
    return increments(t).select("project", "origin", "h", F.when(status == "OK", F.round(F.col("cumulative") - F.coalesce("prior", F.lit(0.0)), 6)).alias("increment"), status.alias("status"))


@query("fc11_monthly_derivation", f"WITH {INCR} SELECT {STATUS_SQL} AS status, h, count(*) AS n FROM l GROUP BY 1,2")
def fc11(t: Tables) -> DataFrame:
    return wn10(t).groupBy("status", "h").agg(F.count("*").alias("n"))


@query("wn11_revision_stats", f"WITH {CELLS} SELECT DISTINCT project, target, count(*) OVER w AS revisions, min(origin) OVER w AS first_issue, max(origin) OVER w AS last_issue FROM cells WHERE model='mean3' WINDOW w AS (PARTITION BY project, target)")
def wn11(t: Tables) -> DataFrame:
    return cells(t).where("model = 'mean3'").groupBy("project", "target").agg(F.count("*").alias("revisions"), F.min("origin").alias("first_issue"), F.max("origin").alias("last_issue"))


@query("wn12_canonical_forecast", f"WITH {CELLS} SELECT project, target, model, origin FROM (SELECT *, row_number() OVER (PARTITION BY project, target ORDER BY CASE model WHEN 'mean3' THEN 1 WHEN 'season12' THEN 2 ELSE 3 END, origin DESC) r FROM cells) WHERE r=1")
def wn12(t: Tables) -> DataFrame:
    order = first_of((F.col("model") == "mean3", 1), (F.col("model") == "season12", 2), otherwise=3)
    return latest(cells(t), ["project", "target"], order, F.col("origin").desc()).select("project", "target", "model", "origin")


@query("wn13_evaluation_candidate", f"WITH {CELLS} SELECT project, target, model, origin FROM (SELECT *, row_number() OVER (PARTITION BY model, project, target ORDER BY origin DESC) r FROM cells) WHERE r=1")
def wn13(t: Tables) -> DataFrame:
    return latest(cells(t), ["model", "project", "target"], F.col("origin").desc()).select("project", "target", "model", "origin")


@query("fc16_outcome_scope", f"WITH {CELLS} SELECT project, target, concat_ws(',', CASE WHEN max(actual) IS NULL THEN 'NO_OUTCOME' END, CASE WHEN count(*)<9 THEN 'PARTIAL' END, CASE WHEN max(actual)=0 THEN 'ZERO' END) AS why FROM pairs GROUP BY 1,2")
def fc16(t: Tables) -> DataFrame:
    g = pairs(t).groupBy("project", "target").agg(F.max("actual").alias("a"), F.count("*").alias("n"))
    return g.select("project", "target", F.array_join(reasons((F.col("a").isNull(), "NO_OUTCOME"), (F.col("n") < 9, "PARTIAL"), (F.col("a") == 0, "ZERO")), ",").alias("why"))


@query("fc17_temporal_backtest", f"WITH {CELLS} SELECT CASE WHEN target<DATE '1999-01-01' THEN 'TRAIN' WHEN target<DATE '2000-01-01' THEN 'VALIDATION' WHEN target<DATE '2000-04-01' THEN 'EMBARGO' ELSE 'TEST' END AS part, model, count(actual) AS n, round(avg(err),6) AS mae FROM pairs GROUP BY 1,2")
def fc17(t: Tables) -> DataFrame:
    x = F.col("target")
    part = first_of((x < "1999-01-01", "TRAIN"), (x < "2000-01-01", "VALIDATION"), (x < "2000-04-01", "EMBARGO"), otherwise="TEST")
    return pairs(t).groupBy(part.alias("part"), "model").agg(F.count("actual").alias("n"), F.round(F.avg("err"), 6).alias("mae"))


@query("fc17_origin_models", f"WITH {CELLS}, q AS (SELECT * FROM pairs WHERE model='mean3' AND actual IS NOT NULL), m AS (SELECT h, target, count(*)::DOUBLE AS n, sum(prediction) AS sx, sum(actual)::DOUBLE AS sy, sum(prediction*prediction) AS sxx, sum(prediction*actual) AS sxy FROM q GROUP BY 1,2), c AS (SELECT h, target AS origin, sum(n) OVER w AS n, sum(sx) OVER w AS sx, sum(sy) OVER w AS sy, sum(sxx) OVER w AS sxx, sum(sxy) OVER w AS sxy FROM m WINDOW w AS (PARTITION BY h ORDER BY target)), f AS (SELECT h, origin, (n*sxy-sx*sy)/nullif(n*sxx-sx*sx,0) AS b, sx/n AS mx, sy/n AS my FROM c WHERE n>=30) SELECT CASE WHEN target<DATE '1999-01-01' THEN 'TRAIN' WHEN target<DATE '2000-01-01' THEN 'VALIDATION' WHEN target<DATE '2000-04-01' THEN 'EMBARGO' ELSE 'TEST' END AS part, h, count(*) AS n, round(avg(abs(my+b*(prediction-mx)-actual)),4) AS mae FROM q JOIN f USING (h, origin) GROUP BY 1,2")
def fc17_origins(t: Tables) -> DataFrame:
    """For each origin a pooled line from the mean of three months to what came, fitted on outcomes known by then: running sums over
    one row a month give all origins' models at once."""
    q = pairs(t).where("model = 'mean3' and actual is not null")
    x, y = F.col("prediction"), F.col("actual")
    sums = {"n": F.count("*").cast("double"), "sx": F.sum(x), "sy": F.sum(y).cast("double"), "sxx": F.sum(x * x), "sxy": F.sum(x * y)}
    monthly = q.groupBy("h", "target").agg(*(v.alias(k) for k, v in sums.items()))
    w = Window.partitionBy("h").orderBy("target").rowsBetween(Window.unboundedPreceding, 0)
    known = monthly.select("h", F.col("target").alias("origin"), *(F.sum(k).over(w).alias(k) for k in sums)).where("n >= 30")
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    slope = (n * F.col("sxy") - sx * sy) / F.nullif(n * F.col("sxx") - sx * sx, F.lit(0.0))
    fits = known.select("h", "origin", slope.alias("b"), (sx / n).alias("mx"), (sy / n).alias("my"))
    d = F.col("target")
    part = first_of((d < "1999-01-01", "TRAIN"), (d < "2000-01-01", "VALIDATION"), (d < "2000-04-01", "EMBARGO"), otherwise="TEST")
    return q.join(fits, ["h", "origin"]).groupBy(part.alias("part"), "h").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("my") + F.col("b") * (x - F.col("mx")) - y)), 4).alias("mae"))


@query("fc18_empirical_intervals", f"WITH {CELLS}, e AS (SELECT project, model, h, quantile_disc(err, 0.8) AS q, count(err) AS support FROM pairs WHERE target<DATE '2000-01-01' AND actual IS NOT NULL GROUP BY 1,2,3), s AS MATERIALIZED (SELECT * FROM e WHERE support>=10), c AS MATERIALIZED (SELECT * FROM cells WHERE origin>=DATE '2001-01-01') SELECT c.project, c.origin, c.model, c.h, round(greatest(c.prediction-s.q,0),6) AS low, round(c.prediction+s.q,6) AS high FROM c JOIN s ON s.project=c.project AND s.model=c.model AND s.h=c.h")
def fc18(t: Tables) -> DataFrame:
    """The discrete quantile: the first error with at least 80 % at or below it."""
    past = pairs(t).where("target < '2000-01-01' and actual is not null").groupBy("project", "model", "h").agg(F.expr("percentile_disc(0.8) WITHIN GROUP (ORDER BY err)").alias("q"), F.count("err").alias("support"))
    now = cells(t).where("origin >= '2001-01-01'")
    return now.join(past.where("support >= 10"), ["project", "model", "h"]).select("project", "origin", "model", "h", F.round(F.greatest(F.col("prediction") - F.col("q"), F.lit(0.0)), 6).alias("low"), F.round(F.col("prediction") + F.col("q"), 6).alias("high"))


@query("fc19_policy_select", f"WITH {SKILL}, g AS (SELECT project, model, count(*) AS horizons, sum(e) AS e FROM sk GROUP BY 1,2) SELECT project, model FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY e, model) r FROM g WHERE horizons=3) WHERE r=1")
def fc19(t: Tables) -> DataFrame:
    g = skill(t).groupBy("project", "model").agg(F.count("*").alias("horizons"), F.sum("e").alias("e")).where("horizons = 3")
    return latest(g, ["project"], F.round("e", 6), F.col("model")).select("project", "model")


@query("fc20_interval_calibration", f"WITH {CELLS}, e AS (SELECT model, h, quantile_disc(err, 0.8) AS q FROM pairs WHERE target<DATE '2000-01-01' AND actual IS NOT NULL GROUP BY 1,2) SELECT model, h, round(avg((err<=q)::INT),6) AS coverage, round(avg(2*q),6) AS width FROM pairs JOIN e USING (model, h) WHERE target>=DATE '2000-01-01' AND actual IS NOT NULL GROUP BY 1,2")
def fc20(t: Tables) -> DataFrame:
    p = pairs(t).where("actual is not null")
    q = p.where("target < '2000-01-01'").groupBy("model", "h").agg(F.expr("percentile_disc(0.8) WITHIN GROUP (ORDER BY err)").alias("q"))
    return p.where("target >= '2000-01-01'").join(F.broadcast(q), ["model", "h"]).groupBy("model", "h").agg(F.round(F.avg((F.col("err") <= F.col("q")).cast("int")), 6).alias("coverage"), F.round(F.avg(2 * F.col("q")), 6).alias("width"))


@query("fc21_block_bootstrap")
def fc21(t: Tables) -> DataFrame:
    """Replicates of the mean improvement of mean3 over last, drawing blocks of origins by a seeded hash. (No SQL twin of the hash.)"""
    p = pairs(t).where("actual is not null and h = 1")
    wide = p.groupBy("project", "origin").agg(F.max(F.when(F.col("model") == "last", F.col("err"))).alias("a"), F.max(F.when(F.col("model") == "mean3", F.col("err"))).alias("b")).where("b is not null")
    blocks = wide.groupBy(F.trunc("origin", "quarter").alias("block")).agg(F.sum(F.col("a") - F.col("b")).alias("gain"), F.count("*").alias("n"))
    ranked = blocks.withColumn("i", F.row_number().over(Window.orderBy("block")))  # one row a quarter
    size = ranked.agg(F.max("i").alias("size"))
    draws = size.select("size", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("replicate")).select("replicate", "size", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("slot"))
    drawn = draws.withColumn("i", (F.pmod(F.xxhash64("replicate", "slot"), F.col("size")) + 1).cast("int"))
    return drawn.join(ranked, "i").groupBy("replicate").agg((F.sum("gain") / F.sum("n")).alias("improvement"))


@query("fc22_project_coverage", f"WITH {PM} SELECT project, count(*) AS months, CASE WHEN count(*)>=48 THEN 'ACTIVE' WHEN count(*)>=24 THEN 'THIN' ELSE 'INSUFFICIENT' END AS status FROM pm GROUP BY 1")
def fc22(t: Tables) -> DataFrame:
    return project_months(t).groupBy("project").agg(F.count("*").alias("months")).withColumn("status", first_of((F.col("months") >= 48, "ACTIVE"), (F.col("months") >= 24, "THIN"), otherwise="INSUFFICIENT"))


@query("fc23_paired_baseline", f"WITH {CELLS}, w AS (SELECT project, origin, h, max(prediction) FILTER (model='season12') AS prediction, max(prediction) FILTER (model='mean3') AS baseline FROM cells GROUP BY 1,2,3) SELECT project, origin, h, round(prediction,6) AS prediction, round(baseline,6) AS baseline FROM w WHERE prediction IS NOT NULL AND baseline IS NOT NULL")
def fc23(t: Tables) -> DataFrame:
    """Both models of a cell in one pass."""
    of = lambda m: F.max(F.when(F.col("model") == m, F.round("prediction", 6)))
    wide = cells(t).groupBy("project", "origin", "h").agg(of("season12").alias("prediction"), of("mean3").alias("baseline"))
    return wide.where("prediction is not null and baseline is not null")


@query("ag14_contract_compliance", f"WITH {CELLS} SELECT origin, bool_and(prediction>=0) AS nonnegative, bool_and(target>origin) AS forward, count(*) FILTER (prediction IS NULL) AS missing, CASE WHEN bool_and(prediction>=0) AND bool_and(target>origin) THEN 'PASS' ELSE 'FAIL' END AS status FROM cells GROUP BY 1")
def ag14(t: Tables) -> DataFrame:
    g = cells(t).groupBy("origin").agg(F.every(F.col("prediction") >= 0).alias("nonnegative"), F.every(F.col("target") > F.col("origin")).alias("forward"), F.count_if(F.col("prediction").isNull()).alias("missing"))
    return g.withColumn("status", F.when(F.col("nonnegative") & F.col("forward"), "PASS").otherwise("FAIL"))


@query("sc23_row_errors", f"WITH {CELLS} SELECT project, origin, h, model, round(prediction-actual,6) AS signed_error, round(err,6) AS absolute_error, err<=0.5*actual AS interval_hit, round(err/nullif(actual,0),6) AS ape FROM pairs WHERE actual IS NOT NULL")
def sc23(t: Tables) -> DataFrame:
    p = pairs(t).where("actual is not null")
    return p.select("project", "origin", "h", "model", F.round(F.col("prediction") - F.col("actual"), 6).alias("signed_error"), F.round("err", 6).alias("absolute_error"), (F.col("err") <= 0.5 * F.col("actual")).alias("interval_hit"), F.round(ratio(F.col("err"), F.col("actual")), 6).alias("ape"))
