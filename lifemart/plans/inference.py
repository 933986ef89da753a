"""Parameter tables, hazards, competing risks, outliers and what a fitted model says about its columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..operators import outliers, regression, survival
from ..operators.quantiles import exact_quantiles
from ..registry import Tables, query
from ..session import written
from .mapping import LEADS, leads
from .marts import LC, lead_conversions
from .models import S, scored_leads

FEATURES = ("amount_k", "weekend", "prior")


def lead_features(t: Tables) -> DataFrame:
    """Leads with a ripe label y, their amount in 100,000, whether they came at a weekend, and the client's leads of the 180 days before.

    A written table: every step of a fit passes over it.
    """
    day = F.unix_date("d")
    before = Window.partitionBy("client").orderBy(day).rangeBetween(-180, -1)
    prior = leads(t).select("lead", F.count("*").over(before).cast("double").alias("prior"))
    rows = scored_leads(t).join(prior, "lead").select("lead", "project", "channel", "days", "y", (F.col("amount") / 1e5).alias("amount_k"), F.dayofweek("d").isin(1, 7).cast("double").alias("weekend"), "prior")
    return written(rows, "features")


@query("ml06_ols_table")
def ml06_ols(t: Tables) -> DataFrame:
    """Days to conversion on the features: coefficients with HC3 errors."""
    return regression.ols(lead_features(t).where("days >= 0"), "days", list(FEATURES)).table(t.spark)


@query("ml06_logit_table")
def ml06_logit(t: Tables) -> DataFrame:
    """Whether a lead converts within 60 days, with the mean change of the chance with each feature."""
    rows = lead_features(t)
    fit = regression.logit(rows, "y", list(FEATURES))
    return fit.table(t.spark).join(F.broadcast(regression.marginal_effects(rows, fit)), "parameter", "left")  # a row for each parameter


@query("ml06_project_parameters")
def ml06_projects(t: Tables) -> DataFrame:
    """The same fit in each project with 100 leads at least."""
    return regression.logit_by_group(lead_features(t), "project", "y", ["amount_k", "prior"])


@query(
    "ml20_rdd_table",
    f"""WITH {S}, w AS (SELECT (amount-100000)/1e4::DOUBLE AS x, y::DOUBLE AS y, amount>=100000 AS over FROM s WHERE abs((amount-100000)/1e4)<=5),
 g AS (SELECT over, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, var_pop(x)*count(*) AS sxx, covar_pop(x,y)*count(*) AS sxy FROM w GROUP BY 1),
 u AS (SELECT w.over, n, mx, sxx, my-sxy/sxx*mx AS a, sxy/sxx AS b, x, pow(y-(my-sxy/sxx*mx)-sxy/sxx*x,2)/pow(1-1/n-pow(x-mx,2)/sxx,2) AS e2 FROM w JOIN g ON g.over=w.over),
 v AS (SELECT over, any_value(a) AS a, any_value(b) AS b, sum(pow(1/n-mx*(x-mx)/sxx,2)*e2) AS va, sum(pow((x-mx)/sxx,2)*e2) AS vb, count(*) AS n FROM u GROUP BY 1),
 l AS (SELECT * FROM v WHERE NOT over), r AS (SELECT * FROM v WHERE over),
 p(parameter, coef, std_err, n) AS (SELECT 'intercept', l.a, sqrt(l.va), l.n+r.n FROM l, r UNION ALL SELECT 'over', r.a-l.a, sqrt(r.va+l.va), l.n+r.n FROM l, r UNION ALL SELECT 'x', l.b, sqrt(l.vb), l.n+r.n FROM l, r UNION ALL SELECT 'slope', r.b-l.b, sqrt(r.vb+l.vb), l.n+r.n FROM l, r)
 SELECT parameter, round(coef,6) AS coef, round(std_err,6) AS std_err, round(coef/std_err,4) AS z, CAST(n AS BIGINT) AS n FROM p""",
)
def ml20_table(t: Tables, cutoff: float = 100_000.0, unit: float = 1e4, band: float = 5.0) -> DataFrame:
    """A line on each side of the cut-off; `over` is the jump. HC3 errors."""
    s = scored_leads(t).withColumn("x", (F.col("amount") - cutoff) / unit).where(F.abs("x") <= band).withColumn("over", (F.col("amount") >= cutoff).cast("double")).withColumn("slope", F.col("over") * F.col("x"))
    table = regression.ols(s, "y", ["over", "x", "slope"]).table(t.spark)
    return table.select("parameter", F.round("coef", 6).alias("coef"), F.round("std_err", 6).alias("std_err"), F.round("z", 4).alias("z"), "n")


@query("ml19_cox")
def ml19_cox(t: Tables) -> DataFrame:
    """The hazard of a conversion by amount and earlier leads; leads without one count up to the cut."""
    end = F.lit("2001-10-01").cast("date")
    before = Window.partitionBy("client").orderBy(F.unix_date("d")).rangeBetween(-180, -1)
    rows = lead_conversions(t).withColumn("prior", F.count("*").over(before).cast("double")).where("d < '2001-06-01' and (days is null or days >= 0)")
    rows = rows.select((F.col("amount") / 1e5).alias("amount_k"), "prior", F.col("days").isNotNull().cast("int").alias("event"), F.coalesce("days", F.datediff(end, "d")).alias("time"))
    fit = survival.cox(rows, "time", "event", ["amount_k", "prior"])
    return fit.table(t.spark).withColumn("hazard_ratio", F.exp("coef"))


CUT = "2001-10-01"
RACE = f"""{LC}, nx AS (SELECT *, lead(d) OVER (PARTITION BY client ORDER BY d, lead) AS next_d FROM lc), rc AS (SELECT lead, CASE WHEN d<DATE '1998-01-01' THEN 'EARLY' ELSE 'LATE' END AS regime, CASE WHEN days>=0 THEN days END AS sold, next_d-d AS moved, DATE '{CUT}'-d AS seen FROM nx WHERE d<DATE '{CUT}'),
 race AS MATERIALIZED (SELECT lead, regime, CAST(least(coalesce(sold,seen), coalesce(moved,seen), seen) AS INTEGER) AS day, CASE WHEN sold<=coalesce(moved,sold) AND sold<=seen THEN 'CONVERTED' WHEN moved<=seen AND moved<coalesce(sold,moved+1) THEN 'TRANSFER' END AS cause FROM rc)"""


def race(t: Tables) -> DataFrame:
    """What comes first for a lead: its conversion, the client's next lead (the case moves on), or the end of what is seen."""
    nxt = F.lead("d").over(Window.partitionBy("client").orderBy("d", "lead"))
    rows = lead_conversions(t).withColumn("next_d", nxt).where(F.col("d") < CUT)
    sold, moved, seen = F.when(F.col("days") >= 0, F.col("days")), F.datediff("next_d", "d"), F.datediff(F.lit(CUT).cast("date"), "d")
    rows = rows.select("lead", F.when(F.col("d") < "1998-01-01", "EARLY").otherwise("LATE").alias("regime"), sold.alias("sold"), moved.alias("moved"), seen.alias("seen"))
    cause = first_of(((F.col("sold") <= F.coalesce("moved", "sold")) & (F.col("sold") <= F.col("seen")), "CONVERTED"), ((F.col("moved") <= F.col("seen")) & (F.col("sold").isNull() | (F.col("moved") < F.col("sold"))), "TRANSFER"))
    return rows.select("lead", "regime", F.least(F.coalesce("sold", "seen"), F.coalesce("moved", "seen"), "seen").cast("int").alias("day"), cause.alias("cause"))


INCIDENCE = f"""{RACE}, dy AS (SELECT regime, day, count(*) AS n, count(cause) AS hit FROM race GROUP BY 1,2), rk AS (SELECT *, sum(n) OVER (PARTITION BY regime ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM dy),
 sv AS (SELECT *, coalesce(exp(sum(CASE WHEN hit<at_risk THEN ln(1-hit/CAST(at_risk AS DOUBLE)) ELSE -1000 END) OVER (PARTITION BY regime ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),1) AS before FROM rk),
 ev AS (SELECT regime, day, cause, count(*) AS events FROM race WHERE cause IS NOT NULL GROUP BY 1,2,3),
 ci AS MATERIALIZED (SELECT regime, day, cause, CAST(at_risk AS BIGINT) AS at_risk, events, sum(before*events/at_risk) OVER (PARTITION BY regime, cause ORDER BY day) AS incidence FROM ev JOIN sv USING (regime, day))"""


@query("dp36_competing_risks", f"WITH {INCIDENCE} SELECT regime, day, cause, at_risk, events, round(incidence,8) AS incidence FROM ci")
def dp36_risks(t: Tables) -> DataFrame:
    """The chance by day that a lead has converted, where a transfer may come first, and the reverse."""
    return survival.cumulative_incidence(race(t), ["regime"], "day", "cause").withColumn("incidence", F.round("incidence", 8))


HORIZON_ROWS = (30, 60, 90)


@query(
    "dp38_competing_horizons",
    f"""WITH {INCIDENCE}, hz AS (SELECT unnest([{', '.join(map(str, HORIZON_ROWS))}]) AS h),
 lb AS (SELECT regime, h, count(*) AS n, count(*) FILTER (cause='CONVERTED' AND day<=h) AS converted, count(*) FILTER (cause='TRANSFER' AND day<=h) AS transferred, count(*) FILTER (cause IS NULL AND day<h) AS censored FROM race, hz GROUP BY 1,2)
 SELECT regime, CAST(h AS INTEGER) AS h, n, converted, transferred, censored, n-converted-transferred-censored AS open, (SELECT round(max(incidence),8) FROM ci WHERE ci.regime=lb.regime AND cause='CONVERTED' AND day<=h) AS incidence, CASE WHEN n<100 THEN 'THIN' WHEN censored>0.2*n THEN 'CENSORED' ELSE 'READY' END AS profile FROM lb""",
)
def dp38_horizons(t: Tables) -> DataFrame:
    """For each regime and horizon: labels, competing events, leads not seen so long, the incidence by then, and whether it can be learned from."""
    hz = F.explode(F.array(*map(F.lit, HORIZON_ROWS)))
    rows = race(t)
    cause, within = F.col("cause"), F.col("day") <= F.col("h")
    n = rows.withColumn("h", hz).groupBy("regime", "h").agg(F.count("*").alias("n"), F.count_if((cause == "CONVERTED") & within).alias("converted"), F.count_if((cause == "TRANSFER") & within).alias("transferred"), F.count_if(cause.isNull() & (F.col("day") < F.col("h"))).alias("censored"))
    ci = survival.cumulative_incidence(rows, ["regime"], "day", "cause").where("cause = 'CONVERTED'").withColumn("h", hz).where("day <= h").groupBy("regime", "h").agg(F.round(F.max("incidence"), 8).alias("incidence"))
    profile = first_of((F.col("n") < 100, "THIN"), (F.col("censored") > 0.2 * F.col("n"), "CENSORED"), otherwise="READY")
    return n.join(ci, ["regime", "h"], "left").select("regime", "h", "n", "converted", "transferred", "censored", (F.col("n") - F.col("converted") - F.col("transferred") - F.col("censored")).alias("open"), "incidence", profile.alias("profile"))


OUTLIER_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "ml28_multivariate_outliers",
    """WITH c AS (SELECT avg(l_quantity) AS ma, avg(l_extendedprice) AS mb, avg(l_discount) AS mc, var_samp(l_quantity) AS aa, var_samp(l_extendedprice) AS bb, var_samp(l_discount) AS cc, covar_samp(l_quantity,l_extendedprice) AS ab, covar_samp(l_quantity,l_discount) AS ac, covar_samp(l_extendedprice,l_discount) AS bc FROM lineitem),
 i AS (SELECT *, bb*cc-bc*bc AS iaa, ac*bc-ab*cc AS iab, ab*bc-ac*bb AS iac, aa*cc-ac*ac AS ibb, ab*ac-aa*bc AS ibc, aa*bb-ab*ab AS icc, aa*(bb*cc-bc*bc)-ab*(ab*cc-ac*bc)+ac*(ab*bc-ac*bb) AS det FROM c),
 x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity-ma AS a, l_extendedprice-mb AS b, l_discount-mc AS c, i.* EXCLUDE (ma, mb, mc, aa, bb, cc, ab, ac, bc) FROM lineitem, i),
 d AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_partkey, (a*a*iaa+b*b*ibb+c*c*icc+2*(a*b*iab+a*c*iac+b*c*ibc))/det AS distance FROM x)
 SELECT l_orderkey, l_linenumber, l_partkey, round(distance,5) AS distance FROM d WHERE distance>(SELECT quantile_cont(distance,0.98) FROM d)""",
)
def ml28_multivariate(t: Tables) -> DataFrame:
    """The 2 % of lines farthest from the others in quantity, price and discount together."""
    return outliers.farthest(t.lineitem, list(OUTLIER_COLUMNS), 0.02).select("l_orderkey", "l_linenumber", "l_partkey", F.round("distance", 5).alias("distance"))


@query("ml29_partial_dependence")
def ml29_dependence(t: Tables, steps: int = 20) -> DataFrame:
    """feature, value, chance: the mean chance if all rows had the value, from the 5 % to the 95 % quantile. All values of all features in one pass."""
    rows = lead_features(t)
    fit = regression.logit(rows, "y", list(FEATURES))
    ends = exact_quantiles(rows, list(FEATURES), [0.05, 0.95])
    weight = dict(zip(fit.columns, fit.coef, strict=True))
    grid = [(c, ends[c, 0.05] + (ends[c, 0.95] - ends[c, 0.05]) * i / (steps - 1)) for c in FEATURES for i in range(steps)]
    moved = [F.avg(1 / (1 + F.exp(-(fit.linear() + float(weight[c]) * (F.lit(v) - F.col(c)))))) for c, v in grid]
    found = regression.usable(rows, list(FEATURES)).agg(*moved).first()
    return t.spark.createDataFrame([(c, float(v), float(p)) for (c, v), p in zip(grid, found, strict=True)], "feature string, value double, chance double")


@query("ml29_sensitivity")
def ml29_sensitivity(t: Tables) -> DataFrame:
    """feature, low, base, high: the mean chance with the feature a deviation lower, as it is, and a deviation higher; odds_ratio of one unit with its interval."""
    rows = regression.usable(lead_features(t), list(FEATURES))
    fit = regression.logit(rows, "y", list(FEATURES))
    spread = rows.agg(*(F.stddev_samp(c) for c in FEATURES)).first()
    table = {r[0]: r for r in fit.rows()}
    chance = lambda shift: F.avg(1 / (1 + F.exp(-(fit.linear() + F.lit(float(shift))))))
    moves = [chance(sign * table[c][1] * s) for c, s in zip(FEATURES, spread, strict=True) for sign in (-1, 0, 1)]
    found = rows.agg(*moves).first()
    out = [(c, *map(float, found[3 * i : 3 * i + 3]), *(math.exp(table[c][k]) for k in (1, 5, 6))) for i, c in enumerate(FEATURES)]
    return t.spark.createDataFrame(out, "feature string, low double, base double, high double, odds_ratio double, odds_low double, odds_high double")


@query("ml29_permutation_all")
def ml29_permutation(t: Tables) -> DataFrame:
    """feature, brier, loss: the Brier score once a feature is exchanged among all rows, and what that costs against the plain one."""
    rows = lead_features(t).select("lead", "y", *FEATURES)
    fit = regression.logit(rows, "y", list(FEATURES))
    score = lambda df, name: df.agg(F.lit(name).alias("feature"), F.avg((fit.probability() - F.col("y")) ** 2).alias("brier"))
    out = score(rows, "none")
    for c in FEATURES:
        out = out.unionByName(score(outliers.dealt_anew(rows, "lead", [c], c), c))
    plain = score(rows, "none").select(F.col("brier").alias("plain"))
    return out.crossJoin(F.broadcast(plain)).select("feature", "brier", (F.col("brier") - F.col("plain")).alias("loss"))
