"""Forecast evidence in full: intervals known at the origin, all error metrics, guarded policies, the supervised design, run-off with milestones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import ratio
from ..operators import backtests, quantiles
from ..operators.runoff import projected_runoff
from ..operators.temporal import running
from ..registry import Tables, query
from .forecast import CELLS, HORIZONS
from .mapping import PM, project_months

LAST_H = max(HORIZONS)
STOCK = "st AS MATERIALIZED (SELECT project, month, sales, CAST(sum(sales) OVER (PARTITION BY project) - sum(sales) OVER (PARTITION BY project ORDER BY month) AS DOUBLE) AS stock FROM pm)"


def forecasts(t: Tables) -> DataFrame:
    """Three benchmarks of each project month and horizon, with what was sold, the month's own sales as the naive forecast, and the stock left."""
    w = Window.partitionBy("project").orderBy("month")
    over = lambda n: w.rowsBetween(1 - n, 0)
    pm = project_months(t)
    b = pm.withColumns({"mean3": F.avg("sales").over(over(3)), "n3": F.count("*").over(over(3)), "s12": F.first("sales").over(over(12)), "n12": F.count("*").over(over(12)), "stock": (F.sum("sales").over(Window.partitionBy("project")) - F.sum("sales").over(running(["project"], "month"))).cast("double")})
    naive = F.col("sales").cast("double")
    models = F.array(F.struct(F.lit("last").alias("model"), naive.alias("prediction")), F.struct(F.lit("mean3").alias("model"), F.when(F.col("n3") == 3, F.col("mean3")).alias("prediction")), F.struct(F.lit("season12").alias("model"), F.when(F.col("n12") == 12, F.col("s12").cast("double")).alias("prediction")))
    rows = b.select("project", F.col("month").alias("origin"), naive.alias("naive"), "stock", F.inline(models)).where("prediction is not null")
    rows = rows.withColumn("h", F.explode(F.array(*map(F.lit, HORIZONS)))).withColumn("target", F.add_months("origin", F.col("h")))
    return rows.join(pm.select("project", F.col("month").alias("target"), F.col("sales").alias("actual")), ["project", "target"], "left")


def bands(by: str) -> str:
    """SQL of all forecasts with their bands: errors pooled over the columns by, looked up origin by origin."""
    on = " AND ".join(f"e.{c}=a.{c}" for c in by.split(", "))
    rank = lambda c: f"CAST(ceil(least(100*len(errs), (len(errs)+1)*{c})*(len(errs)-1)/(100*len(errs))) AS BIGINT)+1"
    end = lambda c: f"CASE WHEN ok THEN greatest(0, prediction-errs[{rank(c)}]) END AS low{c}, CASE WHEN ok THEN least(stock, prediction+errs[{rank(c)}]) END AS high{c}"
    return f"""{CELLS}, {STOCK}, er AS MATERIALIZED (SELECT * FROM pairs WHERE actual IS NOT NULL),
ao AS MATERIALIZED (SELECT DISTINCT {by}, origin FROM pairs),
po AS MATERIALIZED (SELECT {', '.join('a.' + c for c in by.split(', '))}, a.origin, list(e.err ORDER BY e.err) AS errs, count(DISTINCT e.origin) AS origins FROM ao a JOIN er e ON {on} AND e.target<=a.origin GROUP BY ALL),
g AS (SELECT {by}, min(origin) AS o FROM er GROUP BY {by} UNION ALL SELECT {', '.join('a.' + c for c in by.split(', '))}, (SELECT min(e.origin) FROM er e WHERE {on} AND e.origin>=a.o+INTERVAL (a.h) MONTH) FROM g a WHERE a.o IS NOT NULL),
sp AS MATERIALIZED (SELECT {', '.join('a.' + c for c in by.split(', '))}, a.origin, count(e.o) AS separate FROM ao a LEFT JOIN g e ON {on} AND e.o+INTERVAL (e.h) MONTH<=a.origin GROUP BY ALL),
bn AS (SELECT p.*, stock, st.sales AS naive, coalesce(len(errs),0) AS errors, coalesce(origins,0) AS origins, separate, errs, coalesce(len(errs),0)>=20 AND coalesce(origins,0)>=3 AND separate>=2 AS ok
 FROM pairs p JOIN st ON st.project=p.project AND st.month=p.origin LEFT JOIN po ON {' AND '.join(f'po.{c}=p.{c}' for c in by.split(', '))} AND po.origin=p.origin LEFT JOIN sp ON {' AND '.join(f'sp.{c}=p.{c}' for c in by.split(', '))} AND sp.origin=p.origin),
bands AS MATERIALIZED (SELECT *, {end(80)}, {end(95)} FROM bn)"""


def with_bands(t: Tables, by: list[str]) -> DataFrame:
    return backtests.intervals_as_of(forecasts(t), by)


BAND_SQL = "SELECT project, origin, model, h, CAST(errors AS BIGINT) AS errors, CAST(origins AS INTEGER) AS origins, CAST(separate AS INTEGER) AS separate, round(low80,6) AS low80, round(high80,6) AS high80, round(low95,6) AS low95, round(high95,6) AS high95, CASE WHEN ok THEN 'EMPIRICAL_POOLED_NOT_GUARANTEED' ELSE 'INSUFFICIENT_TEMPORAL_SUPPORT' END AS interval_status FROM bands"


def band_columns(rows: DataFrame) -> DataFrame:
    return rows.select("project", "origin", "model", "h", "errors", "origins", "separate", *(F.round(c, 6).alias(c) for c in ("low80", "high80", "low95", "high95")), "interval_status")


@query("fc18_asof_intervals", f"WITH RECURSIVE {bands('model, h')} {BAND_SQL}")
def fc18_asof(t: Tables) -> DataFrame:
    """Bands of each forecast from the errors of its model and horizon, over all projects, that had come out by its origin."""
    return band_columns(with_bands(t, ["model", "h"]))


@query("fc18_project_intervals", f"WITH RECURSIVE {bands('project, model, h')} {BAND_SQL}")
def fc18_project(t: Tables) -> DataFrame:
    """The same with errors of the project alone."""
    return band_columns(with_bands(t, ["project", "model", "h"]))


@query(
    "ag13_full_metrics",
    f"""WITH RECURSIVE {bands('model, h')}, k AS (SELECT *, abs(naive-actual) AS err0 FROM bands WHERE actual IS NOT NULL),
 m AS (SELECT model, h, count(*) AS n, sum(err)/nullif(CAST(sum(actual) AS DOUBLE),0) AS wape, sum(prediction-actual)/nullif(CAST(sum(actual) AS DOUBLE),0) AS bias, avg(err) AS mae, sqrt(avg(err*err)) AS rmse, avg(err/nullif(actual,0)) AS mape, sum(err0)/nullif(CAST(sum(actual) AS DOUBLE),0) AS naive_wape, avg((err<err0)::INT) AS beat_rate,
  avg((actual BETWEEN low80 AND high80)::INT) AS coverage80, avg(high80-low80) AS width80 FROM k GROUP BY 1,2)
 SELECT model, h, n, round(wape,6) AS wape, round(bias,6) AS bias, round(mae,6) AS mae, round(rmse,6) AS rmse, round(mape,6) AS mape, round(naive_wape,6) AS naive_wape, round(1-wape/nullif(naive_wape,0),6) AS skill, round(beat_rate,6) AS beat_rate, round(coverage80,6) AS coverage80, round(width80,6) AS width80 FROM m""",
)
def ag13_full(t: Tables) -> DataFrame:
    """All metrics of a model and horizon, with the coverage and width of the 80 % bands as they were known at each origin."""
    g = with_bands(t, ["model", "h"]).groupBy("model", "h").agg(*backtests.full_metrics())
    return g.select("model", "h", "n", *(F.round(c, 6).alias(c) for c in g.columns[3:]))


GATE = "VALIDATION_PROJECT_GATE"


@query(
    "fc19_policy_decisions",
    f"""WITH RECURSIVE {CELLS}, va AS MATERIALIZED (SELECT * FROM pairs WHERE actual IS NOT NULL AND target>=DATE '1999-01-01' AND target<DATE '2000-01-01'),
 cp AS MATERIALIZED (SELECT * FROM va WHERE (model, project, origin) IN (SELECT (model, project, origin) FROM va GROUP BY model, project, origin HAVING count(*)={LAST_H} AND max(h)={LAST_H})),
 bs AS (SELECT project, count(*) AS rows0, sum(err) AS sum0 FROM cp WHERE model='mean3' GROUP BY 1),
 pr AS MATERIALIZED (SELECT b.project, b.origin, c.model AS candidate, c.err, b.err AS err0 FROM cp b JOIN cp c ON c.project=b.project AND c.origin=b.origin AND c.h=b.h AND c.model<>'mean3' WHERE b.model='mean3'),
 og AS MATERIALIZED (SELECT DISTINCT project, candidate, origin FROM pr),
 g AS (SELECT project, candidate, min(origin) AS o FROM og GROUP BY 1,2 UNION ALL SELECT g.project, g.candidate, (SELECT min(e.origin) FROM og e WHERE e.project=g.project AND e.candidate=g.candidate AND e.origin>=g.o+INTERVAL {LAST_H} MONTH) FROM g WHERE g.o IS NOT NULL),
 pa AS (SELECT project, candidate, count(*) AS n, sum(err) AS sum1, sum(err0) AS sumb, count(DISTINCT origin) AS origins FROM pr GROUP BY 1,2), sg AS (SELECT project, candidate, count(o) AS separate FROM g GROUP BY 1,2),
 d AS (SELECT b.project, k.candidate, rows0, sum0, coalesce(n,0) AS n, sum1, sumb, coalesce(origins,0) AS origins, coalesce(separate,0) AS separate, sum1/n AS mae1, sumb/n AS mae0 FROM bs b CROSS JOIN (SELECT DISTINCT model AS candidate FROM va WHERE model<>'mean3') k LEFT JOIN pa USING (project, candidate) LEFT JOIN sg USING (project, candidate)),
 e AS (SELECT *, CASE WHEN origins<3 THEN 'INSUFFICIENT_ORIGINS' WHEN separate<2 THEN 'INSUFFICIENT_NONOVERLAPPING_ORIGINS' WHEN n/rows0::DOUBLE<0.8 THEN 'INSUFFICIENT_CANDIDATE_COVERAGE' WHEN mae0=0 THEN 'BASELINE_ALREADY_EXACT' WHEN mae1>mae0*0.95 THEN 'NO_VALIDATION_IMPROVEMENT' ELSE '{GATE}' END AS decision FROM d),
 p AS (SELECT candidate, sum(rows0) AS n, sum(sum0) AS e0, sum(CASE WHEN decision='{GATE}' THEN sum0-sumb+sum1 ELSE sum0 END) AS e1, count(*) FILTER (decision='{GATE}') AS projects FROM e GROUP BY 1),
 s AS (SELECT coalesce(min({{'mae': round(e1/n,9), 'candidate': candidate}}) FILTER (projects>0 AND 1-e1/nullif(e0,0)>=0.05).candidate, 'mean3') AS selected_model FROM p)
 SELECT project, candidate, decision, e.n AS paired_rows, CAST(origins AS INTEGER) AS origins, CAST(separate AS INTEGER) AS nonoverlap_origins, round(e.n/rows0::DOUBLE,6) AS candidate_fraction, round(mae1,6) AS candidate_mae, round(mae0,6) AS baseline_mae, round(e1/p.n,6) AS policy_mae, round(1-e1/nullif(e0,0),6) AS improvement, selected_model, decision='{GATE}' AND candidate=selected_model AS use_candidate FROM e JOIN p USING (candidate) CROSS JOIN s""",
)
def fc19_decisions(t: Tables) -> DataFrame:
    """Which candidate each project may take in place of the three-month mean, judged on targets of 1999 only."""
    validation = forecasts(t).where("actual is not null and target >= '1999-01-01' and target < '2000-01-01'")
    d = backtests.policy_decisions(validation, LAST_H)
    rounded = {"candidate_fraction", "candidate_mae", "baseline_mae", "policy_mae", "improvement"}
    return d.select(*(F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in d.columns))


@query(
    "fc02_full_design",
    f"""WITH {PM}, b AS (SELECT project, month, sales, sum(sales) OVER (PARTITION BY project)-sum(sales) OVER w AS stock, sum(sales) OVER (PARTITION BY project)-sum(sales) OVER w+sales AS opening, greatest(falls-sales,0) AS inflows, row_number() OVER w-1 AS age, avg(sales) OVER p3 AS mean3, first_value(sales) OVER p3 AS before FROM pm WINDOW w AS (PARTITION BY project ORDER BY month), p3 AS (PARTITION BY project ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
 f AS (SELECT *, count(*) OVER f6=6 AND coalesce(sum(inflows) OVER f6,0)=0 AND sum(sales) OVER f6<=stock AS whole, {', '.join(f'sum(sales) OVER (PARTITION BY project ORDER BY month ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS c{h}' for h in range(1, 7))} FROM b WINDOW f6 AS (PARTITION BY project ORDER BY month ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING))
 SELECT project, month, CAST(stock AS DOUBLE) AS stock, CAST(sales AS DOUBLE) AS sales, round(mean3,6) AS mean3, CAST(sales-before AS DOUBLE) AS trend, round(sales/CAST(greatest(opening+inflows,1) AS DOUBLE),6) AS absorption, round(ln(1+stock),6) AS log_stock, CAST(age AS DOUBLE) AS age, round(sin(2*pi()*month(month)/12),6) AS month_sin, round(cos(2*pi()*month(month)/12),6) AS month_cos, {', '.join(f'CASE WHEN whole THEN round(c{h}/CAST(stock AS DOUBLE),6) END AS y{h}' for h in range(1, 7))} FROM f WHERE stock>0""",
)
def fc02_full(t: Tables, horizon: int = 6) -> DataFrame:
    """Eight features known at the month's end and, where no new stock comes and no more is sold than there is, the shares of the stock sold up to each later month."""
    w = Window.partitionBy("project").orderBy("month")
    run, ahead = running(["project"], "month"), w.rowsBetween(1, horizon)
    stock = F.sum("sales").over(Window.partitionBy("project")) - F.sum("sales").over(run)
    b = project_months(t).withColumns({"stock": stock, "inflows": F.greatest(F.col("falls") - F.col("sales"), F.lit(0)), "age": F.row_number().over(w) - 1})
    angle = 2 * F.pi() * F.month("month") / 12
    whole = (F.count("*").over(ahead) == horizon) & (F.coalesce(F.sum("inflows").over(ahead), F.lit(0)) == 0) & (F.sum("sales").over(ahead) <= F.col("stock"))
    features = {
        "mean3": F.round(F.avg("sales").over(w.rowsBetween(-2, 0)), 6),
        "trend": (F.col("sales") - F.first("sales").over(w.rowsBetween(-2, 0))).cast("double"),
        "absorption": F.round(ratio(F.col("sales"), F.greatest(F.col("stock") + F.col("sales") + F.col("inflows"), F.lit(1))), 6),
        "log_stock": F.round(F.log1p("stock"), 6),
        "month_sin": F.round(F.sin(angle), 6),
        "month_cos": F.round(F.cos(angle), 6),
    }
    shares = {f"y{h}": F.when(whole, F.round(ratio(F.sum("sales").over(w.rowsBetween(1, h)), F.col("stock")), 6)) for h in range(1, horizon + 1)}
    rows = b.withColumns(features | shares).where("stock > 0")
    return rows.select("project", "month", F.col("stock").cast("double").alias("stock"), F.col("sales").cast("double").alias("sales"), "mean3", "trend", "absorption", "log_stock", F.col("age").cast("double").alias("age"), "month_sin", "month_cos", *shares)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def profile_sql(table: str, c: str) -> str:
    quantile = lambda p: f"round(quantile_cont({c},{p}),6) AS q{round(100 * p):02d}"
    return f"SELECT '{c}' AS column_name, count(*) AS observations, round(1-count({c})/CAST(count(*) AS DOUBLE),6) AS null_rate, round(count(*) FILTER ({c}=0)/CAST(count({c}) AS DOUBLE),6) AS zero_rate, round(avg({c}),6) AS mean, round(stddev_samp({c}),6) AS sd, min({c}) AS lo, {', '.join(map(quantile, (0.05, 0.25, 0.5, 0.75, 0.95)))}, max({c}) AS hi, round(skewness({c}),6) AS skew, round(kurtosis({c}),6) AS kurtosis FROM {table}"


@query("ag24_exact_profile", " UNION ALL ".join(profile_sql("lineitem", c) for c in NUMBERS))
def ag24_exact(t: Tables) -> DataFrame:
    g = quantiles.numeric_profile(t.lineitem, list(NUMBERS))
    exact = {"column_name", "observations", "lo", "hi"}
    return g.select(*(F.col(c) if c in exact else F.round(c, 6).alias(c) for c in g.columns))


SCENARIOS = (("BASE", 1, 3, 0.5), ("BASE", 4, 8, 1.0), ("BASE", 9, 12, 1.5), ("RAPIDO", 1, 2, 1.0), ("RAPIDO", 3, 12, 2.0))
MILESTONES = ((1, 3, 0.25, 0.02), (2, 6, 0.5, 0.03), (3, 9, 0.75, 0.04), (4, 12, 0.9, 0.05))
_FACTORS = ", ".join(f"('{s}',{a},{b},{f}::DOUBLE)" for s, a, b, f in SCENARIOS)
_STONES = ", ".join(f"({n},{m},{s}::DOUBLE,{r}::DOUBLE)" for n, m, s, r in MILESTONES)


@query(
    "dp14_milestone_runoff",
    f"""WITH RECURSIVE base AS (SELECT p_brand AS project, p_type AS typology, count(*)::DOUBLE AS stock, avg(p_retailprice) AS price, count(*)*0.1::DOUBLE AS monthly FROM part GROUP BY 1,2),
 f(scenario, lo, hi, factor) AS (VALUES {_FACTORS}), ms(n, month, share, rise) AS (VALUES {_STONES}), sc AS (SELECT DISTINCT scenario FROM f),
 r AS (SELECT project, typology, scenario, stock AS total, price AS base_price, monthly, 0 AS month, stock AS opening, 0.0::DOUBLE AS sold, stock AS closing, 0.0::DOUBLE AS cumulative, 0.0::DOUBLE AS revenue FROM base, sc
  UNION ALL SELECT project, typology, scenario, total, base_price, monthly, month+1, closing, v, greatest(0, closing-v), cumulative+v,
   revenue+v*base_price*(1+(SELECT coalesce(sum(rise),0) FROM ms WHERE x.month+1>=ms.month OR (CASE WHEN total=0 THEN 0 ELSE (cumulative+v)/total END)>=share))
   FROM (SELECT *, CASE WHEN closing<=0 THEN 0 ELSE least(closing, monthly*coalesce((SELECT factor FROM f WHERE f.scenario=r.scenario AND r.month+1 BETWEEN lo AND hi ORDER BY lo LIMIT 1),1)) END AS v FROM r) x WHERE month<12)
 SELECT project, typology, scenario, month, round(opening,6) AS opening, round(sold,6) AS sold, round(closing,6) AS closing, round(cumulative/nullif(total,0),6) AS sold_share, CAST((SELECT count(*) FROM ms WHERE r.month>=ms.month OR cumulative/nullif(total,0)>=share) AS INTEGER) AS milestones,
  round(base_price*(1+(SELECT coalesce(sum(rise),0) FROM ms WHERE r.month>=ms.month OR cumulative/nullif(total,0)>=share)),6) AS price, round(revenue+1e-9,4) AS revenue, closing<=0 AS stockout FROM r WHERE month>0""",
)
def dp14_milestones(t: Tables) -> DataFrame:
    """Twelve months of each project, typology and scenario; the price rises by each milestone whose month has come or whose sold share is reached."""
    base = t.part.groupBy(F.col("p_brand").alias("project"), F.col("p_type").alias("typology")).agg(F.count("*").cast("double").alias("stock"), F.avg("p_retailprice").alias("price"), (F.count("*") * 0.1).cast("double").alias("monthly"))
    g = projected_runoff(base, ["project", "typology"], SCENARIOS, MILESTONES, 12)
    exact = {"project", "typology", "scenario", "month", "milestones", "stockout"}
    money = F.round(F.col("revenue") + 1e-9, 4).alias("revenue")  # halves are exact in products of few digits
    return g.select(*(F.col(c) if c in exact else money if c == "revenue" else F.round(c, 6).alias(c) for c in g.columns))
