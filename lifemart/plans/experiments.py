"""Experiments in full, interval scores by stock, cumulative targets, windows of several widths and loads under versioned rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..operators import experiments
from ..operators.temporal import first_after
from ..registry import Tables, query
from ..sources import ingest
from ..streaming import streams
from .evidence import bands, with_bands
from .forecast import HORIZONS
from .mapping import PM, project_months
from .marts import COHORT, cohort
from .streams import event_stream

AS_OF, COST = "2001-06-01", 50.0
OUTCOMES = (("sep_14d", 14), ("sale_60d", 60))
#: An action is the client's next urgent order within 30 days; recommendations went to treated leads, and by mistake to some control leads.
UNITS = f"""{COHORT}, un AS MATERIALIZED (SELECT a.lead, a.project, a.arm, l.d, a.amount, a.days, a.arm='TREATED' OR a.lead%41=0 AS recommended, coalesce((SELECT min(CAST(o_orderdate AS DATE)) FROM orders o WHERE o.o_custkey=a.client AND o_orderpriority='1-URGENT' AND o_orderdate>CAST(l.d+1 AS TIMESTAMP))<=l.d+30, FALSE) AS acted FROM arm a JOIN lc l ON l.lead=a.lead),
 lo AS (SELECT u.*, o.outcome AS name, CASE WHEN d+o.h<=DATE '{AS_OF}' THEN coalesce(days>=0 AND days<o.h, FALSE)::INT END AS outcome FROM un u, (VALUES {', '.join(f"('{n}',{h})" for n, h in OUTCOMES)}) o(outcome, h))"""


def units(t: Tables) -> DataFrame:
    """A row for each lead of the cohort and outcome."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("client"), "o_orderdate", F.to_date("o_orderdate").alias("next"))
    rows = cohort(t).withColumn("at", F.date_add("d", 1).cast("timestamp_ntz") + F.expr("INTERVAL 1 MICROSECOND"))
    rows = first_after(rows, urgent.withColumn("key", F.col("next")), ["client"], "at", "o_orderdate", ["next"])
    acted = F.coalesce(F.col("next") <= F.date_add("d", 30), F.lit(False))
    named = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(h).alias("h")) for n, h in OUTCOMES)))
    rows = rows.select("lead", "project", "arm", "d", "amount", "days", ((F.col("arm") == "TREATED") | (F.col("lead") % 41 == 0)).alias("recommended"), acted.alias("acted"), named.alias("o"))
    ripe = F.date_add("d", F.col("o.h")) <= AS_OF
    return rows.withColumn("name", F.col("o.name")).withColumn("outcome", F.when(ripe, F.coalesce((F.col("days") >= 0) & (F.col("days") < F.col("o.h")), F.lit(False)).cast("int"))).drop("o")


def arms(sql: str) -> str:
    return ", ".join(sql.format(arm=a, name=n) for a, n in (("TREATED", "treated"), ("CONTROL", "control")))


@query(
    "dp46_experiment_performance",
    f"""WITH {UNITS}, g AS (SELECT name, project, {arms("count(*) FILTER (arm='{arm}') AS {name}_assigned, count(outcome) FILTER (arm='{arm}') AS {name}_matured, CAST(coalesce(sum(outcome) FILTER (arm='{arm}'),0) AS BIGINT) AS {name}_positive, count(*) FILTER (arm='{arm}' AND recommended) AS {name}_recommended, count(*) FILTER (arm='{arm}' AND acted) AS {name}_acted")} FROM lo GROUP BY 1,2),
 r AS (SELECT *, treated_positive/nullif(CAST(treated_matured AS DOUBLE),0) AS pt, control_positive/nullif(CAST(control_matured AS DOUBLE),0) AS pc, control_recommended>0 OR control_acted>0 AS contaminated, treated_matured>0 AND control_matured>0 AS ripe FROM g),
 e AS (SELECT *, sqrt(pt*(1-pt)/treated_matured+pc*(1-pc)/control_matured) AS se FROM r)
 SELECT name, project, treated_assigned, treated_matured, treated_positive, treated_recommended, treated_acted, control_assigned, control_matured, control_positive, control_recommended, control_acted, round(pt,6) AS treated_rate, round(pc,6) AS control_rate, CASE WHEN ripe THEN round(100*(pt-pc),6) END AS itt_points, CASE WHEN ripe THEN round(100*(pt-pc-1.96*se),6) END AS itt_low, CASE WHEN ripe THEN round(100*(pt-pc+1.96*se),6) END AS itt_high, CASE WHEN ripe THEN round(pt/nullif(pc,0)-1,6) END AS lift, round(treated_matured/nullif(CAST(treated_assigned AS DOUBLE),0),6) AS treated_maturity, round(control_matured/nullif(CAST(control_assigned AS DOUBLE),0),6) AS control_maturity, round(treated_acted/nullif(CAST(treated_assigned AS DOUBLE),0),6) AS action_rate, contaminated, CASE WHEN treated_assigned=0 OR control_assigned=0 THEN 'NO_COMPARISON_GROUP' WHEN NOT ripe THEN 'WAITING_MATURITY' WHEN contaminated THEN 'CONTROL_CONTAMINATION' ELSE 'READY_FOR_ITT_REVIEW' END AS status FROM e""",
)
def dp46_performance(t: Tables) -> DataFrame:
    g = experiments.performance(units(t), ["name", "project"])
    rates = {"treated_rate", "control_rate", "itt_points", "itt_low", "itt_high", "lift", "treated_maturity", "control_maturity", "action_rate"}
    return g.select(*(F.round(c, 6).alias(c) if c in rates else F.col(c) for c in g.columns))


@query(
    "dp46_economic_value",
    f"""WITH {UNITS}, v AS (SELECT *, CASE WHEN lead%97<>0 THEN amount*outcome END AS value, CASE WHEN acted THEN {COST}::DOUBLE ELSE 0 END AS cost FROM lo WHERE name='sale_60d'),
 g AS (SELECT project, {arms("count(*) FILTER (arm='{arm}') AS {name}_assigned, count(outcome) FILTER (arm='{arm}') AS {name}_matured, count(value) FILTER (arm='{arm}' AND outcome IS NOT NULL) AS {name}_valued, avg(value) FILTER (arm='{arm}' AND outcome IS NOT NULL) AS {name}_mean_value")}, coalesce(sum(cost) FILTER (arm='TREATED'),0) AS action_cost FROM v GROUP BY 1),
 w AS (SELECT *, treated_matured>0 AND control_matured>0 AS ripe, treated_valued=treated_matured AND control_valued=control_matured AS whole FROM g), x AS (SELECT *, CASE WHEN ripe AND whole THEN (treated_mean_value-control_mean_value)*treated_matured END AS gain FROM w)
 SELECT project, treated_assigned, treated_matured, treated_valued, round(treated_mean_value,4) AS treated_mean_value, control_assigned, control_matured, control_valued, round(control_mean_value,4) AS control_mean_value, action_cost, round(gain,3) AS incremental_value, round(gain-action_cost,3) AS net_value, CASE WHEN action_cost>0 THEN round((gain-action_cost)/action_cost,5) END AS return_on_cost, CASE WHEN treated_assigned=0 OR control_assigned=0 THEN 'WAITING_COMPARISON_GROUP' WHEN NOT ripe THEN 'WAITING_OUTCOME_MATURITY' WHEN NOT whole THEN 'WAITING_REALIZED_VALUE' ELSE 'READY_FOR_ECONOMIC_ITT_REVIEW' END AS status FROM x""",
)
def dp46_value(t: Tables) -> DataFrame:
    """Values are told of a project only where all its ripe leads have one; some leads' values have not come in."""
    rows = units(t).where("name = 'sale_60d'").withColumns({"value": F.when(F.col("lead") % 97 != 0, F.col("amount") * F.col("outcome")), "cost": F.when(F.col("acted"), COST).otherwise(0.0)})
    digits = {"treated_mean_value": 4, "control_mean_value": 4, "incremental_value": 3, "net_value": 3, "return_on_cost": 5}
    g = experiments.economic_value(rows, ["project"])
    return g.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in g.columns))


def scored(c: int) -> str:
    a = (100 - c) / 100
    return f"round(avg((actual BETWEEN low{c} AND high{c})::INT),6) AS coverage{c}, round(avg(high{c}-low{c}),6) AS width{c}, round(avg(high{c}-low{c}+{2 / a!r}::DOUBLE*greatest(low{c}-actual,0)+{2 / a!r}::DOUBLE*greatest(actual-high{c},0)),6) AS score{c}"


@query("fc20_interval_scores", f"WITH RECURSIVE {bands('model, h')}, k AS (SELECT *, CASE WHEN stock<=0 THEN 'AGOTADO' WHEN stock<500 THEN 'BAJO' WHEN stock<2500 THEN 'MEDIO' ELSE 'ALTO' END AS stock_band FROM bands WHERE actual IS NOT NULL AND ok) SELECT model, h, stock_band, count(*) AS n, {scored(80)}, {scored(95)} FROM k GROUP BY 1,2,3")
def fc20_scores(t: Tables) -> DataFrame:
    """Coverage, width and interval score (width, and two over alpha of what an outcome lies outside) by model, horizon and band of the stock left."""
    s = F.col("stock")
    rows = with_bands(t, ["model", "h"]).where("actual is not null and low80 is not null").withColumn("stock_band", first_of((s <= 0, "AGOTADO"), (s < 500, "BAJO"), (s < 2500, "MEDIO"), otherwise="ALTO"))
    parts = [F.count("*").alias("n")]
    for c in (80, 95):
        low, high, y, weight = F.col(f"low{c}"), F.col(f"high{c}"), F.col("actual"), 2 / ((100 - c) / 100)
        outside = F.greatest(low - y, F.lit(0.0)) + F.greatest(y - high, F.lit(0.0))
        parts += [F.round(F.avg(y.between(low, high).cast("int")), 6).alias(f"coverage{c}"), F.round(F.avg(high - low), 6).alias(f"width{c}"), F.round(F.avg(high - low + weight * outside), 6).alias(f"score{c}")]
    return rows.groupBy("model", "h", "stock_band").agg(*parts)


@query("jn22_cumulative_actual", f"WITH {PM} SELECT a.project, a.month AS origin, h, CASE WHEN count(b.month)=h THEN CAST(sum(b.sales) AS BIGINT) END AS actual, CAST(count(b.month) AS INTEGER) AS months FROM pm a CROSS JOIN (VALUES {', '.join(f'({h})' for h in HORIZONS)}) x(h) LEFT JOIN pm b ON b.project=a.project AND b.month>a.month AND b.month<=a.month+INTERVAL (h) MONTH GROUP BY 1,2,3")
def jn22_cumulative(t: Tables) -> DataFrame:
    """What was sold from an origin to each horizon, once all its months are there: range windows over month numbers, no join."""
    rows = project_months(t).withColumn("i", F.year("month") * 12 + F.month("month"))
    w = Window.partitionBy("project").orderBy("i")
    parts = [F.struct(F.lit(h).alias("h"), F.sum("sales").over(w.rangeBetween(1, h)).alias("s"), F.count("*").over(w.rangeBetween(1, h)).cast("int").alias("months")) for h in HORIZONS]
    rows = rows.select("project", F.col("month").alias("origin"), *(p.alias(f"p{i}") for i, p in enumerate(parts))).select("project", "origin", F.inline(F.array(*(f"p{i}" for i in range(len(parts))))))
    return rows.select("project", "origin", "h", F.when(F.col("months") == F.col("h"), F.col("s")).alias("actual"), "months")


WIDTHS = (("hour", "1 hour", None, None), ("day", "1 day", None, None), ("week", "1 week", None, "4 days"), ("last_7_days", "7 days", "1 day", None))


@query("st05_window_widths", "SELECT 'hour' AS width, date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 2,3 UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS TIMESTAMP), event_type, count(*) FROM events GROUP BY 2,3 UNION ALL SELECT 'week', CAST(date_trunc('week', ts) AS TIMESTAMP), event_type, count(*) FROM events GROUP BY 2,3 UNION ALL SELECT 'last_7_days', start, event_type, count(*) FROM (SELECT CAST(CAST(ts AS DATE)-CAST(k AS INTEGER) AS TIMESTAMP) AS start, event_type FROM events, (SELECT unnest(range(7)) AS k)) GROUP BY 2,3")
def st05_widths(t: Tables) -> DataFrame:
    """Tumbling windows of an hour, a day and a week from Monday, and the last seven days of each day, of the stream of events."""
    rows = event_stream(t).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out = None
    for name, width, slide, start in WIDTHS:
        one = streams.run_to_table(streams.windowed_counts(rows, "ts", width, "event_type", slide, start=start), "complete").select(F.lit(name).alias("width"), F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("src17_rule_versions", "WITH s AS (SELECT c_custkey AS k, c_acctbal+(c_custkey%11=0)::INT AS v FROM customer WHERE c_custkey%13<>1), z AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey%17<>1), d AS (SELECT CASE WHEN z.k IS NULL THEN 'INSERT' WHEN s.k IS NULL THEN 'DELETE' WHEN s.v<>z.v THEN 'UPDATE' ELSE 'UNCHANGED' END AS what FROM s FULL JOIN z ON s.k=z.k) SELECT 'SAME_RULES' AS run, what, count(*) AS n FROM d GROUP BY 2 UNION ALL SELECT 'NEW_RULES', CASE what WHEN 'DELETE' THEN 'DELETE' WHEN 'INSERT' THEN 'INSERT' ELSE 'REBUILD' END, count(*) FROM d GROUP BY 2 UNION ALL SELECT 'GATE', 'MISMATCH', 0")
def src17_rules(t: Tables) -> DataFrame:
    """What a load does to each key under the rules that the target was made by and under new ones, and the gate: keys or hashes in which the finished target and the source differ."""
    s = t.customer.where("c_custkey % 13 <> 1").select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") + (F.col("c_custkey") % 11 == 0).cast("int")).alias("v"))
    z = ingest.hashed(t.customer.where("c_custkey % 17 <> 1").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v")), ["v"], "rules-1")
    out = None
    for run, rules in (("SAME_RULES", "rules-1"), ("NEW_RULES", "rules-2")):
        one = ingest.load_plan(s, z, ["k"], ["v"], rules).groupBy("what").agg(F.count("*").alias("n")).select(F.lit(run).alias("run"), "what", "n")
        out = one if out is None else out.unionByName(one)
    made = ingest.apply_plan(s, z, ["k"], ["v"], "rules-2")
    return out.unionByName(ingest.hash_mismatches(s, made, ["k"], ["v"], "rules-2").agg(F.count("*").alias("n")).select(F.lit("GATE").alias("run"), F.lit("MISMATCH").alias("what"), "n"))
