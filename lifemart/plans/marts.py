"""Commercial marts: stock, pricing, funnels, cohorts, audiences, experiments and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio, reasons
from ..operators.temporal import latest, month_of, running, trailing
from ..registry import Tables, query
from .ledger import DAYS, LEDGER, MOVES, STOCK, daily_moves, dp01, dp05, dp07, ledger, project_days
from .mapping import CONV, LEADS, PE, PM, conversions, leads, process_events, project_months
from .relations import ACTIONS, jn18

LC = f"{LEADS}, {CONV}, lc AS (SELECT *, converted-d AS days FROM leads LEFT JOIN conv USING (lead))"


def lead_conversions(t: Tables) -> DataFrame:
    return leads(t).join(conversions(t), "lead", "left").withColumn("days", F.datediff("converted", "d"))


@query("dp02_payment_evidence", f"WITH {LC} SELECT lead, min(l_shipdate) AS first_payment, round(sum(l_extendedprice),2) AS paid, bool_or(l_returnflag='R') AS any_return FROM leads JOIN lineitem ON lead=l_orderkey GROUP BY 1")
def dp02(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("lead")).agg(F.min("l_shipdate").alias("first_payment"), F.round(F.sum("l_extendedprice"), 2).alias("paid"), F.bool_or(F.col("l_returnflag") == "R").alias("any_return"))
    return leads(t).select("lead").join(lines, "lead")


@query("dp09_inferred_lifecycle", f"WITH {PE}, a AS (SELECT project, CAST(min(d)-INTERVAL 1 MONTH AS DATE) AS start_day, count(DISTINCT unit) AS units FROM pe WHERE kind='SEPARACION' GROUP BY 1), m AS (SELECT project, start_day AS day, units AS delta FROM a UNION ALL SELECT project, d, -count(*) FROM pe WHERE kind='SEPARACION' GROUP BY 1,2) SELECT project, day, CAST(delta AS BIGINT) AS delta, CAST(sum(delta) OVER (PARTITION BY project ORDER BY day) AS BIGINT) AS stock, 'INFERIDO' AS evidence FROM m")
def dp09(t: Tables) -> DataFrame:
    sep = process_events(t).where("kind = 'SEPARACION'")
    start = sep.groupBy("project").agg(F.add_months(F.min("d"), -1).alias("day"), F.count_distinct("unit").alias("delta"))
    moves = start.unionByName(sep.groupBy("project", F.col("d").alias("day")).agg((-F.count("*")).alias("delta")))
    return moves.select("project", "day", "delta", F.sum("delta").over(running(["project"], "day")).alias("stock"), F.lit("INFERIDO").alias("evidence"))


@query("wn03_inferred_absorption", f"WITH {PE}, {DAYS}, m AS (SELECT project, d AS day, count(*) AS n FROM pe WHERE kind='SEPARACION' GROUP BY 1,2) SELECT project, day, CAST(sum(coalesce(n,0)) OVER (PARTITION BY project ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS gross_7 FROM days LEFT JOIN m USING (project, day)")
def wn03(t: Tables) -> DataFrame:
    m = process_events(t).where("kind = 'SEPARACION'").groupBy("project", F.col("d").alias("day")).agg(F.count("*").alias("n"))
    return project_days(t).join(m, ["project", "day"], "left").select("project", "day", F.sum(F.coalesce("n", F.lit(0))).over(trailing(["project"], "day", 7)).alias("gross_7"))


@query("dp10_inventory_kpis", "SELECT p_brand AS project, p_type AS typology, count(*) AS units, round(avg(p_retailprice),6) AS mean_price, round(quantile_cont(p_retailprice,0.5),6) AS median_price, round(avg(p_retailprice/nullif(p_size,0)),6) AS price_per_area FROM part GROUP BY 1,2")
def dp10(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_brand").alias("project"), F.col("p_type").alias("typology")).agg(F.count("*").alias("units"), F.round(F.avg("p_retailprice"), 6).alias("mean_price"), F.round(F.percentile("p_retailprice", 0.5), 6).alias("median_price"), F.round(F.avg(ratio(F.col("p_retailprice"), F.col("p_size"))), 6).alias("price_per_area"))


@query("dp11_stock_export", "WITH sold AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate>=TIMESTAMP '2001-06-01') SELECT p_brand AS project, count(*) FILTER (l_partkey IS NULL) AS available, count(*) FILTER (l_partkey IS NOT NULL) AS sold, round(sum(CASE WHEN l_partkey IS NULL THEN p_retailprice*(CASE WHEN p_name LIKE '%red%' THEN 0.95 ELSE 1 END) ELSE 0 END),6) AS list_value FROM part LEFT JOIN sold ON p_partkey=l_partkey GROUP BY 1")
def dp11(t: Tables) -> DataFrame:
    sold = t.lineitem.where(F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")).select("l_partkey").distinct()
    free = F.col("l_partkey").isNull()
    price = F.col("p_retailprice") * F.when(F.col("p_name").contains("red"), 0.95).otherwise(1.0)
    return t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy(F.col("p_brand").alias("project")).agg(F.count_if(free).alias("available"), F.count_if(~free).alias("sold"), F.round(F.sum(F.when(free, price).otherwise(0.0)), 6).alias("list_value"))


@query("dp12_monthly_stock_movement", f"WITH RECURSIVE {STOCK}, x AS (SELECT *, CAST(date_trunc('week', day) AS DATE) AS week FROM stock) SELECT project, week, arg_min(closing-delta, day) AS opening, CAST(sum(entries) AS BIGINT) AS entries, CAST(sum(sales) AS BIGINT) AS sales, arg_max(closing, day) AS closing FROM x GROUP BY 1,2")
def dp12(t: Tables) -> DataFrame:
    return dp07(t).groupBy("project", F.trunc("day", "week").alias("week")).agg(F.min_by("opening", "day").alias("opening"), F.sum("entries").alias("entries"), F.sum("sales").alias("sales"), F.max_by("closing", "day").alias("closing"))


@query("dp13_pricing_positioning", "WITH m AS (SELECT p_type, p_size//10 AS band, quantile_cont(p_retailprice,0.5) AS med FROM part GROUP BY 1,2) SELECT p_partkey, round(p_retailprice/med-1,6) AS gap, CASE WHEN p_retailprice/med-1>0.05 THEN 'SOBRE' WHEN p_retailprice/med-1<-0.05 THEN 'BAJO' ELSE 'CORREDOR' END AS position FROM part p JOIN m ON m.p_type IS NOT DISTINCT FROM p.p_type AND m.band IS NOT DISTINCT FROM p.p_size//10")
def dp13(t: Tables) -> DataFrame:
    band = F.floor(F.col("p_size") / 10)
    m = t.part.groupBy(F.col("p_type").alias("k"), band.alias("b")).agg(F.percentile("p_retailprice", 0.5).alias("med"))
    gap = F.col("p_retailprice") / F.col("med") - 1
    j = t.part.join(m, F.col("p_type").eqNullSafe(F.col("k")) & band.eqNullSafe(F.col("b")))
    return j.select("p_partkey", F.round(gap, 6).alias("gap"), first_of((gap > 0.05, "SOBRE"), (gap < -0.05, "BAJO"), otherwise="CORREDOR").alias("position"))


FACTORS = "(VALUES (1,0.5::DOUBLE,0.0::DOUBLE),(2,1.0,0.02),(3,1.5,0.02),(4,2.0,0.05),(5,2.0,0.05),(6,1.0,0.05)) f(m, factor, step)"


@query("dp14_capped_runoff", f"WITH base AS (SELECT p_brand AS project, count(*)::DOUBLE AS stock, avg(p_retailprice) AS price FROM part GROUP BY 1), c AS (SELECT project, m, price*(1+step) AS price, least(stock, sum(stock*0.15*factor) OVER (PARTITION BY project ORDER BY m)) AS cum FROM base CROSS JOIN {FACTORS}), i AS (SELECT *, cum-coalesce(lag(cum) OVER (PARTITION BY project ORDER BY m),0) AS sold FROM c) SELECT project, m, round(sold,6) AS sold, round(sum(sold*price) OVER (PARTITION BY project ORDER BY m),6) AS revenue FROM i")
def dp14(t: Tables) -> DataFrame:
    factors = t.spark.createDataFrame([(1, 0.5, 0.0), (2, 1.0, 0.02), (3, 1.5, 0.02), (4, 2.0, 0.05), (5, 2.0, 0.05), (6, 1.0, 0.05)], "m int, factor double, step double")
    base = t.part.groupBy(F.col("p_brand").alias("project")).agg(F.count("*").cast("double").alias("stock"), F.avg("p_retailprice").alias("price"))
    w = running(["project"], "m")
    c = base.crossJoin(F.broadcast(factors)).withColumn("cum", F.least("stock", F.sum(F.col("stock") * 0.15 * F.col("factor")).over(w)))
    i = c.withColumn("sold", F.col("cum") - F.coalesce(F.lag("cum").over(Window.partitionBy("project").orderBy("m")), F.lit(0.0)))
    return i.select("project", "m", F.round("sold", 6).alias("sold"), F.round(F.sum(F.col("sold") * F.col("price") * (1 + F.col("step"))).over(w), 6).alias("revenue"))


@query("dp57_runoff_health", f"WITH r AS (SELECT p_brand AS project, m FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN {FACTORS}) SELECT project, count(*) AS n, count(*)=6 AS complete, count(*)-count(DISTINCT m) AS duplicates FROM r GROUP BY 1")
def dp57(t: Tables) -> DataFrame:
    return dp14(t).groupBy("project").agg(F.count("*").alias("n"), (F.count("*") == 6).alias("complete"), (F.count("*") - F.count_distinct("m")).alias("duplicates"))


GRID = "(VALUES (-0.05::DOUBLE),(0.0),(0.03),(0.08)) g(delta)"


@query("dp15_sensitivity_table", f"WITH b AS (SELECT p_brand AS project, count(*)::DOUBLE AS stock, avg(p_retailprice) AS price FROM part GROUP BY 1), s AS (SELECT project, delta, stock*pow(1+delta,-1.5) AS volume, stock*pow(1+delta,-1.5)*price*(1+delta) AS revenue, pow(1+delta,-1.5)>=0.9 AS kept FROM b CROSS JOIN {GRID}), r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY CASE WHEN kept THEN 0 ELSE 1 END, round(revenue,4) DESC, delta) rk FROM s) SELECT project, delta, round(volume,6) AS volume, round(revenue,4) AS revenue, rk=1 AS pick FROM r")
def dp15(t: Tables) -> DataFrame:
    deltas = t.spark.createDataFrame([(-0.05,), (0.0,), (0.03,), (0.08,)], "delta double")
    b = t.part.groupBy(F.col("p_brand").alias("project")).agg(F.count("*").cast("double").alias("stock"), F.avg("p_retailprice").alias("price"))
    keep = F.pow(1 + F.col("delta"), F.lit(-1.5))
    s = b.crossJoin(F.broadcast(deltas)).withColumns({"volume": F.col("stock") * keep, "kept": keep >= 0.9}).withColumn("revenue", F.col("volume") * F.col("price") * (1 + F.col("delta")))
    rank = F.row_number().over(Window.partitionBy("project").orderBy(F.when(F.col("kept"), 0).otherwise(1), F.round("revenue", 4).desc(), "delta"))
    return s.select("project", "delta", F.round("volume", 6).alias("volume"), F.round("revenue", 4).alias("revenue"), (rank == 1).alias("pick"))


@query("dp16_impact_baseline", f"WITH {PM}, b AS (SELECT project, CAST(sum(sales) AS BIGINT) AS sales, CAST(sum(sales-falls) AS BIGINT) AS net FROM pm GROUP BY 1) SELECT project, code, round(net*(1+u),4) AS placed, round(greatest(sales-net*(1+u),0),4) AS gap FROM b CROSS JOIN (VALUES ('BASE',0.0::DOUBLE),('UP5',0.05),('UP10',0.1)) s(code,u)")
def dp16(t: Tables) -> DataFrame:
    scenarios = t.spark.createDataFrame([("BASE", 0.0), ("UP5", 0.05), ("UP10", 0.1)], "code string, u double")
    b = project_months(t).groupBy("project").agg(F.sum("sales").alias("sales"), F.sum(F.col("sales") - F.col("falls")).alias("net"))
    placed = F.col("net") * (1 + F.col("u"))
    return b.crossJoin(F.broadcast(scenarios)).select("project", "code", F.round(placed, 4).alias("placed"), F.round(F.greatest(F.col("sales") - placed, F.lit(0.0)), 4).alias("gap"))


@query("dp17_owner_equipment", "WITH own AS (SELECT o_custkey, bool_or(p_type='ECONOMY') AS a, count(DISTINCT p_partkey) AS parts FROM orders JOIN lineitem ON l_orderkey=o_orderkey JOIN part ON p_partkey=l_partkey GROUP BY 1) SELECT o_custkey, a AS has_economy, parts FROM own")
def dp17(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
    return lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.bool_or(F.col("p_type") == "ECONOMY").alias("has_economy"), F.count_distinct("p_partkey").alias("parts"))


@query("dp18_process_files", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place, count(*) FILTER (l_returnflag='R') OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS returns_so_far, bool_or(l_returnflag='R') OVER (PARTITION BY l_orderkey) AS any_return FROM lineitem")
def dp18(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    back = F.col("l_returnflag") == "R"
    return t.lineitem.select("l_orderkey", "l_linenumber", F.row_number().over(w).cast("long").alias("place"), F.count(F.when(back, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("returns_so_far"), F.bool_or(back).over(Window.partitionBy("l_orderkey")).alias("any_return"))


ATTR = f"{LC}, best AS (SELECT lead, client, channel, d, converted, row_number() OVER (PARTITION BY client, converted ORDER BY CASE channel WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2 ELSE 3 END, d, lead) r FROM lc WHERE converted IS NOT NULL AND d<=converted)"


def attributed(t: Tables) -> DataFrame:
    """One lead for each conversion of a client: by source priority, then the earliest."""
    order = first_of((F.col("channel") == "BUILDING", 1), (F.col("channel") == "AUTOMOBILE", 2), otherwise=3)
    return latest(lead_conversions(t).where("converted is not null and d <= converted"), ["client", "converted"], order, F.col("d"), F.col("lead"))


@query("dp20_lead_attribution", f"WITH {ATTR} SELECT lead, client, channel, converted FROM best WHERE r=1")
def dp20(t: Tables) -> DataFrame:
    return attributed(t).select("lead", "client", "channel", "converted")


@query("dp21_attribution_rates", f"WITH {ATTR}, a AS (SELECT channel, CAST(date_trunc('month', d) AS DATE) AS cohort, count(*) AS leads FROM leads GROUP BY 1,2), b AS (SELECT channel, CAST(date_trunc('month', d) AS DATE) AS cohort, count(*) AS conversions FROM best WHERE r=1 GROUP BY 1,2) SELECT channel, cohort, leads, coalesce(conversions,0) AS conversions, round(coalesce(conversions,0)/CAST(leads AS DOUBLE),6) AS rate FROM a LEFT JOIN b USING (channel, cohort)")
def dp21(t: Tables) -> DataFrame:
    a = leads(t).groupBy("channel", month_of(F.col("d")).alias("cohort")).agg(F.count("*").alias("leads"))
    b = attributed(t).groupBy("channel", month_of(F.col("d")).alias("cohort")).agg(F.count("*").alias("conversions"))
    n = F.coalesce("conversions", F.lit(0))
    return a.join(b, ["channel", "cohort"], "left").select("channel", "cohort", "leads", n.alias("conversions"), F.round(ratio(n, F.col("leads")), 6).alias("rate"))


@query("dp22_monthly_sales_absorption", f"WITH {PM}, c AS (SELECT project, month, sales, CAST(sum(sales) OVER (PARTITION BY project) AS BIGINT) AS life, CAST(sum(sales) OVER (PARTITION BY project ORDER BY month) AS BIGINT) AS done FROM pm) SELECT project, month, life-done+sales AS opening, sales, life-done AS closing, round(sales/nullif(CAST(life-done+sales AS DOUBLE),0),6) AS absorption, last_day(month)>DATE '2001-11-15' AS is_partial FROM c")
def dp22(t: Tables) -> DataFrame:
    life, done = F.sum("sales").over(Window.partitionBy("project")), F.sum("sales").over(running(["project"], "month"))
    c = project_months(t).withColumns({"closing": life - done, "opening": life - done + F.col("sales")})
    return c.select("project", "month", "opening", "sales", "closing", F.round(ratio(F.col("sales"), F.col("opening")), 6).alias("absorption"), (F.last_day("month") > "2001-11-15").alias("is_partial"))


@query("udf02_table_functions", f"WITH {PM}, c AS (SELECT project, month, sales, CAST(sum(sales) OVER (PARTITION BY project) AS BIGINT) AS life, CAST(sum(sales) OVER (PARTITION BY project ORDER BY month) AS BIGINT) AS done FROM pm WHERE month<=DATE '1999-01-01') SELECT project, month, life-done AS closing FROM c")
def udf02(t: Tables) -> DataFrame:
    """A table function of a date is a function of a DataFrame and the date."""
    return sales_absorption(project_months(t), "1999-01-01")


def sales_absorption(months: DataFrame, as_of: str) -> DataFrame:
    known = months.where(F.col("month") <= F.lit(as_of).cast("date"))
    return known.select("project", "month", (F.sum("sales").over(Window.partitionBy("project")) - F.sum("sales").over(running(["project"], "month"))).alias("closing"))


@query("dp23_unit_month_panel", f"WITH {LC}, u AS (SELECT lead, project, CAST(unnest(generate_series(date_trunc('month', d), date_trunc('month', least(coalesce(converted, d+90), d+90)), INTERVAL 1 MONTH)) AS DATE) AS month, d, converted FROM lc) SELECT project, month, count(*) AS units, count(*) FILTER (CAST(date_trunc('month', converted) AS DATE)=month) AS sales, CAST(sum(least(last_day(month), coalesce(converted, last_day(month)))-greatest(month, d)+1) AS BIGINT) AS exposure FROM u GROUP BY 1,2")
def dp23(t: Tables) -> DataFrame:
    end = F.least(F.coalesce("converted", F.date_add("d", 90)), F.date_add("d", 90))
    u = lead_conversions(t).withColumn("lo", month_of(F.col("d"))).withColumn("hi", month_of(end)).where("lo <= hi").withColumn("month", F.explode(F.expr("sequence(lo, hi, interval 1 month)")))
    days = F.datediff(F.least(F.last_day("month"), F.coalesce("converted", F.last_day("month"))), F.greatest("month", "d")) + 1
    return u.groupBy("project", "month").agg(F.count("*").alias("units"), F.count_if(month_of(F.col("converted")) == F.col("month")).alias("sales"), F.sum(days).alias("exposure"))


@query("dp24_offer_history", f"WITH {PE}, s AS (SELECT unit, d, arg_max(kind, (ts, event_id)) AS stage FROM pe GROUP BY 1,2), l AS (SELECT *, lag(stage) OVER (PARTITION BY unit ORDER BY d) AS prior FROM s) SELECT unit, d AS valid_from, stage, prior FROM l WHERE prior IS DISTINCT FROM stage")
def dp24(t: Tables) -> DataFrame:
    s = process_events(t).groupBy("unit", "d").agg(F.max_by("kind", F.struct("ts", "event_id")).alias("stage"))
    prior = F.lag("stage").over(Window.partitionBy("unit").orderBy("d"))
    return s.withColumn("prior", prior).where(~F.col("prior").eqNullSafe(F.col("stage"))).select("unit", F.col("d").alias("valid_from"), "stage", "prior")


@query("dp25_weekly_demand_panel", f"WITH {LEADS}, {PE}, w AS (SELECT CAST(date_trunc('week', d) AS DATE) AS week, 'LEAD' AS source FROM leads UNION ALL SELECT CAST(date_trunc('week', d) AS DATE), 'EVENTO' FROM pe) SELECT week, count(*) FILTER (source='LEAD') AS leads, CASE WHEN week>=DATE '2024-01-01' THEN count(*) FILTER (source='EVENTO') END AS events FROM w GROUP BY 1")
def dp25(t: Tables) -> DataFrame:
    a = leads(t).select(F.trunc("d", "week").alias("week"), F.lit("LEAD").alias("source"))
    b = process_events(t).select(F.trunc("d", "week").alias("week"), F.lit("EVENTO").alias("source"))
    n = lambda s: F.count(F.when(F.col("source") == s, 1))
    return a.unionByName(b).groupBy("week").agg(n("LEAD").alias("leads"), F.when(F.col("week") >= "2024-01-01", n("EVENTO")).alias("events"))


@query("dp26_unit_prediction_dataset", f"WITH {LC} SELECT lead, round(amount/avg(amount) OVER (PARTITION BY project),6) AS relative_amount, CASE WHEN d+90<=DATE '2001-01-01' THEN CAST(coalesce(days BETWEEN 0 AND 90, FALSE) AS INTEGER) END AS label, d+90<=DATE '2001-01-01' AS eligible FROM lc")
def dp26(t: Tables) -> DataFrame:
    ripe = F.date_add("d", 90) <= "2001-01-01"
    return lead_conversions(t).select("lead", F.round(F.col("amount") / F.avg("amount").over(Window.partitionBy("project")), 6).alias("relative_amount"), F.when(ripe, F.coalesce(F.col("days").between(0, 90), F.lit(False)).cast("int")).alias("label"), ripe.alias("eligible"))


@query("dp27_prediction_evaluation", f"WITH {LC}, s AS (SELECT channel, (lead%100)/100.0::DOUBLE AS p, CAST(coalesce(days BETWEEN 0 AND 60, FALSE) AS INTEGER) AS y FROM lc WHERE d+60<=DATE '2001-01-01') SELECT channel, count(*) AS n, round(avg((p-y)*(p-y)),6) AS brier, round(avg(y),6) AS base_rate FROM s GROUP BY 1")
def dp27(t: Tables) -> DataFrame:
    y = F.coalesce(F.col("days").between(0, 60), F.lit(False)).cast("int")
    s = lead_conversions(t).where(F.date_add("d", 60) <= "2001-01-01").select("channel", ((F.col("lead") % 100) / 100.0).alias("p"), y.alias("y"))
    return s.groupBy("channel").agg(F.count("*").alias("n"), F.round(F.avg((F.col("p") - F.col("y")) ** 2), 6).alias("brier"), F.round(F.avg("y"), 6).alias("base_rate"))


@query("dp28_seasonality_panel", f"WITH {PM} SELECT month(month) AS month_of_year, CAST(sum(sales) AS BIGINT) AS sales, round(sum(sales)/CAST(sum(sum(sales)) OVER () AS DOUBLE),6) AS share FROM pm GROUP BY 1")
def dp28(t: Tables) -> DataFrame:
    g = project_months(t).groupBy(F.month("month").cast("long").alias("month_of_year")).agg(F.sum("sales").alias("sales"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("sales").alias("all")))).select("month_of_year", "sales", F.round(ratio(F.col("sales"), F.col("all")), 6).alias("share"))


@query("dp29_marketing_audiences", f"WITH {LC}, p AS (SELECT client, arg_min(project, (d, lead)) AS origin, max(d) AS last_seen, bool_or(converted IS NOT NULL) AS bought FROM lc GROUP BY 1) SELECT client, origin, CASE WHEN client%9=0 THEN 'SUPRIMIDO' WHEN bought THEN 'CLIENTE' WHEN last_seen<DATE '2000-01-01' THEN 'NEGATIVO' ELSE 'PROSPECTO' END AS audience, client%4<>0 AND client%9<>0 AS can_contact FROM p")
def dp29(t: Tables) -> DataFrame:
    p = lead_conversions(t).groupBy("client").agg(F.min_by("project", F.struct("d", "lead")).alias("origin"), F.max("d").alias("last_seen"), F.bool_or(F.col("converted").isNotNull()).alias("bought"))
    k = F.col("client")
    return p.select("client", "origin", first_of((k % 9 == 0, "SUPRIMIDO"), (F.col("bought"), "CLIENTE"), (F.col("last_seen") < "2000-01-01", "NEGATIVO"), otherwise="PROSPECTO").alias("audience"), ((k % 4 != 0) & (k % 9 != 0)).alias("can_contact"))


@query("dp30_person_project_lineage", "SELECT o_custkey, s_nationkey AS project, CAST(min(o_orderdate) AS DATE) AS first_seen, CAST(max(o_orderdate) AS DATE) AS last_seen, count(*) AS n FROM orders JOIN lineitem ON l_orderkey=o_orderkey JOIN supplier ON s_suppkey=l_suppkey GROUP BY 1,2")
def dp30(t: Tables) -> DataFrame:
    j = t.lineitem.select("l_orderkey", "l_suppkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey")).join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_custkey", F.col("s_nationkey").alias("project")).agg(F.to_date(F.min("o_orderdate")).alias("first_seen"), F.to_date(F.max("o_orderdate")).alias("last_seen"), F.count("*").alias("n"))


@query("dp31_event_month_funnel", f"WITH {LC}, a AS (SELECT project, CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS leads, count(DISTINCT client) AS people FROM lc GROUP BY 1,2), b AS (SELECT project, CAST(date_trunc('month', converted) AS DATE) AS month, count(*) AS sales FROM lc WHERE converted IS NOT NULL GROUP BY 1,2) SELECT coalesce(a.project,b.project) AS project, coalesce(a.month,b.month) AS month, coalesce(leads,0) AS leads, coalesce(people,0) AS people, coalesce(sales,0) AS sales FROM a FULL JOIN b ON a.project=b.project AND a.month=b.month")
def dp31(t: Tables) -> DataFrame:
    lc = lead_conversions(t)
    a = lc.groupBy("project", month_of(F.col("d")).alias("month")).agg(F.count("*").alias("leads"), F.count_distinct("client").alias("people"))
    b = lc.where("converted is not null").groupBy("project", month_of(F.col("converted")).alias("month")).agg(F.count("*").alias("sales"))
    return a.join(b, ["project", "month"], "full_outer").select("project", "month", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("leads", "people", "sales")))


def cohort_sql(h: int) -> str:
    ripe = f"d+{h}<=DATE '2001-06-01'"
    hit = f"count(*) FILTER ({ripe} AND converted-d BETWEEN 0 AND {h})"
    return f"SELECT project, CAST(date_trunc('quarter', d) AS DATE) AS cohort, {h} AS h, count(*) FILTER ({ripe}) AS matured, {hit} AS converted, count(*) FILTER (converted-d<0) AS anomalies, round({hit}/nullif(CAST(count(*) FILTER ({ripe}) AS DOUBLE),0),6) AS rate FROM (SELECT c_nationkey AS project, CAST(o_orderdate AS DATE) AS d, converted FROM orders JOIN customer ON o_custkey=c_custkey LEFT JOIN conv ON lead=o_orderkey) GROUP BY 1,2"


@query("dp32_cohort_funnel", f"WITH {CONV} " + " UNION ALL ".join(map(cohort_sql, (30, 60, 90))))
def dp32(t: Tables) -> DataFrame:
    rows = lead_conversions(t).withColumn("h", F.explode(F.array(*map(F.lit, (30, 60, 90)))))
    ripe = F.date_add("d", F.col("h")) <= "2001-06-01"
    hit = ripe & (F.col("days") >= 0) & (F.col("days") <= F.col("h"))
    g = rows.groupBy("project", F.trunc("d", "quarter").alias("cohort"), "h").agg(F.count_if(ripe).alias("matured"), F.count_if(hit).alias("converted"), F.count_if(F.col("days") < 0).alias("anomalies"))
    return g.withColumn("rate", F.round(ratio(F.col("converted"), F.col("matured")), 6))


@query("dp33_channel_project_lab", f"WITH {LC} SELECT project, count(*) FILTER (channel='BUILDING') AS building, count(*) FILTER (channel='AUTOMOBILE') AS automobile, count(*) FILTER (channel='MACHINERY') AS machinery FROM lc GROUP BY 1")
def dp33(t: Tables) -> DataFrame:
    g = leads(t).groupBy("project").pivot("channel", ["BUILDING", "AUTOMOBILE", "MACHINERY"]).count()
    return g.select("project", *(F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("BUILDING", "AUTOMOBILE", "MACHINERY")))


GROWTH = f"{PM}, g AS (SELECT project, month, sales, round(avg(sales) OVER (PARTITION BY project ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),6) AS base, row_number() OVER (PARTITION BY project ORDER BY month DESC) r FROM pm), st AS (SELECT project, month, sales, base, CASE WHEN base IS NULL THEN 'SIN_BASE' WHEN sales>=1.1*base THEN 'CRECE' WHEN sales<=0.9*base THEN 'CAE' ELSE 'ESTABLE' END AS state FROM g WHERE r=2)"


@query("dp34_growth_state", f"WITH {GROWTH} SELECT *, CASE state WHEN 'CAE' THEN 'REVISAR_PRECIO' WHEN 'CRECE' THEN 'SOSTENER' ELSE 'OBSERVAR' END AS action FROM st")
def dp34(t: Tables) -> DataFrame:
    w = Window.partitionBy("project").orderBy("month")
    g = project_months(t).withColumns({"base": F.round(F.avg("sales").over(w.rowsBetween(-3, -1)), 6), "r": F.row_number().over(Window.partitionBy("project").orderBy(F.desc("month")))}).where("r = 2")
    state = first_of((F.col("base").isNull(), "SIN_BASE"), (F.col("sales") >= 1.1 * F.col("base"), "CRECE"), (F.col("sales") <= 0.9 * F.col("base"), "CAE"), otherwise="ESTABLE")
    return g.select("project", "month", "sales", "base", state.alias("state")).withColumn("action", first_of((F.col("state") == "CAE", "REVISAR_PRECIO"), (F.col("state") == "CRECE", "SOSTENER"), otherwise="OBSERVAR"))


@query("sc21_attention_score", f"WITH {GROWTH} SELECT project, (CASE state WHEN 'CAE' THEN 50 WHEN 'SIN_BASE' THEN 20 ELSE 0 END)+(CASE WHEN sales<100 THEN 30 ELSE 0 END)+(CASE WHEN base>200 THEN 20 ELSE 0 END) AS attention FROM st")
def sc21(t: Tables) -> DataFrame:
    s = F.col("state")
    return dp34(t).select("project", (F.when(s == "CAE", 50).when(s == "SIN_BASE", 20).otherwise(0) + F.when(F.col("sales") < 100, 30).otherwise(0) + F.when(F.col("base") > 200, 20).otherwise(0)).alias("attention"))


@query("sc22_portfolio_archetype", f"WITH {GROWTH}, c AS (SELECT project, state, cume_dist() OVER (ORDER BY sales) AS pct FROM st) SELECT project, CASE WHEN pct>=0.75 AND state<>'CAE' THEN 'MOTOR' WHEN pct>=0.75 THEN 'MOTOR_EN_RIESGO' WHEN state='CRECE' THEN 'EMERGENTE' ELSE 'SEGUIMIENTO' END AS archetype, round(100*pct,4) AS priority FROM c")
def sc22(t: Tables) -> DataFrame:
    """The rank is over one row a project."""
    pct = F.cume_dist().over(Window.orderBy("sales"))
    c = dp34(t).select("project", "state", pct.alias("pct"))
    return c.select("project", first_of(((F.col("pct") >= 0.75) & (F.col("state") != "CAE"), "MOTOR"), (F.col("pct") >= 0.75, "MOTOR_EN_RIESGO"), (F.col("state") == "CRECE", "EMERGENTE"), otherwise="SEGUIMIENTO").alias("archetype"), F.round(100 * F.col("pct"), 4).alias("priority"))


RISK = f"{LC}, u AS (SELECT lead, project, client, d, days, CASE WHEN status='P' THEN 'BLOCKED' WHEN converted IS NOT NULL AND converted<=DATE '2000-01-01' THEN 'CLOSED' WHEN d>DATE '2000-01-01' THEN 'FUTURE' ELSE 'ACTIVE' END AS standing, DATE '2000-01-01'-d AS age FROM lc)"


def universe(t: Tables) -> DataFrame:
    cut = F.lit("2000-01-01").cast("date")
    standing = first_of((F.col("status") == "P", "BLOCKED"), (F.col("converted").isNotNull() & (F.col("converted") <= cut), "CLOSED"), (F.col("d") > cut, "FUTURE"), otherwise="ACTIVE")
    return lead_conversions(t).withColumns({"standing": standing, "age": F.datediff(cut, "d")})


@query("dp35_fall_risk_universe", f"WITH {RISK} SELECT standing, count(*) AS n, count(*) FILTER (age>60) AS aged, round(avg(age),4) AS mean_age FROM u GROUP BY 1")
def dp35(t: Tables) -> DataFrame:
    return universe(t).groupBy("standing").agg(F.count("*").alias("n"), F.count_if(F.col("age") > 60).alias("aged"), F.round(F.avg("age"), 4).alias("mean_age"))


@query("dp36_fall_outcomes", f"WITH {RISK} SELECT lead, CASE WHEN days IS NULL THEN 'OPEN' WHEN days<0 THEN 'INVALID' WHEN days<=30 THEN 'FAST' WHEN days<=90 THEN 'SLOW' ELSE 'LATE' END AS outcome FROM u")
def dp36(t: Tables) -> DataFrame:
    x = F.col("days")
    return universe(t).select("lead", first_of((x.isNull(), "OPEN"), (x < 0, "INVALID"), (x <= 30, "FAST"), (x <= 90, "SLOW"), otherwise="LATE").alias("outcome"))


LAND = f"{RISK}, lm AS (SELECT lead, client, l, d+l AS cut, days, CASE WHEN days IS NOT NULL AND days<l THEN 0 ELSE 1 END AS open_then FROM u CROSS JOIN (VALUES (0),(15),(30),(60),(90)) x(l)), ts AS (SELECT lead, l, CASE WHEN days BETWEEN l AND l+30 THEN 1 WHEN cut+30>DATE '2001-10-01' THEN NULL ELSE 0 END AS label FROM lm WHERE open_then=1)"


def landmarks(t: Tables) -> DataFrame:
    rows = universe(t).withColumn("l", F.explode(F.array(*map(F.lit, (0, 15, 30, 60, 90))))).where("days is null or days >= l")
    hit = (F.col("days") >= F.col("l")) & (F.col("days") <= F.col("l") + 30)
    label = F.when(hit, 1).when(F.date_add("d", F.col("l") + 30) > "2001-10-01", F.lit(None).cast("int")).otherwise(0)
    return rows.select("lead", "l", label.alias("label"))


@query("dp37_landmark_training_set", f"WITH {LAND} SELECT lead, l, label, round(1.0::DOUBLE/count(*) OVER (PARTITION BY lead),6) AS weight FROM ts")
def dp37(t: Tables) -> DataFrame:
    return landmarks(t).withColumn("weight", F.round(1.0 / F.count("*").over(Window.partitionBy("lead")), 6))


@query("dp38_horizon_training_set", f"WITH {LAND} SELECT l, count(*) AS n, count(*) FILTER (label IS NULL) AS censored, CAST(sum(label) AS BIGINT) AS events, round(avg(label),6) AS rate FROM ts GROUP BY 1")
def dp38(t: Tables) -> DataFrame:
    return landmarks(t).groupBy("l").agg(F.count("*").alias("n"), F.count_if(F.col("label").isNull()).alias("censored"), F.sum("label").alias("events"), F.round(F.avg("label"), 6).alias("rate"))


@query("dp39_training_readiness", f"WITH {LAND} SELECT count(*) AS n, count(DISTINCT lead) AS leads, count(label) AS labelled, CASE WHEN count(label)>=1000 AND sum(label)>=100 THEN 'READY' ELSE 'NOT_READY' END AS status, label IS NULL AS censored FROM ts GROUP BY 5")
def dp39(t: Tables) -> DataFrame:
    g = landmarks(t).groupBy(F.col("label").isNull().alias("censored")).agg(F.count("*").alias("n"), F.count_distinct("lead").alias("leads"), F.count("label").alias("labelled"), F.sum("label").alias("s"))
    return g.select("n", "leads", "labelled", F.when((F.col("labelled") >= 1000) & (F.col("s") >= 100), "READY").otherwise("NOT_READY").alias("status"), "censored")


@query("dp41_universe_snapshot", f"WITH {RISK} SELECT project, standing, count(*) AS n, DATE '2000-01-01' AS snapshot FROM u GROUP BY 1,2")
def dp41(t: Tables) -> DataFrame:
    return universe(t).groupBy("project", "standing").agg(F.count("*").alias("n")).withColumn("snapshot", F.lit("2000-01-01").cast("date"))


@query("dp42_lead_evidence", f"WITH {LC} SELECT a.lead, (SELECT count(*) FROM lc b WHERE b.client=a.client AND b.d<a.d AND b.d>=a.d-180) AS client_180, (SELECT count(*) FROM lc b WHERE b.client=a.client AND b.days BETWEEN 0 AND 60 AND b.d<=a.d-60 AND b.d>=a.d-240) AS client_hits FROM lc a")
def dp42(t: Tables) -> DataFrame:
    """Counts of a client's past without looking ahead: one sort by day, exclusive upper bounds, labels shifted by their maturity."""
    day = F.unix_date("d")
    w = Window.partitionBy("client").orderBy(day)
    hit = F.when(F.col("days").between(0, 60), 1)
    return lead_conversions(t).select("lead", F.count("*").over(w.rangeBetween(-180, -1)).alias("client_180"), F.count(hit).over(w.rangeBetween(-240, -60)).alias("client_hits"))


BANDS = f"{LC}, sb AS (SELECT lead, days, d, row_number() OVER (PARTITION BY CAST(date_trunc('month', d) AS DATE) ORDER BY (lead*7919)%1000 DESC, lead) AS rk, count(*) OVER (PARTITION BY CAST(date_trunc('month', d) AS DATE)) AS n FROM lc), bd AS (SELECT lead, days, CASE WHEN rk<=0.2*n THEN 'A' WHEN rk<=0.5*n THEN 'B' WHEN rk<=0.8*n THEN 'C' ELSE 'D' END AS band FROM sb)"


@query("dp43_scoring_batch", f"WITH {BANDS} SELECT band, count(*) AS n, round(avg((coalesce(days,999)<=60)::INT),6) AS rate FROM bd GROUP BY 1")
def dp43(t: Tables) -> DataFrame:
    month = month_of(F.col("d"))
    share = F.row_number().over(Window.partitionBy(month).orderBy((F.col("lead") * 7919 % 1000).desc(), "lead")) / F.count("*").over(Window.partitionBy(month))
    s = lead_conversions(t).withColumn("share", share)
    band = first_of((F.col("share") <= 0.2, "A"), (F.col("share") <= 0.5, "B"), (F.col("share") <= 0.8, "C"), otherwise="D")
    return s.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg((F.coalesce("days", F.lit(999)) <= 60).cast("int")), 6).alias("rate"))


COHORT = f"{LC}, ch AS (SELECT lead, client, project, amount, days, row_number() OVER (PARTITION BY project ORDER BY sha256('run1|'||lead), lead) AS place FROM lc WHERE client NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus='P')), arm AS (SELECT *, CASE WHEN place<=50 THEN 'TREATED' WHEN place<=100 THEN 'CONTROL' END AS arm FROM ch WHERE place<=100)"


def cohort(t: Tables) -> DataFrame:
    """Exactly 50 treated and 50 control leads a project, by hash; clients exposed before stay out."""
    exposed = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("client"))
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.sha2(F.concat(F.lit("run1|"), F.col("lead").cast("string")), 256), "lead"))
    return lead_conversions(t).join(exposed, "client", "left_anti").withColumn("place", place).where("place <= 100").withColumn("arm", F.when(F.col("place") <= 50, "TREATED").otherwise("CONTROL"))


@query("dp44_policy_cohort", f"WITH {COHORT} SELECT lead, project, arm FROM arm")
def dp44(t: Tables) -> DataFrame:
    return cohort(t).select("lead", "project", "arm")


@query("dp45_policy_journey", f"WITH {COHORT} SELECT arm, project, count(*) AS assigned, count(*) FILTER (days IS NOT NULL) AS reached, round(quantile_cont(days,0.5),4) AS median_days, round(count(*)/CAST(sum(count(*)) OVER (PARTITION BY arm) AS DOUBLE),6) AS share FROM arm GROUP BY 1,2")
def dp45(t: Tables) -> DataFrame:
    g = cohort(t).groupBy("arm", "project").agg(F.count("*").alias("assigned"), F.count("days").alias("reached"), F.round(F.percentile("days", 0.5), 4).alias("median_days"))
    return g.withColumn("share", F.round(ratio(F.col("assigned"), F.sum("assigned").over(Window.partitionBy("arm"))), 6))


@query("dp46_experiment_itt", f"WITH {COHORT}, g AS (SELECT project, avg((coalesce(days,999)<=60)::INT) FILTER (arm='TREATED') AS pt, avg((coalesce(days,999)<=60)::INT) FILTER (arm='CONTROL') AS pc FROM arm GROUP BY 1) SELECT project, round(pt,6) AS treated_rate, round(pc,6) AS control_rate, round(pt-pc,6) AS itt, round(pt/nullif(pc,0)-1,6) AS lift FROM g")
def dp46(t: Tables) -> DataFrame:
    y = (F.coalesce("days", F.lit(999)) <= 60).cast("int")
    g = cohort(t).groupBy("project").agg(F.avg(F.when(F.col("arm") == "TREATED", y)).alias("pt"), F.avg(F.when(F.col("arm") == "CONTROL", y)).alias("pc"))
    return g.select("project", F.round("pt", 6).alias("treated_rate"), F.round("pc", 6).alias("control_rate"), F.round(F.col("pt") - F.col("pc"), 6).alias("itt"), F.round(ratio(F.col("pt"), F.col("pc")) - 1, 6).alias("lift"))


DECISION = f"{ACTIONS}, fa AS (SELECT rec.lead, rec.client, rec.d, min(acted) AS acted FROM rec LEFT JOIN act ON act.client=rec.client AND acted>=rec.d GROUP BY 1,2,3)"


@query("dp47_decision_outcome_status", f"WITH {DECISION} SELECT CASE WHEN acted IS NULL THEN 'NOT_EXECUTED' WHEN acted-d<=30 THEN 'ON_TIME' ELSE 'LATE' END AS status, count(*) AS n, round(avg(acted-d),4) AS mean_days FROM fa GROUP BY 1")
def dp47(t: Tables) -> DataFrame:
    j = jn18(t).join(leads(t).select("lead", "d"), "lead").withColumn("gap", F.datediff("acted", "d"))
    return j.groupBy(first_of((F.col("acted").isNull(), "NOT_EXECUTED"), (F.col("gap") <= 30, "ON_TIME"), otherwise="LATE").alias("status")).agg(F.count("*").alias("n"), F.round(F.avg("gap"), 4).alias("mean_days"))


@query("dp48_economic_reconciliation", f"WITH {LEADS}, e AS (SELECT client, sum(amount) FILTER (status='O') AS expected, sum(amount) FILTER (status='F') AS approved FROM leads GROUP BY 1) SELECT client, round(coalesce(approved,expected),2) AS value, CASE WHEN approved IS NOT NULL THEN 'APPROVED' WHEN expected IS NOT NULL THEN 'EXPECTED' ELSE 'NONE' END AS basis FROM e")
def dp48(t: Tables) -> DataFrame:
    s = lambda k: F.sum(F.when(F.col("status") == k, F.col("amount")))
    e = leads(t).groupBy("client").agg(s("O").alias("expected"), s("F").alias("approved"))
    return e.select("client", F.round(F.coalesce("approved", "expected"), 2).alias("value"), first_of((F.col("approved").isNotNull(), "APPROVED"), (F.col("expected").isNotNull(), "EXPECTED"), otherwise="NONE").alias("basis"))


@query("dp49_contract_sla", f"WITH {DECISION} SELECT lead, d+30 AS due, CASE WHEN acted IS NULL AND d+30<DATE '2001-06-01' THEN 'BREACHED' WHEN acted IS NULL THEN 'PENDING' WHEN acted<=d+30 THEN 'MET' ELSE 'LATE' END AS sla FROM fa")
def dp49(t: Tables) -> DataFrame:
    due = F.date_add("d", 30)
    j = jn18(t).join(leads(t).select("lead", "d"), "lead")
    a = F.col("acted")
    return j.select("lead", due.alias("due"), first_of((a.isNull() & (due < "2001-06-01"), "BREACHED"), (a.isNull(), "PENDING"), (a <= due, "MET"), otherwise="LATE").alias("sla"))


@query("dp50_decision_scorecard", f"WITH {DECISION} SELECT d AS day, count(*) AS decisions, count(acted) AS executed, bool_or(acted IS NULL) AS any_open FROM fa GROUP BY 1")
def dp50(t: Tables) -> DataFrame:
    return jn18(t).join(leads(t).select("lead", "d"), "lead").groupBy(F.col("d").alias("day")).agg(F.count("*").alias("decisions"), F.count("acted").alias("executed"), F.bool_or(F.col("acted").isNull()).alias("any_open"))


@query("dp58_feedback_loop", f"WITH {DECISION} SELECT fa.lead, acted, min(conv.converted) AS outcome FROM fa LEFT JOIN leads b ON b.client=fa.client AND b.d>=fa.d LEFT JOIN conv ON conv.lead=b.lead AND conv.converted>=b.d GROUP BY 1,2".replace(LEADS, f"{LEADS}, {CONV}"))
def dp58(t: Tables) -> DataFrame:
    """The first outcome later than each recommendation, from the end of the client's history backwards."""
    rest = Window.partitionBy("client").orderBy(F.unix_date("d")).rangeBetween(0, Window.unboundedFollowing)
    later = lead_conversions(t).withColumn("ok", F.when(F.col("converted") >= F.col("d"), F.col("converted")))
    outcomes = later.withColumn("outcome", F.min("ok").over(rest)).select("lead", "outcome")
    return jn18(t).select("lead", "acted").join(outcomes, "lead")


@query("dp51_asset_health", "WITH h AS (SELECT event_type AS asset, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY 1) SELECT asset, n, CASE WHEN last_seen>=TIMESTAMP '2024-01-30 18:00:00' THEN 'OK' ELSE 'STALE' END AS health FROM h")
def dp51(t: Tables) -> DataFrame:
    h = t.events.groupBy(F.col("event_type").alias("asset")).agg(F.max("ts").alias("last"), F.count("*").alias("n"))
    return h.select("asset", "n", F.when(F.col("last") >= F.lit("2024-01-30 18:00:00").cast("timestamp_ntz"), "OK").otherwise("STALE").alias("health"))


@query("dp52_project_readiness", f"WITH {PM}, g AS (SELECT project, count(*) AS months, max(month) AS hi, bool_and(falls<=sales) AS balanced FROM pm GROUP BY 1) SELECT project, concat_ws(',', CASE WHEN hi<DATE '2001-10-01' THEN 'STALE' END, CASE WHEN NOT balanced THEN 'UNBALANCED' END, CASE WHEN months<70 THEN 'SHORT' END) AS why, hi>=DATE '2001-10-01' AND balanced AND months>=70 AS ready FROM g")
def dp52(t: Tables) -> DataFrame:
    g = project_months(t).groupBy("project").agg(F.count("*").alias("months"), F.max("month").alias("hi"), F.every(F.col("falls") <= F.col("sales")).alias("balanced"))
    why = reasons((F.col("hi") < "2001-10-01", "STALE"), (~F.col("balanced"), "UNBALANCED"), (F.col("months") < 70, "SHORT"))
    return g.select("project", F.array_join(why, ",").alias("why"), (F.size(why) == 0).alias("ready"))


@query("dp53_project_context", "SELECT n_nationkey AS project, n_name, count(c_custkey) AS clients, max(c_acctbal) AS top_balance FROM nation LEFT JOIN customer ON c_nationkey=n_nationkey GROUP BY 1,2")
def dp53(t: Tables) -> DataFrame:
    g = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("clients"), F.max("c_acctbal").alias("top_balance"))
    return t.nation.join(g, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("n_nationkey").alias("project"), "n_name", F.coalesce("clients", F.lit(0)).alias("clients"), "top_balance")


@query("dp54_unit_bi_table", "WITH u AS (SELECT p_brand, count(DISTINCT p_type) AS kinds FROM part GROUP BY 1) SELECT p_partkey, p.p_brand, kinds=1 AS unique_typology, CASE WHEN p_size<10 THEN 1 WHEN p_size<30 THEN 2 ELSE 3 END AS sort_order FROM part p JOIN u ON u.p_brand=p.p_brand")
def dp54(t: Tables) -> DataFrame:
    u = t.part.groupBy("p_brand").agg(F.count_distinct("p_type").alias("kinds"))
    return t.part.join(u, "p_brand").select("p_partkey", "p_brand", (F.col("kinds") == 1).alias("unique_typology"), first_of((F.col("p_size") < 10, 1), (F.col("p_size") < 30, 2), otherwise=3).alias("sort_order"))


@query("dp55_conversation_metrics", "SELECT role, count(*) AS messages, count(DISTINCT conv_id) AS conversations, round(avg(length(text)),4) AS mean_chars, count(*) FILTER (turn=0) AS openings, count(*) FILTER (contains(text,'?')) AS questions FROM conversations GROUP BY 1")
def dp55(t: Tables) -> DataFrame:
    return t.conversations.groupBy("role").agg(F.count("*").alias("messages"), F.count_distinct("conv_id").alias("conversations"), F.round(F.avg(F.length("text")), 4).alias("mean_chars"), F.count_if(F.col("turn") == 0).alias("openings"), F.count_if(F.col("text").contains("?")).alias("questions"))


@query("dp56_project_scope", "SELECT n_nationkey AS project, CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_nationkey=n_nationkey) THEN 'STOCK' WHEN EXISTS (SELECT 1 FROM customer WHERE c_nationkey=n_nationkey) THEN 'LEAD_ONLY' ELSE 'EXCLUDED' END AS scope FROM nation")
def dp56(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), F.lit(True).alias("stock")).distinct()
    b = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), F.lit(True).alias("lead")).distinct()
    return t.nation.join(a, "n_nationkey", "left").join(b, "n_nationkey", "left").select(F.col("n_nationkey").alias("project"), first_of((F.col("stock"), "STOCK"), (F.col("lead"), "LEAD_ONLY"), otherwise="EXCLUDED").alias("scope"))


@query("dp59_weighted_readiness", "WITH g AS (SELECT n_regionkey, sum(c_acctbal*(1+c_nationkey))/nullif(sum(1+c_nationkey),0) AS score FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) SELECT n_regionkey, round(score,4) AS score, CASE WHEN score>=5000 THEN 'GREEN' WHEN score>=4000 THEN 'AMBER' ELSE 'RED' END AS colour FROM g")
def dp59(t: Tables) -> DataFrame:
    w = 1 + F.col("c_nationkey")
    g = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(ratio(F.sum(F.col("c_acctbal") * w), F.sum(w)).alias("s"))
    return g.select("n_regionkey", F.round("s", 4).alias("score"), first_of((F.col("s") >= 5000, "GREEN"), (F.col("s") >= 4000, "AMBER"), otherwise="RED").alias("colour"))


@query("dp60_packed_product_views", "SELECT o_custkey, o_orderkey AS id, o_orderstatus AS kind FROM orders")
def dp60(t: Tables) -> DataFrame:
    """Packs rows into JSON arrays by client and takes them out again."""
    packed = t.orders.groupBy("o_custkey").agg(F.to_json(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("kind")))).alias("items"))
    return packed.select("o_custkey", F.inline(F.from_json("items", "array<struct<id:bigint,kind:string>>")))


@query("dp61_unit_semantic_dim", "SELECT p_type AS code, count(*) AS units, max(p_partkey) AS last_unit FROM part GROUP BY 1")
def dp61(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_type").alias("code")).agg(F.count("*").alias("units"), F.max("p_partkey").alias("last_unit"))
