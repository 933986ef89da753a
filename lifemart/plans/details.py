"""Movements of units by period, price scorecards and actions, migration between projects, and the rhythm of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio
from ..operators.temporal import trailing
from ..registry import Tables, query
from .ledger import ledger
from .mapping import LEDGER
from .marts import dp13
from .streams import timed

MOVES = (("ALTA", "entries"), ("SEPARACION", "reservations"), ("VENTA", "sales"), ("CAIDA", "falls"))
WEEKS = f"""{LEDGER}, w AS (SELECT *, CAST(date_trunc('week', d) AS DATE) AS week FROM ledger), hi AS (SELECT max(week) AS hi FROM w),
 g AS (SELECT unit, project, week, arg_max(after_state, n) AS state, {', '.join(f"count(*) FILTER (kind='{k}' AND applied) AS {name}" for k, name in MOVES)}, count(*) FILTER (NOT applied) AS ignored FROM w GROUP BY 1,2,3),
 s AS (SELECT unit, project, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week FROM (SELECT unit, project, min(week) AS lo FROM w GROUP BY 1,2), hi),
 f AS (SELECT s.unit, s.project, s.week, last_value(state IGNORE NULLS) OVER (PARTITION BY s.unit, s.project ORDER BY s.week) AS closing_state, {', '.join(f'coalesce({name},0) AS {name}' for _, name in MOVES)}, coalesce(ignored,0) AS ignored FROM s LEFT JOIN g ON g.unit=s.unit AND g.project=s.project AND g.week=s.week)"""


@query("dp12_unit_movements", f"WITH RECURSIVE {WEEKS} SELECT unit, project, week, coalesce(lag(closing_state) OVER p, 'NOT_OFFERED') AS opening_state, closing_state, entries, reservations, sales, falls, ignored, CAST(sum(sales) OVER r AS BIGINT) AS sales_6, CAST(sum(falls) OVER r AS BIGINT) AS falls_6, coalesce(lag(closing_state) OVER p, 'NOT_OFFERED')<>closing_state AS moved FROM f WINDOW p AS (PARTITION BY unit, project ORDER BY week), r AS (PARTITION BY unit, project ORDER BY week ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)")
def dp12_units(t: Tables) -> DataFrame:
    """Each unit's weeks from its first event on: the state it opens and closes with, its moves, and those of six weeks."""
    rows = ledger(t).withColumn("week", F.to_date(F.date_trunc("week", "d")))
    keys = ["unit", "project"]
    n = lambda k: F.count_if((F.col("kind") == k) & F.col("applied"))
    g = rows.groupBy(*keys, "week").agg(F.max_by("after_state", "event_order").alias("state"), *(n(k).alias(name) for k, name in MOVES), F.count_if(~F.col("applied")).alias("ignored"))
    last = g.agg(F.max("week").alias("hi"))
    spine = g.groupBy(*keys).agg(F.min("week").alias("lo")).crossJoin(F.broadcast(last)).select(*keys, F.explode(F.expr("sequence(lo, hi, interval 7 days)")).alias("week"))  # one row of last
    w = Window.partitionBy(*keys).orderBy("week")
    filled = spine.join(g, [*keys, "week"], "left").withColumn("closing_state", F.last("state", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    counts = [name for _, name in MOVES] + ["ignored"]
    filled = filled.select(*keys, "week", "closing_state", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))
    opening = F.coalesce(F.lag("closing_state").over(w), F.lit("NOT_OFFERED"))
    six = trailing(keys, "week", 6)
    return filled.select(*keys, "week", opening.alias("opening_state"), "closing_state", *counts, F.sum("sales").over(six).alias("sales_6"), F.sum("falls").over(six).alias("falls_6"), (opening != F.col("closing_state")).alias("moved"))


AS_OF = "2001-06-01"
POSITION = "m AS (SELECT p_type, p_size//10 AS band, quantile_cont(p_retailprice,0.5) AS med FROM part GROUP BY 1,2), ps AS (SELECT p_partkey, p_brand, p_retailprice, p_retailprice/med-1 AS gap, CASE WHEN p_retailprice/med-1>0.05 THEN 'SOBRE' WHEN p_retailprice/med-1<-0.05 THEN 'BAJO' ELSE 'CORREDOR' END AS position FROM part p JOIN m ON m.p_type IS NOT DISTINCT FROM p.p_type AND m.band IS NOT DISTINCT FROM p.p_size//10)"


def positioned(t: Tables) -> DataFrame:
    return dp13(t).join(t.part.select("p_partkey", "p_brand", "p_retailprice"), "p_partkey")


@query("dp13_project_scorecard", f"WITH {POSITION} SELECT p_brand AS project, count(*) AS units, round(avg((position='SOBRE')::INT),6) AS over_share, round(avg((position='BAJO')::INT),6) AS under_share, round(quantile_cont(round(gap,6),0.5),6) AS median_gap, round(sum(round(gap,6)*p_retailprice)/sum(p_retailprice),6) AS weighted_gap, CASE WHEN avg((position='SOBRE')::INT)>0.4 THEN 'CARO' WHEN avg((position='BAJO')::INT)>0.4 THEN 'BARATO' ELSE 'EN_MERCADO' END AS reading FROM ps GROUP BY 1")
def dp13_scorecard(t: Tables) -> DataFrame:
    """Where a project's prices stand in their corridors."""
    share = lambda p: F.avg((F.col("position") == p).cast("int"))
    g = positioned(t).groupBy(F.col("p_brand").alias("project")).agg(F.count("*").alias("units"), share("SOBRE").alias("a"), share("BAJO").alias("b"), F.round(F.percentile("gap", 0.5), 6).alias("median_gap"), F.round(ratio(F.sum(F.col("gap") * F.col("p_retailprice")), F.sum("p_retailprice")), 6).alias("weighted_gap"))
    return g.select("project", "units", F.round("a", 6).alias("over_share"), F.round("b", 6).alias("under_share"), "median_gap", "weighted_gap", first_of((F.col("a") > 0.4, "CARO"), (F.col("b") > 0.4, "BARATO"), otherwise="EN_MERCADO").alias("reading"))


@query("dp13_price_actions", f"WITH {POSITION}, ls AS (SELECT l_partkey, max(CAST(l_shipdate AS DATE)) AS last_sale, count(*) AS sold FROM lineitem WHERE l_shipdate<TIMESTAMP '{AS_OF}' GROUP BY 1), x AS (SELECT ps.*, last_sale, coalesce(sold,0) AS sold, DATE '{AS_OF}'-last_sale AS idle FROM ps LEFT JOIN ls ON l_partkey=p_partkey) SELECT p_partkey, position, sold, last_sale, CASE WHEN position='SOBRE' AND (idle IS NULL OR idle>180) THEN 'BAJAR' WHEN position='BAJO' AND idle<=90 THEN 'SUBIR' WHEN idle IS NULL OR idle>365 THEN 'REVISAR' ELSE 'MANTENER' END AS action, round(CASE WHEN position='SOBRE' AND (idle IS NULL OR idle>180) THEN -least(round(gap,6),0.1) WHEN position='BAJO' AND idle<=90 THEN least(-round(gap,6),0.05) ELSE 0 END,6) AS change FROM x")
def dp13_actions(t: Tables) -> DataFrame:
    """What to do about each price: down, towards its corridor, where it stands above and has not sold for long; up where it stands below and sells."""
    sales = t.lineitem.where(F.col("l_shipdate") < F.lit(AS_OF).cast("timestamp_ntz")).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.to_date(F.max("l_shipdate")).alias("last_sale"), F.count("*").alias("sold"))
    rows = dp13(t).join(sales, "p_partkey", "left").withColumns({"sold": F.coalesce("sold", F.lit(0)), "idle": F.datediff(F.lit(AS_OF).cast("date"), "last_sale")})
    idle, gap = F.col("idle"), F.col("gap")
    down = (F.col("position") == "SOBRE") & (idle.isNull() | (idle > 180))
    up = (F.col("position") == "BAJO") & (idle <= 90)
    action = first_of((down, "BAJAR"), (up, "SUBIR"), (idle.isNull() | (idle > 365), "REVISAR"), otherwise="MANTENER")
    change = F.when(down, -F.least(gap, F.lit(0.1))).when(up, F.least(-gap, F.lit(0.05))).otherwise(0.0)
    return rows.select("p_partkey", "position", "sold", "last_sale", action.alias("action"), F.round(change, 6).alias("change"))


@query("dp33_project_migration", "WITH l AS (SELECT o_custkey AS client, s_nationkey AS project, CAST(o_orderdate AS DATE) AS d FROM lineitem JOIN orders ON o_orderkey=l_orderkey JOIN supplier ON s_suppkey=l_suppkey), c AS (SELECT client, arg_min(project, (d, project)) AS first_project, arg_max(project, (d, project)) AS last_project, min(d) AS first_day, count(DISTINCT project) AS projects FROM l GROUP BY 1) SELECT CAST(date_trunc('quarter', first_day) AS DATE) AS cohort, c_mktsegment AS channel, first_project, last_project, count(*) AS clients, count(*) FILTER (first_project<>last_project) AS moved, round(avg(projects),6) AS mean_projects FROM c JOIN customer ON c_custkey=client GROUP BY 1,2,3,4")
def dp33_migration(t: Tables) -> DataFrame:
    """From which project to which clients move, by the quarter and channel they came with."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey").join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("project")), F.col("s_suppkey") == F.col("l_suppkey")).join(t.orders.select("o_orderkey", F.col("o_custkey").alias("client"), F.to_date("o_orderdate").alias("d")), F.col("o_orderkey") == F.col("l_orderkey"))
    at = F.struct("d", "project")
    c = lines.groupBy("client").agg(F.min(at)["project"].alias("first_project"), F.max(at)["project"].alias("last_project"), F.min("d").alias("first_day"), F.count_distinct("project").alias("projects"))
    c = c.join(t.customer.select(F.col("c_custkey").alias("client"), F.col("c_mktsegment").alias("channel")), "client")
    return c.groupBy(F.to_date(F.date_trunc("quarter", "first_day")).alias("cohort"), "channel", "first_project", "last_project").agg(F.count("*").alias("clients"), F.count_if(F.col("first_project") != F.col("last_project")).alias("moved"), F.round(F.avg("projects"), 6).alias("mean_projects"))


MINUTE = "TIMESTAMP '2024-01-01' + INTERVAL (conv_id*60+turn*7) MINUTE"


@query("dp55_hourly_rhythm", f"WITH m AS (SELECT conv_id, role, turn, {MINUTE} AS said, length(text) AS chars, contains(text, '?') AS asks FROM conversations), g AS (SELECT *, date_diff('minute', lag(said) OVER w, said) AS gap, lag(role) OVER w AS before FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY said, turn)) SELECT CAST(date_trunc('hour', said) AS TIMESTAMP) AS hour, count(*) AS messages, count(DISTINCT conv_id) AS conversations, CAST(sum(chars) AS BIGINT) AS chars, count(*) FILTER (asks) AS questions, count(*) FILTER (gap IS NULL) AS openings, count(*) FILTER (before<>role) AS turns_taken, round(avg(gap),6) AS mean_gap, count(*) FILTER (gap<=15) AS within_15, max(gap) AS longest_gap FROM g GROUP BY 1")
def dp55_rhythm(t: Tables) -> DataFrame:
    """Messages by hour: how many open a conversation, ask, take the turn, and how long after the one before."""
    w = Window.partitionBy("conv_id").orderBy("at", "turn")
    rows = timed(t.conversations).withColumns({"gap": ((F.unix_micros("at") - F.unix_micros(F.lag("at").over(w))) / 60_000_000).cast("long"), "before": F.lag("role").over(w)})
    gap = F.col("gap")
    g = rows.groupBy(F.date_trunc("hour", "at").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("messages"), F.count_distinct("conv_id").alias("conversations"), F.sum(F.length("text")).alias("chars"), F.count_if(F.col("text").contains("?")).alias("questions"), F.count_if(gap.isNull()).alias("openings"),
        F.count_if(F.col("before") != F.col("role")).alias("turns_taken"), F.round(F.avg("gap"), 6).alias("mean_gap"), F.count_if(gap <= 15).alias("within_15"), F.max("gap").alias("longest_gap"),
    )
    return g
