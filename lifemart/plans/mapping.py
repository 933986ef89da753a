"""The driver's tables as tables of the commercial domain, in DataFrames and as the same CTEs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import Tables

KINDS = {"signup": "ALTA", "click": "SEPARACION", "purchase": "VENTA", "error": "CAIDA"}

PE = """pe AS (SELECT event_id, ts, CAST(ts AS DATE) AS d, user_id AS unit, user_id % 10 AS project, value,
 CASE event_type WHEN 'signup' THEN 'ALTA' WHEN 'click' THEN 'SEPARACION' WHEN 'purchase' THEN 'VENTA' WHEN 'error' THEN 'CAIDA' END AS kind
 FROM events WHERE event_type IN ('signup','click','purchase','error'))"""
LEDGER = f"""{PE}, pn AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY ts, event_id) AS n FROM pe),
led AS (
 SELECT unit, project, event_id, d, kind, n, 'NOT_OFFERED' AS before_state,
  CASE WHEN kind='ALTA' THEN 'AVAILABLE' ELSE 'NOT_OFFERED' END AS after_state, kind='ALTA' AS applied FROM pn WHERE n=1
 UNION ALL
 SELECT p.unit, p.project, p.event_id, p.d, p.kind, p.n, l.after_state,
  CASE WHEN p.kind='ALTA' AND l.after_state='NOT_OFFERED' THEN 'AVAILABLE' WHEN p.kind='SEPARACION' AND l.after_state='AVAILABLE' THEN 'SEPARATED'
   WHEN p.kind='VENTA' AND l.after_state='SEPARATED' THEN 'SOLD' WHEN p.kind='CAIDA' AND l.after_state IN ('SEPARATED','SOLD') THEN 'AVAILABLE' ELSE l.after_state END,
  (p.kind='ALTA' AND l.after_state='NOT_OFFERED') OR (p.kind='SEPARACION' AND l.after_state='AVAILABLE') OR (p.kind='VENTA' AND l.after_state='SEPARATED') OR (p.kind='CAIDA' AND l.after_state IN ('SEPARATED','SOLD'))
 FROM led l JOIN pn p ON p.unit=l.unit AND p.n=l.n+1),
ledger AS (SELECT *, CASE WHEN NOT applied THEN 0 WHEN kind IN ('ALTA','CAIDA') THEN 1 WHEN kind='SEPARACION' THEN -1 ELSE 0 END AS delta_stock FROM led)"""
PM = """pm AS MATERIALIZED (SELECT s_nationkey AS project, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales, count(*) AS n_lines,
 CAST(sum(CASE WHEN l_returnflag='R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS falls
 FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1,2)"""
LEADS = """leads AS (SELECT o_orderkey AS lead, o_custkey AS client, CAST(o_orderdate AS DATE) AS d, c_mktsegment AS channel, o_orderpriority AS seller, c_nationkey AS project, o_totalprice AS amount, o_orderstatus AS status
 FROM orders JOIN customer ON o_custkey=c_custkey)"""
CONV = """conv AS (SELECT l_orderkey AS lead, min(CAST(l_shipdate AS DATE)) AS converted FROM lineitem GROUP BY 1)"""


def process_events(t: Tables) -> DataFrame:
    """event_id, ts, d, unit, project, value, kind."""
    kinds = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    return t.events.where(F.col("event_type").isin(*KINDS)).select("event_id", "ts", F.to_date("ts").alias("d"), F.col("user_id").alias("unit"), (F.col("user_id") % 10).alias("project"), "value", kinds[F.col("event_type")].alias("kind"))


def project_months(t: Tables) -> DataFrame:
    """project, month, sales, n_lines, falls: partial sums before the shuffle; suppliers are a small dimension."""
    units = F.col("l_quantity").cast("long")
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("project"), F.trunc("l_shipdate", "month").alias("month"))
        .agg(F.sum(units).alias("sales"), F.count("*").alias("n_lines"), F.sum(F.when(F.col("l_returnflag") == "R", units).otherwise(0)).alias("falls"))
    )


def leads(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("lead"), F.col("o_custkey").alias("client"), F.to_date("o_orderdate").alias("d"), F.col("c_mktsegment").alias("channel"), F.col("o_orderpriority").alias("seller"), F.col("c_nationkey").alias("project"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status")
    )


def conversions(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("lead")).agg(F.min(F.to_date("l_shipdate")).alias("converted"))
