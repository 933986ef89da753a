"""Marketing audiences with their gates, the weekly demand panel, and the daily snapshot of units."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..operators.temporal import latest
from ..registry import Tables, query
from .ledger import ledger
from .mapping import LEADS, LEDGER, PE, leads, process_events
from .people import PEOPLE, people

AS_OF, QUIET = "2001-10-01", 180

MEMBERS = f"""{PEOPLE}, tl AS (SELECT o_custkey AS client, o_orderkey, s_nationkey AS project, CAST(o_orderdate AS DATE) AS asked, CAST(l_shipdate AS DATE) AS moved, CASE WHEN l_linestatus='F' AND l_returnflag<>'R' THEN 3 WHEN l_linestatus='F' THEN 2 ELSE 1 END AS level FROM lineitem JOIN orders ON o_orderkey=l_orderkey JOIN supplier ON s_suppkey=l_suppkey),
 og AS (SELECT client, arg_min(project, (asked, project)) AS origin, min(asked) AS first_lead, max(asked) AS last_lead, count(DISTINCT o_orderkey) AS leads, max(level) AS level, max(moved) FILTER (level>=2) AS last_advance,
  arg_max(project, (moved, project)) FILTER (level=1) AS proforma, arg_max(project, (moved, project)) FILTER (level=3) AS conversion FROM tl GROUP BY 1),
 cs AS (SELECT o_custkey AS client, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderpriority<>'4-NOT SPECIFIED') AS said, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS standing FROM orders GROUP BY 1),
 ct AS (SELECT lead AS client, phone IS NOT NULL OR email IS NOT NULL AS reachable FROM lead),
 mb AS (SELECT client, origin, proforma, conversion, coalesce(conversion, proforma, origin) AS project, CASE WHEN conversion IS NOT NULL THEN 'CONVERSION' WHEN proforma IS NOT NULL THEN 'PROFORMA' ELSE 'ORIGEN' END AS source, coalesce(coalesce(conversion, proforma)<>origin, FALSE) AS changed, level, leads, first_lead, last_lead, last_advance, reachable, coalesce(said<>'5-LOW', FALSE) AS consent, standing='P' AS suppressed,
  level=3 AS converted FROM og JOIN cs USING (client) JOIN ct USING (client)),
 au AS (SELECT *, NOT converted AND coalesce(last_advance>=DATE '{AS_OF}'-{QUIET}, FALSE) AS positive, NOT converted AND level<2 AND last_lead<DATE '{AS_OF}'-{QUIET} AS negative FROM mb),
 sl AS (SELECT *, NOT converted AND reachable AND NOT suppressed AND consent AS deliverable, CASE WHEN converted OR NOT reachable OR suppressed THEN 'EXCLUSION' WHEN positive THEN 'POSITIVA' WHEN negative THEN 'NEGATIVA_SIN_AVANCE' ELSE 'NEUTRAL_RECIENTE' END AS slice FROM au)"""


def members(t: Tables) -> DataFrame:
    """One row a client: projects of its first lead, latest proforma and latest conversion, how far it came, and the gates of contact, consent and suppression.

    A client's latest word on consent holds, and without one there is none; the latest order's standing suppresses. Lines are summed by client before anything else.
    """
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("moved"), first_of(((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R"), 3), (F.col("l_linestatus") == "F", 2), otherwise=1).alias("level"))
    lines = lines.join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("project")), F.col("s_suppkey") == F.col("l_suppkey")).join(t.orders.select("o_orderkey", F.col("o_custkey").alias("client"), F.to_date("o_orderdate").alias("asked")), F.col("o_orderkey") == F.col("l_orderkey"))
    late = lambda level: F.max(F.when(F.col("level") == level, F.struct("moved", "project")))["project"]
    og = lines.groupBy("client").agg(F.min(F.struct("asked", "project"))["project"].alias("origin"), F.min("asked").alias("first_lead"), F.max("asked").alias("last_lead"), F.count_distinct("o_orderkey").alias("leads"), F.max("level").alias("level"), F.max(F.when(F.col("level") >= 2, F.col("moved"))).alias("last_advance"), late(1).alias("proforma"), late(3).alias("conversion"))
    order = F.struct("o_orderdate", "o_orderkey")
    cs = t.orders.groupBy(F.col("o_custkey").alias("client")).agg(F.max_by(F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")), F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", order)).alias("said"), F.max_by("o_orderstatus", order).alias("standing"))
    contact = people(t)[0].select(F.col("lead").alias("client"), (F.col("phone").isNotNull() | F.col("email").isNotNull()).alias("reachable"))
    rows = og.join(cs, "client").join(contact, "client")
    best = F.coalesce("conversion", "proforma")
    rows = rows.select(
        "client", "origin", "proforma", "conversion", F.coalesce(best, "origin").alias("project"), first_of((F.col("conversion").isNotNull(), "CONVERSION"), (F.col("proforma").isNotNull(), "PROFORMA"), otherwise="ORIGEN").alias("source"),
        F.coalesce(best != F.col("origin"), F.lit(False)).alias("changed"), "level", "leads", "first_lead", "last_lead", "last_advance", "reachable", F.coalesce(F.col("said") != "5-LOW", F.lit(False)).alias("consent"), (F.col("standing") == "P").alias("suppressed"), (F.col("level") == 3).alias("converted"),
    )
    since = F.date_sub(F.lit(AS_OF).cast("date"), QUIET)
    free = ~F.col("converted")
    rows = rows.withColumns({"positive": free & F.coalesce(F.col("last_advance") >= since, F.lit(False)), "negative": free & (F.col("level") < 2) & (F.col("last_lead") < since), "deliverable": free & F.col("reachable") & ~F.col("suppressed") & F.col("consent")})
    return rows.withColumn("slice", first_of((F.col("converted") | ~F.col("reachable") | F.col("suppressed"), "EXCLUSION"), (F.col("positive"), "POSITIVA"), (F.col("negative"), "NEGATIVA_SIN_AVANCE"), otherwise="NEUTRAL_RECIENTE"))


@query("dp29_audience_members", f"WITH {MEMBERS} SELECT client, origin, proforma, conversion, project, source, changed, level, leads, first_lead, last_lead, last_advance, reachable, consent, suppressed, converted, positive, negative, deliverable, slice FROM sl")
def dp29_members(t: Tables) -> DataFrame:
    return members(t)


@query("dp29_audience_health", f"WITH {MEMBERS} SELECT slice, count(*) AS people, count(*) FILTER (positive) AS positive, count(*) FILTER (negative) AS negative, count(*) FILTER (reachable) AS reachable, count(*) FILTER (deliverable) AS deliverable, count(*) FILTER (conversion IS NOT NULL) AS with_conversion, count(*) FILTER (changed) AS changed, count(DISTINCT project) AS projects FROM sl GROUP BY 1")
def dp29_health(t: Tables) -> DataFrame:
    n = lambda c: F.count_if(F.col(c)).alias(c)
    return members(t).groupBy("slice").agg(F.count("*").alias("people"), n("positive"), n("negative"), n("reachable"), n("deliverable"), F.count("conversion").alias("with_conversion"), n("changed"), F.count_distinct("project").alias("projects"))


SOURCES = ("leads", "assignments", "proformas", "interactions", "visits")
WEEK = "CAST(date_trunc('week', {}) AS DATE)"
PANEL = f"""{LEADS}, {PE}, src AS MATERIALIZED (
 SELECT 'leads' AS source, project, {WEEK.format('d')} AS week, count(*) AS n, count(DISTINCT client) AS people FROM leads GROUP BY ALL
 UNION ALL SELECT 'assignments', project, {WEEK.format('d')}, count(*), count(DISTINCT client) FROM leads WHERE status<>'P' GROUP BY ALL
 UNION ALL SELECT 'proformas', s_nationkey, {WEEK.format('l_shipdate')}, count(*), NULL FROM lineitem JOIN supplier ON s_suppkey=l_suppkey WHERE l_linestatus='O' GROUP BY ALL
 UNION ALL SELECT 'interactions', user_id%10, {WEEK.format('ts')}, count(*), NULL FROM events GROUP BY ALL
 UNION ALL SELECT 'visits', user_id%10, {WEEK.format('ts')}, count(*), NULL FROM events WHERE event_type='view' GROUP BY ALL),
 ev AS (SELECT project, {WEEK.format('d')} AS week, count(*) FILTER (kind='SEPARACION') AS separations, count(*) FILTER (kind='VENTA') AS sales, count(*) FILTER (kind='CAIDA') AS falls FROM pe GROUP BY 1,2),
 bd AS (SELECT project, min(week) AS lo FROM (SELECT project, week FROM src UNION ALL SELECT project, week FROM ev) GROUP BY 1), hi AS (SELECT max(week) AS hi FROM (SELECT week FROM src UNION ALL SELECT week FROM ev)),
 sp AS (SELECT project, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week FROM bd, hi),
 st AS (SELECT project, source, min(week) AS since FROM src GROUP BY 1,2),
 pv AS (SELECT project, week, {', '.join(f"sum(n) FILTER (source='{s}') AS {s}" for s in SOURCES)}, sum(people) FILTER (source='leads') AS clients FROM src GROUP BY 1,2),
 sn AS (SELECT project, {', '.join(f"min(since) FILTER (source='{s}') AS since_{s}" for s in SOURCES)} FROM st GROUP BY 1)
 SELECT project, week, {', '.join(f"CASE WHEN week>=since_{s} THEN CAST(coalesce({s},0) AS BIGINT) END AS {s}" for s in SOURCES)}, CASE WHEN week>=since_leads THEN CAST(coalesce(clients,0) AS BIGINT) END AS clients, coalesce(separations,0) AS separations, coalesce(sales,0) AS sales, coalesce(falls,0) AS falls FROM sp LEFT JOIN pv USING (project, week) LEFT JOIN ev USING (project, week) LEFT JOIN sn USING (project)"""


@query("dp25_demand_sources", f"WITH {PANEL}")
def dp25_sources(t: Tables) -> DataFrame:
    """Each project's weeks from its first sign to the last week of all, with five sources and what the ledger of events says; a source is null before its first week there, then 0.

    Each source is summed by project and week by itself; what is joined is one row a week.
    """
    week = lambda c: F.to_date(F.date_trunc("week", c)).alias("week")
    lead, event = leads(t), t.events.select((F.col("user_id") % 10).alias("project"), "ts", "event_type")
    offers = t.lineitem.where("l_linestatus = 'O'").join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("s_nationkey").alias("project"), "l_shipdate")
    none = F.lit(None).cast("long").alias("people")
    people_of = F.count_distinct("client").alias("people")
    parts = {"leads": (lead, "d", people_of), "assignments": (lead.where("status <> 'P'"), "d", people_of), "proformas": (offers, "l_shipdate", none), "interactions": (event, "ts", none), "visits": (event.where("event_type = 'view'"), "ts", none)}
    src = None
    for name, (rows, when, who) in parts.items():
        one = rows.groupBy("project", week(when)).agg(F.count("*").alias("n"), who).select(F.lit(name).alias("source"), F.col("project").cast("long").alias("project"), "week", "n", "people")
        src = one if src is None else src.unionByName(one)
    kind = lambda k: F.count_if(F.col("kind") == k)
    ev = process_events(t).groupBy(F.col("project").cast("long").alias("project"), week("d")).agg(kind("SEPARACION").alias("separations"), kind("VENTA").alias("sales"), kind("CAIDA").alias("falls"))
    own = lambda s, x: F.sum(F.when(F.col("source") == s, F.col(x)))
    pv = src.groupBy("project", "week").agg(*(own(s, "n").alias(s) for s in SOURCES), own("leads", "people").alias("clients"))
    every = pv.join(ev, ["project", "week"], "full_outer")
    since = {f"since_{s}": F.min(F.when(F.col(s).isNotNull(), F.col("week"))).over(Window.partitionBy("project")) for s in SOURCES}
    starts = every.groupBy("project").agg(F.min("week").alias("lo"), *(F.min(F.when(F.col(s).isNotNull(), F.col("week"))).alias(n) for s, n in zip(SOURCES, since, strict=True)))
    last = every.agg(F.max("week").alias("hi"))
    spine = starts.crossJoin(F.broadcast(last)).withColumn("week", F.explode(F.expr("sequence(lo, hi, interval 7 days)")))  # one row of last
    rows = spine.join(every, ["project", "week"], "left")
    shown = lambda s, n: F.when(F.col("week") >= F.col(f"since_{s}"), F.coalesce(n, F.lit(0))).alias(n)
    return rows.select("project", "week", *(shown(s, s) for s in SOURCES), shown("leads", "clients"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("separations", "sales", "falls")))


SNAPSHOT = f"""{LEDGER}, dl AS (SELECT unit, project, d, after_state AS state FROM ledger QUALIFY row_number() OVER (PARTITION BY unit, d ORDER BY n DESC)=1),
 iv AS (SELECT *, lead(d) OVER (PARTITION BY unit ORDER BY d) AS until FROM dl), hi AS (SELECT max(d) AS hi FROM dl),
 sd AS (SELECT unit, project, CAST(unnest(generate_series(CAST(d AS TIMESTAMP), CAST(coalesce(until-1, hi) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day, state FROM iv, hi)"""


@query("dp24_daily_unit_snapshot", f"WITH RECURSIVE {SNAPSHOT} SELECT unit, project, day, CASE state WHEN 'AVAILABLE' THEN 'DISPONIBLE' WHEN 'SEPARATED' THEN 'SEPARADO' WHEN 'SOLD' THEN 'VENDIDO' ELSE 'DESCONOCIDO' END AS standing, CASE WHEN state='AVAILABLE' THEN TRUE WHEN state IN ('SEPARATED','SOLD') THEN FALSE END AS offered FROM sd")
def dp24_snapshot(t: Tables) -> DataFrame:
    """Each unit on each day from its first event on, as the day ended: the days between two events are made from the first, without a calendar join."""
    day = latest(ledger(t), ["unit", "d"], F.col("event_order").desc()).select("unit", "project", "d", F.col("after_state").alias("state"))
    last = day.agg(F.max("d").alias("hi"))
    until = F.lead("d").over(Window.partitionBy("unit").orderBy("d"))
    rows = day.withColumn("until", until).crossJoin(F.broadcast(last)).withColumn("day", F.explode(F.sequence("d", F.coalesce(F.date_sub("until", 1), "hi"))))
    state = F.col("state")
    return rows.select("unit", "project", "day", first_of((state == "AVAILABLE", "DISPONIBLE"), (state == "SEPARATED", "SEPARADO"), (state == "SOLD", "VENDIDO"), otherwise="DESCONOCIDO").alias("standing"), F.when(state == "AVAILABLE", True).when(state.isin("SEPARATED", "SOLD"), False).alias("offered"))


@query("dp24_event_versions", f"WITH RECURSIVE {LEDGER}, a AS (SELECT event_id AS k, unit, project, kind, d FROM ledger WHERE applied), o AS (SELECT k, unit, project, kind, CASE WHEN k%11=0 THEN d-1 ELSE d END AS d FROM a WHERE k%7<>0 UNION ALL SELECT -k, unit, project, kind, d FROM a WHERE k%13=0) SELECT a.k, a.unit, a.kind, a.d, TRUE AS active, CASE WHEN o.k IS NULL THEN 'NUEVO' ELSE 'CAMBIO' END AS why FROM a LEFT JOIN o USING (k) WHERE o.k IS NULL OR (o.d, o.project) IS DISTINCT FROM (a.d, a.project) UNION ALL SELECT o.k, o.unit, o.kind, o.d, FALSE, 'BAJA' FROM o LEFT JOIN a USING (k) WHERE a.k IS NULL")
def dp24_versions(t: Tables) -> DataFrame:
    """What a capture of the applied events appends to an earlier one: new and changed events, and those that are gone, as no longer active."""
    now = ledger(t).where("applied").select(F.col("event_id").alias("k"), "unit", "project", "kind", "d")
    old = now.where("k % 7 <> 0").withColumn("d", F.when(F.col("k") % 11 == 0, F.date_sub("d", 1)).otherwise(F.col("d"))).unionByName(now.where("k % 13 = 0").withColumn("k", -F.col("k")))
    was = old.select("k", *(F.col(c).alias(f"_{c}") for c in ("unit", "project", "kind", "d")), F.lit(True).alias("had"))
    j = now.withColumn("has", F.lit(True)).join(was, "k", "full_outer")
    same = F.col("d").eqNullSafe(F.col("_d")) & F.col("project").eqNullSafe(F.col("_project"))
    why = first_of((F.col("has").isNull(), "BAJA"), (F.col("had").isNull(), "NUEVO"), (~same, "CAMBIO"))
    return j.select("k", F.coalesce("unit", "_unit").alias("unit"), F.coalesce("kind", "_kind").alias("kind"), F.coalesce("d", "_d").alias("d"), F.col("has").isNotNull().alias("active"), why.alias("why")).where("why is not null")
