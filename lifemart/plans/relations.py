"""Joins, aggregates, windows, top-k and set operations over orders, lines, customers, parts and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import evidence_class, first_of, lead_bucket, ratio, reasons, schedule_band
from ..functions.text import unit_type
from ..operators.quantiles import exact_quantiles
from ..operators.temporal import as_of_before, calendar, first_after, latest, month_of, running
from ..registry import Tables, query
from .mapping import CONV, LEADS, PE, PM, conversions, leads, process_events, project_months

AS_OF = "2000-01-01"


def rnd(c, n: int = 6):
    return F.round(c, n)


@query("sc12_date_dim", "SELECT CAST(x AS DATE) AS day, year(x) AS year, quarter(x) AS quarter, month(x) AS month, isodow(x) AS iso_weekday FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) x FROM (SELECT date_trunc('day', min(o_orderdate)) lo, date_trunc('day', max(o_orderdate)) hi FROM orders))")
def sc12(t: Tables) -> DataFrame:
    day = F.col("day")
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return span.select(calendar("lo", "hi")).select("day", *(f.cast("long").alias(n) for f, n in ((F.year(day), "year"), (F.quarter(day), "quarter"), (F.month(day), "month"), (F.weekday(day) + 1, "iso_weekday"))))


@query("sc13_truncations", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, last_day(CAST(o_orderdate AS DATE)) AS month_end, date_diff('month', DATE '1995-01-01', CAST(date_trunc('month', o_orderdate) AS DATE)) AS months FROM orders")
def sc13(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", month_of(d).alias("month"), F.trunc(d, "week").alias("week"), F.last_day(d).alias("month_end"), F.months_between(month_of(d), F.lit("1995-01-01").cast("date")).cast("long").alias("months"))


@query("flt01_exclude", "WITH rules AS (SELECT * FROM (VALUES ('BUILDING', DATE '1995-01-01', CAST(NULL AS DATE)), ('MACHINERY', NULL, DATE '1998-12-31')) r(segment, valid_from, valid_to)) SELECT o_orderkey FROM orders JOIN customer ON o_custkey=c_custkey WHERE NOT EXISTS (SELECT 1 FROM rules WHERE segment=c_mktsegment AND (valid_from IS NULL OR valid_from<=CAST(o_orderdate AS DATE)) AND (valid_to IS NULL OR CAST(o_orderdate AS DATE)<=valid_to))")
def flt01(t: Tables) -> DataFrame:
    rules = t.spark.sql("SELECT * FROM VALUES ('BUILDING', DATE'1995-01-01', CAST(NULL AS DATE)), ('MACHINERY', CAST(NULL AS DATE), DATE'1998-12-31') r(segment, valid_from, valid_to)")
    d = F.to_date("o_orderdate")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    hit = (F.col("segment") == F.col("c_mktsegment")) & (F.col("valid_from").isNull() | (F.col("valid_from") <= d)) & (F.col("valid_to").isNull() | (d <= F.col("valid_to")))
    return rows.join(F.broadcast(rules), hit, "left_anti").select("o_orderkey")


@query("flt02_unit_type", "SELECT p_partkey, CASE WHEN p_type LIKE 'E%' THEN 'DEPARTAMENTO' WHEN p_type LIKE 'S%' THEN 'ESTACIONAMIENTO' WHEN p_type LIKE 'P%' THEN 'DEPOSITO' WHEN p_type LIKE 'M%' THEN 'LOCAL' ELSE 'OTRO' END AS unit_type, p_type LIKE 'E%' AS is_home FROM part")
def flt02(t: Tables) -> DataFrame:
    names = F.create_map(*(F.lit(x) for p in (("E", "Departamento 1"), ("S", "Estacionamiento"), ("P", "deposito"), ("M", "LOCAL")) for x in p))
    kind = unit_type(F.coalesce(names[F.substring("p_type", 1, 1)], F.lit("otra cosa")))
    return t.part.select("p_partkey", kind.alias("unit_type"), (kind == "DEPARTAMENTO").alias("is_home"))


@query("flt03_unit_state", f"WITH {PE}, k AS (SELECT unit, bool_or(kind='VENTA') AS sold, bool_or(kind='SEPARACION') AS sep, bool_or(kind='CAIDA') AS fal FROM pe GROUP BY 1), s AS (SELECT unit, CASE WHEN sold THEN 'VENDIDA' WHEN sep THEN 'SEPARADA' WHEN fal THEN 'BLOQUEADA' ELSE 'DISPONIBLE' END AS state FROM k) SELECT unit, state, CASE state WHEN 'DISPONIBLE' THEN 1 WHEN 'SEPARADA' THEN 2 WHEN 'VENDIDA' THEN 3 WHEN 'BLOQUEADA' THEN 4 ELSE 99 END AS sort_order FROM s")
def flt03(t: Tables) -> DataFrame:
    has = lambda k: F.bool_or(F.col("kind") == k)
    units = process_events(t).groupBy("unit").agg(has("VENTA").alias("sold"), has("SEPARACION").alias("sep"), has("CAIDA").alias("fal"))
    state = first_of((F.col("sold"), "VENDIDA"), (F.col("sep"), "SEPARADA"), (F.col("fal"), "BLOQUEADA"), otherwise="DISPONIBLE")
    order = F.create_map(*(F.lit(x) for p in (("DISPONIBLE", 1), ("SEPARADA", 2), ("VENDIDA", 3), ("BLOQUEADA", 4)) for x in p))
    return units.select("unit", state.alias("state")).withColumn("sort_order", F.coalesce(order[F.col("state")], F.lit(99)))


@query("flt04_eligible_units", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING','HOUSEHOLD') OR NOT (c_nationkey IS DISTINCT FROM 7)")
def flt04(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD") | F.col("c_nationkey").eqNullSafe(F.lit(7))).select("c_custkey")


@query("flt05_cycle_quality", f"WITH {LEADS}, {CONV} SELECT lead, CASE WHEN converted IS NULL THEN 'SIN_VENTA' WHEN converted<d THEN 'VENTA_ANTERIOR' WHEN amount<=0 THEN 'SIN_MONTO' WHEN converted-d>100 THEN 'DEMORADA' WHEN status='F' THEN 'CERRADA' WHEN channel='MACHINERY' THEN 'FUERA_ALCANCE' ELSE 'ELEGIBLE' END AS quality FROM leads LEFT JOIN conv USING (lead)")
def flt05(t: Tables) -> DataFrame:
    c, d = F.col("converted"), F.col("d")
    kind = first_of((c.isNull(), "SIN_VENTA"), (c < d, "VENTA_ANTERIOR"), (F.col("amount") <= 0, "SIN_MONTO"), (F.datediff(c, d) > 100, "DEMORADA"), (F.col("status") == "F", "CERRADA"), (F.col("channel") == "MACHINERY", "FUERA_ALCANCE"), otherwise="ELEGIBLE")
    return leads(t).join(conversions(t), "lead", "left").select("lead", kind.alias("quality"))


@query("flt06_eligibility_status", f"WITH {LEADS} SELECT lead, CASE WHEN status='P' THEN 'BLOCKED_PENDING' WHEN amount<1000 THEN 'EXCLUDED_SMALL' WHEN d<DATE '1996-01-01' THEN 'EXCLUDED_OLD' ELSE 'ELIGIBLE' END AS eligibility FROM leads")
def flt06(t: Tables) -> DataFrame:
    return leads(t).select("lead", first_of((F.col("status") == "P", "BLOCKED_PENDING"), (F.col("amount") < 1000, "EXCLUDED_SMALL"), (F.col("d") < "1996-01-01", "EXCLUDED_OLD"), otherwise="ELIGIBLE").alias("eligibility"))


@query("flt07_quality_reasons", f"WITH {LEADS} SELECT lead, array_to_string(list_filter([CASE WHEN status='P' THEN 'PENDING' END, CASE WHEN amount>200000 THEN 'LARGE' END, CASE WHEN channel='AUTOMOBILE' THEN 'AUTO' END], lambda x: x IS NOT NULL), ',') AS why FROM leads")
def flt07(t: Tables) -> DataFrame:
    return leads(t).select("lead", F.array_join(reasons((F.col("status") == "P", "PENDING"), (F.col("amount") > 200000, "LARGE"), (F.col("channel") == "AUTOMOBILE", "AUTO")), ",").alias("why"))


@query("flt08_metric_is_atomic", "SELECT p_partkey, NOT (regexp_matches(p_name, '[+/&]') OR contains(p_name, ' y ') OR contains(lower(p_name), 'red')) AS atomic FROM part")
def flt08(t: Tables) -> DataFrame:
    n = F.col("p_name")
    return t.part.select("p_partkey", (~(n.rlike("[+/&]") | n.contains(" y ") | F.lower(n).contains("red"))).alias("atomic"))


@query("flt09_schedule_band", f"WITH {LEADS} SELECT lead, CASE WHEN d-DATE '{AS_OF}'<0 THEN 'PAST' WHEN d-DATE '{AS_OF}'<=30 THEN 'CRITICAL' WHEN d-DATE '{AS_OF}'<=90 THEN 'LATE' WHEN d-DATE '{AS_OF}'<=180 THEN 'MID' ELSE 'EARLY' END AS band FROM leads")
def flt09(t: Tables) -> DataFrame:
    return leads(t).select("lead", schedule_band(F.col("d"), F.lit(AS_OF).cast("date")).alias("band"))


@query("flt10_lead_bucket", f"WITH {LEADS}, {CONV} SELECT lead, CASE WHEN x<0 THEN 'AFTER' WHEN x<=7 THEN '0_7' WHEN x<=30 THEN '8_30' WHEN x<=60 THEN '31_60' WHEN x<=90 THEN '61_90' ELSE '90_PLUS' END AS bucket FROM (SELECT lead, converted-d AS x FROM leads JOIN conv USING (lead))")
def flt10(t: Tables) -> DataFrame:
    return leads(t).join(conversions(t), "lead").select("lead", lead_bucket(F.datediff("converted", "d")).alias("bucket"))


@query("flt11_evidence_class", f"WITH {LEADS}, {CONV} SELECT lead, CASE WHEN d>=target THEN 'BACKTEST' WHEN cutoff<=d THEN 'PROSPECTIVE' ELSE 'SHADOW' END AS class FROM (SELECT lead, d, converted-60 AS target, converted-75 AS cutoff FROM leads JOIN conv USING (lead))")
def flt11(t: Tables) -> DataFrame:
    rows = leads(t).join(conversions(t), "lead")
    return rows.select("lead", evidence_class(F.col("d"), F.date_sub("converted", 75), F.date_sub("converted", 60)).alias("class"))


PATTERNS = (("red", "COLOR"), ("blue", "COLOR"), ("small", "SIZE"), ("ring", "SHAPE"), ("widget", "SHAPE"))
PATTERNS_SQL = ", ".join(f"('{a}','{b}')" for a, b in PATTERNS)


@query("flt12_document_classifier", f"WITH pat AS (SELECT * FROM (VALUES {PATTERNS_SQL}) p(word, class)), m AS (SELECT p_partkey, count(DISTINCT class) AS n, min(class) AS class FROM part LEFT JOIN pat ON contains(' '||lower(p_name)||' ', ' '||word||' ') GROUP BY 1) SELECT p_partkey, CASE WHEN n=1 THEN class ELSE 'INCIERTO' END AS class FROM m")
def flt12(t: Tables) -> DataFrame:
    """Whole words meet the pattern table by equality: no scan of all patterns for each row."""
    patterns = t.spark.createDataFrame(PATTERNS, "word string, class string")
    words = t.part.select("p_partkey", F.explode(F.split(F.trim(F.regexp_replace(F.lower("p_name"), r"\s+", " ")), " ")).alias("word"))
    classes = words.join(F.broadcast(patterns), "word", "left").groupBy("p_partkey").agg(F.count_distinct("class").alias("n"), F.min("class").alias("class"))
    return classes.select("p_partkey", F.when(F.col("n") == 1, F.col("class")).otherwise("INCIERTO").alias("class"))


@query("jn06_context_as_of", "WITH ind AS (SELECT s_nationkey AS indicator, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, CAST(date_trunc('month', l_shipdate) AS DATE)+45 AS published, CAST(date_trunc('month', l_shipdate) AS DATE)+50 AS ingested, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1,2), cuts AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS cut FROM orders), r AS (SELECT cut, indicator, period, v, row_number() OVER (PARTITION BY cut, indicator ORDER BY period DESC) rn FROM cuts JOIN ind ON published<cut AND ingested<cut) SELECT cut, indicator, period, v FROM r WHERE rn=1")
def jn06(t: Tables) -> DataFrame:
    """Both times bound the row, so its later one is the time it is known from: an as-of join on that."""
    known = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("indicator"), F.trunc("l_shipdate", "month").alias("period")).agg(F.sum(F.col("l_quantity").cast("long")).alias("v"))
    known = known.withColumn("known", F.greatest(F.date_add("period", 45), F.date_add("period", 50)))
    cuts = t.orders.select(F.trunc("o_orderdate", "quarter").alias("cut")).distinct()
    grid = cuts.crossJoin(F.broadcast(known.select("indicator").distinct()))
    return as_of_before(grid, known.withColumn("p", F.col("period")), ["indicator"], "cut", "known", ["p", "v"]).where("p is not null").select("cut", "indicator", F.col("p").alias("period"), "v")


@query("jn08_outcome_windows", f"WITH {LEADS}, {CONV} SELECT project, h.h AS horizon, count(*) AS n, count(*) FILTER (converted>d AND converted<=d+h.h) AS hits FROM leads LEFT JOIN conv USING (lead) CROSS JOIN (VALUES (30),(60),(90),(180)) h(h) GROUP BY 1,2")
def jn08(t: Tables) -> DataFrame:
    rows = leads(t).join(conversions(t), "lead", "left").withColumn("horizon", F.explode(F.array(*map(F.lit, (30, 60, 90, 180)))))
    hit = (F.col("converted") > F.col("d")) & (F.datediff("converted", "d") <= F.col("horizon"))
    return rows.groupBy("project", "horizon").agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))


@query("jn09_months_by_units", f"WITH {LEADS}, {CONV}, m AS (SELECT CAST(unnest(generate_series(date_trunc('month', CAST(lo AS TIMESTAMP)), date_trunc('month', CAST(hi AS TIMESTAMP)), INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT min(d) AS lo, greatest(max(d), max(converted)) AS hi FROM leads LEFT JOIN conv USING (lead))) SELECT month, project, count(*) FILTER (d<=last_day(month) AND (converted IS NULL OR converted>last_day(month))) AS open, count(*) FILTER (converted BETWEEN month AND last_day(month)) AS sold FROM leads LEFT JOIN conv USING (lead) CROSS JOIN m GROUP BY 1,2")
def jn09(t: Tables, first: str | None = None, last: str | None = None) -> DataFrame:
    """Counts of months by units without their product: each unit adds to a month when it opens and takes away when it closes.

    All months from the first event to the last, or those from first to last.
    """
    rows = leads(t).join(conversions(t), "lead", "left")
    ends = rows.agg(month_of(F.min("d")).alias("lo"), month_of(F.greatest(F.max("d"), F.max("converted"))).alias("hi"))
    months = ends.where("lo is not null").select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
    grid = rows.select("project").distinct().crossJoin(F.broadcast(months))  # a row for each month
    opened = rows.where(F.col("converted").isNull() | (month_of(F.col("converted")) > month_of(F.col("d")))).select("project", month_of(F.col("d")).alias("month"), F.lit(1).alias("delta"), F.lit(0).alias("sold"))
    closed = rows.where("converted is not null").select("project", month_of(F.col("converted")).alias("month"), F.when(month_of(F.col("converted")) > month_of(F.col("d")), -1).otherwise(0).alias("delta"), F.lit(1).alias("sold"))
    moves = opened.unionByName(closed).groupBy("project", "month").agg(F.sum("delta").alias("delta"), F.sum("sold").alias("sold"))
    every = moves.unionByName(grid.select("project", "month", F.lit(0).alias("delta"), F.lit(0).alias("sold"))).groupBy("project", "month").agg(F.sum("delta").alias("delta"), F.sum("sold").alias("sold"))
    return every.withColumn("open", F.sum("delta").over(running(["project"], "month"))).where((F.col("month") >= first if first else F.lit(True)) & (F.col("month") <= last if last else F.lit(True))).select("month", "project", "open", "sold")


@query("jn10_projects_by_scenarios", "SELECT c_custkey AS client, code, round(c_acctbal*(1+uplift),6) AS v FROM customer CROSS JOIN (VALUES ('BASE',0.0::DOUBLE),('UP5',0.05::DOUBLE),('UP10',0.1::DOUBLE)) s(code, uplift)")
def jn10(t: Tables) -> DataFrame:
    scenarios = t.spark.createDataFrame([("BASE", 0.0), ("UP5", 0.05), ("UP10", 0.1)], "code string, uplift double")
    return t.customer.crossJoin(F.broadcast(scenarios)).select(F.col("c_custkey").alias("client"), "code", rnd(F.col("c_acctbal") * (1 + F.col("uplift"))).alias("v"))


@query("jn11_exists_positive", "SELECT DISTINCT o_custkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey=p_partkey WHERE l_orderkey=o.o_orderkey AND p_type='ECONOMY')")
def jn11(t: Tables) -> DataFrame:
    owned = t.lineitem.join(t.part.where("p_type = 'ECONOMY'"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(owned, "o_orderkey", "left_semi").select("o_custkey").distinct()


@query("jn12_not_exposed", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c.c_custkey AND o_orderstatus='P') AND NOT EXISTS (SELECT 1 FROM events WHERE user_id=c.c_custkey AND event_type='error') AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey=c.c_custkey)")
def jn12(t: Tables) -> DataFrame:
    out = t.customer.select("c_custkey")
    for seen in (t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), t.events.where("event_type = 'error'").select(F.col("user_id").alias("c_custkey")), t.supplier.select(F.col("s_suppkey").alias("c_custkey"))):
        out = out.join(seen, "c_custkey", "left_anti")
    return out


@query("jn13_exists_in_horizon", f"WITH {LEADS}, {CONV} SELECT lead, CASE WHEN d+60<=DATE '{AS_OF}' THEN CAST(coalesce(converted>=d AND converted<d+60, FALSE) AS INTEGER) END AS label FROM leads LEFT JOIN conv USING (lead)")
def jn13(t: Tables) -> DataFrame:
    hit = F.coalesce((F.col("converted") >= F.col("d")) & (F.datediff("converted", "d") < 60), F.lit(False)).cast("int")
    return leads(t).join(conversions(t), "lead", "left").select("lead", F.when(F.date_add("d", 60) <= F.lit(AS_OF).cast("date"), hit).alias("label"))


@query("jn14_substring_rule", "WITH r AS (SELECT * FROM (VALUES ('RING',1),('RED',2),('GET',3)) r(k, rule)) SELECT p_partkey, rule FROM part LEFT JOIN r ON contains(upper(p_name), k)")
def jn14(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("RING", 1), ("RED", 2), ("GET", 3)], "k string, rule int")
    return t.part.join(F.broadcast(rules), F.upper("p_name").contains(F.col("k")), "left").select("p_partkey", "rule")


@query("jn15_null_safe_segment", "WITH a AS (SELECT nullif(c_mktsegment,'BUILDING') AS s, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT nullif(c_mktsegment,'BUILDING') AS s, round(sum(c_acctbal),2) AS v FROM customer GROUP BY 1) SELECT a.s AS segment, n, v FROM a JOIN b ON a.s IS NOT DISTINCT FROM b.s")
def jn15(t: Tables) -> DataFrame:
    s = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    a = t.customer.groupBy(s.alias("segment")).agg(F.count("*").alias("n"))
    b = t.customer.groupBy(s.alias("s")).agg(F.round(F.sum("c_acctbal"), 2).alias("v"))
    return a.join(b, F.col("segment").eqNullSafe(F.col("s"))).select("segment", "n", "v")


@query("jn16_multi_key_identity", "WITH src AS (SELECT DISTINCT user_id AS id, 'D'||(user_id%97) AS doc FROM events), cl AS (SELECT c_custkey AS id, 'D'||(c_custkey%97) AS doc FROM customer), k AS (SELECT s.id AS source, c.id AS client, 'ID' AS how FROM src s JOIN cl c ON s.id=c.id UNION ALL SELECT s.id, c.id, 'DOC' FROM src s JOIN cl c ON s.doc=c.doc) SELECT source, count(DISTINCT client) AS candidates, count(DISTINCT how) AS evidence FROM k GROUP BY 1")
def jn16(t: Tables) -> DataFrame:
    """How many clients have a source's id or document. Clients are counted by document, so no pair is made however many share one."""
    doc = lambda c: F.concat(F.lit("D"), F.col(c) % 97)
    source = t.events.select(F.col("user_id").alias("source")).distinct().withColumn("doc", doc("source"))
    client = t.customer.select(F.col("c_custkey").alias("client")).distinct().withColumn("client_doc", doc("client"))
    of_doc = client.groupBy(F.col("client_doc").alias("doc")).agg(F.count("client").alias("n"))
    both = source.join(client, F.col("source") == F.col("client"), "left").join(of_doc, "doc", "left")
    by_id, by_doc = F.col("client").isNotNull(), F.col("n").isNotNull()
    alone = by_id & ~F.col("doc").eqNullSafe(F.col("client_doc"))  # a client of that id with another document
    return both.where(by_id | by_doc).select("source", (F.coalesce("n", F.lit(0)) + alone.cast("long")).alias("candidates"), (by_id.cast("long") + by_doc.cast("long")).alias("evidence"))


SUCC = f"{LEADS}, s AS (SELECT a.lead, b.lead AS successor, b.d, CASE WHEN a.channel=b.channel THEN 1 ELSE 0 END + CASE WHEN a.seller=b.seller THEN 2 ELSE 0 END AS score FROM leads a JOIN leads b ON a.client=b.client AND b.lead<>a.lead AND b.d>=a.d AND b.d<=a.d+90 WHERE a.status='F'), best AS (SELECT *, row_number() OVER (PARTITION BY lead ORDER BY score DESC, d, successor) r FROM s)"


@query("jn17_successor_link", f"WITH {SUCC} SELECT lead, successor, score FROM best WHERE r=1")
def jn17(t: Tables) -> DataFrame:
    a, b = leads(t).where("status = 'F'"), leads(t).select("client", F.col("lead").alias("successor"), F.col("d").alias("d2"), F.col("channel").alias("channel2"), F.col("seller").alias("seller2"))
    pairs = a.join(b, "client").where("successor <> lead and d2 >= d and d2 <= date_add(d, 90)")
    score = F.when(F.col("channel") == F.col("channel2"), 1).otherwise(0) + F.when(F.col("seller") == F.col("seller2"), 2).otherwise(0)
    return latest(pairs.withColumn("score", score), ["lead"], F.col("score").desc(), F.col("d2"), F.col("successor")).select("lead", "successor", "score")


@query("dp40_transfer_lineage", f"WITH {SUCC} SELECT score, count(*) AS links, CAST(min(d) AS DATE) AS first_day FROM best WHERE r=1 GROUP BY 1")
def dp40(t: Tables) -> DataFrame:
    return jn17(t).join(leads(t).select(F.col("lead").alias("successor"), "d"), "successor").groupBy("score").agg(F.count("*").alias("links"), F.min("d").alias("first_day"))


ACTIONS = f"{LEADS}, rec AS (SELECT lead, client, d FROM leads WHERE lead%2=0), act AS (SELECT client, d AS acted, min(lead) AS action FROM leads WHERE lead%2=1 GROUP BY 1,2)"


@query("jn18_first_action_after", f"WITH {ACTIONS}, j AS (SELECT rec.lead, action, acted, row_number() OVER (PARTITION BY rec.lead ORDER BY acted) r FROM rec LEFT JOIN act ON act.client=rec.client AND acted>=rec.d) SELECT lead, action, acted FROM j WHERE r=1")
def jn18(t: Tables) -> DataFrame:
    actions = leads(t).where("lead % 2 = 1").groupBy("client", "d").agg(F.min("lead").alias("action")).withColumn("acted", F.col("d"))
    return first_after(leads(t).where("lead % 2 = 0"), actions, ["client"], "d", "d", ["acted", "action"]).select("lead", "action", "acted")


@query("jn19_latest_child", "SELECT c_custkey, o.o_orderkey AS last_order FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) r FROM orders) o ON o_custkey=c_custkey AND r=1")
def jn19(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))
    return t.customer.join(last, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "last_order")


@query("jn21_snapshot_revisions", "WITH a AS (SELECT p_partkey AS k, p_size AS s, p_brand AS b FROM part WHERE p_partkey%10<>1), z AS (SELECT p_partkey AS k, CASE WHEN p_partkey%7=0 THEN p_size+1 ELSE p_size END AS s, p_brand AS b FROM part WHERE p_partkey%10<>2) SELECT count(*) FILTER (a.k IS NOT NULL AND z.k IS NOT NULL) AS compared, count(*) FILTER (a.k IS NOT NULL AND z.k IS NOT NULL AND (a.s IS DISTINCT FROM z.s OR a.b IS DISTINCT FROM z.b)) AS revised, count(*) FILTER (z.k IS NULL) AS removed, count(*) FILTER (a.k IS NULL) AS added, count(*) FILTER (a.k IS NOT NULL AND z.k IS NOT NULL AND a.s IS DISTINCT FROM z.s) AS size_changes FROM a FULL JOIN z ON a.k=z.k")
def jn21(t: Tables) -> DataFrame:
    a = t.part.where("p_partkey % 10 <> 1").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"), F.col("p_brand").alias("b"), F.lit(True).alias("old"))
    z = t.part.where("p_partkey % 10 <> 2").select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("s2"), F.col("p_brand").alias("b2"), F.lit(True).alias("new"))
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    size = both & ~F.col("s").eqNullSafe(F.col("s2"))
    return a.join(z, "k", "full_outer").agg(F.count_if(both).alias("compared"), F.count_if(size | (both & ~F.col("b").eqNullSafe(F.col("b2")))).alias("revised"), F.count_if(F.col("new").isNull()).alias("removed"), F.count_if(F.col("old").isNull()).alias("added"), F.count_if(size).alias("size_changes"))


@query("ag04_monthly_sales", f"WITH {PM}, o AS (SELECT c_nationkey AS project, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS leads FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1,2), k AS (SELECT project, month FROM pm UNION SELECT project, month FROM o) SELECT project, month, coalesce(sales,0)-coalesce(falls,0) AS net, round(coalesce(n_lines,0)/nullif(CAST(leads AS DOUBLE),0),6) AS conversion, round(coalesce(falls,0)/nullif(CAST(sales AS DOUBLE),0),6) AS fall_rate FROM k LEFT JOIN pm USING (project, month) LEFT JOIN o USING (project, month)")
def ag04(t: Tables) -> DataFrame:
    """One grouping of both sides' rows instead of a spine and two joins."""
    a = project_months(t).select("project", "month", "sales", "n_lines", "falls", F.lit(None).cast("long").alias("leads"))
    b = leads(t).groupBy("project", month_of(F.col("d")).alias("month")).agg(F.count("*").alias("leads"))
    both = a.unionByName(b, allowMissingColumns=True).groupBy("project", "month").agg(*(F.sum(c).alias(c) for c in ("sales", "n_lines", "falls", "leads")))
    z = lambda c: F.coalesce(c, F.lit(0))
    return both.select("project", "month", (z("sales") - z("falls")).alias("net"), rnd(ratio(z("n_lines"), F.col("leads"))).alias("conversion"), rnd(ratio(z("falls"), F.col("sales"))).alias("fall_rate"))


@query("set03_key_spine", f"WITH {PM} SELECT project, month FROM pm UNION SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders JOIN customer ON o_custkey=c_custkey")
def set03(t: Tables) -> DataFrame:
    return project_months(t).select("project", "month").union(leads(t).select("project", month_of(F.col("d")))).distinct()


@query("ag05_eav_pivot", "WITH x AS (SELECT o_custkey AS k, 'status' AS a, o_orderstatus AS v, o_orderdate AS seen, o_orderkey AS id FROM orders UNION ALL SELECT o_custkey, 'priority', o_orderpriority, o_orderdate, o_orderkey FROM orders), l AS (SELECT *, row_number() OVER (PARTITION BY k, a ORDER BY seen DESC, id DESC) r FROM x WHERE v<>'') SELECT k, max(v) FILTER (a='status') AS status, max(v) FILTER (a='priority') AS priority FROM l WHERE r=1 GROUP BY 1")
def ag05(t: Tables) -> DataFrame:
    extras = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"), F.expr("stack(2, 'status', o_orderstatus, 'priority', o_orderpriority) as (a, v)")).where("v <> ''")
    return latest(extras, ["k", "a"], F.col("at").desc_nulls_last(), F.col("id").desc()).groupBy("k").pivot("a", ["status", "priority"]).agg(F.max("v"))


@query("ag06_metric_pivot", "SELECT o_custkey AS k, max(o_totalprice) FILTER (o_orderstatus='F') AS f, max(o_totalprice) FILTER (o_orderstatus='O') AS o, max(o_totalprice) FILTER (o_orderstatus='P') AS p FROM orders GROUP BY 1")
def ag06(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("k")).agg(*(F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(s.lower()) for s in "FOP"))


@query("ag07_median", "SELECT p_brand, round(quantile_cont(p_retailprice,0.5) FILTER (p_size>10),6) AS median FROM part GROUP BY 1")
def ag07(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(rnd(F.percentile(F.when(F.col("p_size") > 10, F.col("p_retailprice")), 0.5)).alias("median"))


@query("ag08_quantile_profile", "SELECT c_mktsegment, round(quantile_cont(c_acctbal,0.1),6) AS p10, round(quantile_cont(c_acctbal,0.5),6) AS p50, round(quantile_cont(c_acctbal,0.9),6) AS p90 FROM customer GROUP BY 1")
def ag08(t: Tables) -> DataFrame:
    q = t.customer.groupBy("c_mktsegment").agg(F.percentile("c_acctbal", [0.1, 0.5, 0.9]).alias("q"))
    return q.select("c_mktsegment", *(rnd(F.col("q")[i]).alias(n) for i, n in enumerate(("p10", "p50", "p90"))))


@query("ag09_first_last_in_month", "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS opening, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS closing FROM orders GROUP BY 1,2")
def ag09(t: Tables) -> DataFrame:
    order = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(F.min_by("o_totalprice", order).alias("opening"), F.max_by("o_totalprice", order).alias("closing"))


@query("ag10_first_last_touch", f"WITH {LEADS} SELECT client, arg_min(channel, (d, lead)) AS first_touch, arg_max(seller, (d, lead)) AS last_touch FROM leads GROUP BY 1")
def ag10(t: Tables) -> DataFrame:
    order = F.struct("d", "lead")
    return leads(t).groupBy("client").agg(F.min_by("channel", order).alias("first_touch"), F.max_by("seller", order).alias("last_touch"))


@query("ag11_stage_max", f"WITH {PE} SELECT unit, max(CASE kind WHEN 'ALTA' THEN 1 WHEN 'SEPARACION' THEN 2 WHEN 'VENTA' THEN 3 ELSE 0 END) AS stage, min(d) FILTER (kind='SEPARACION') AS first_separation, max(d) FILTER (kind<>'CAIDA') AS last_advance FROM pe GROUP BY 1")
def ag11(t: Tables) -> DataFrame:
    k = F.col("kind")
    return process_events(t).groupBy("unit").agg(F.max(first_of((k == "ALTA", 1), (k == "SEPARACION", 2), (k == "VENTA", 3), otherwise=0)).alias("stage"), F.min(F.when(k == "SEPARACION", F.col("d"))).alias("first_separation"), F.max(F.when(k != "CAIDA", F.col("d"))).alias("last_advance"))


@query("ag12_distinct_counts", "SELECT event_type, count(DISTINCT user_id) AS people, count(DISTINCT CASE WHEN value>10 THEN user_id END) AS active, count(*)-count(DISTINCT user_id) AS repeats FROM events GROUP BY 1")
def ag12(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("people"), F.count_distinct(F.when(F.col("value") > 10, F.col("user_id"))).alias("active"), (F.count("*") - F.count_distinct("user_id")).alias("repeats"))


@query("ag15_geometric_price_index", "WITH p AS (SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS period, l_partkey%20 AS item, avg(l_extendedprice/l_quantity) AS price FROM lineitem GROUP BY 1,2), b AS (SELECT item, price AS base FROM p WHERE period=(SELECT min(period) FROM p)), n AS (SELECT count(*) AS n FROM b) SELECT period, CASE WHEN count(base)=(SELECT n FROM n) THEN round(100*exp(avg(ln(price/base))),6) END AS index FROM p JOIN b USING (item) GROUP BY 1")
def ag15(t: Tables) -> DataFrame:
    p = t.lineitem.groupBy(F.trunc("l_shipdate", "year").alias("period"), (F.col("l_partkey") % 20).alias("item")).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    first = p.agg(F.min("period").alias("first"))
    base = p.join(F.broadcast(first), F.col("period") == F.col("first")).select("item", F.col("price").alias("base"))
    size = base.agg(F.count("*").alias("n"))
    index = p.join(base, "item").groupBy("period").agg(F.count("*").alias("covered"), F.avg(F.log(F.col("price") / F.col("base"))).alias("g")).crossJoin(F.broadcast(size))
    return index.select("period", F.when(F.col("covered") == F.col("n"), rnd(100 * F.exp("g"))).alias("index"))


@query("ag16_exposure_rate", f"WITH {LEADS}, {CONV} SELECT project, CAST(sum(coalesce(converted, DATE '2002-01-01')-d) AS BIGINT) AS exposure, count(converted) AS sales, round(30.0*count(converted)/nullif(CAST(sum(coalesce(converted, DATE '2002-01-01')-d) AS DOUBLE),0),8) AS rate FROM leads LEFT JOIN conv USING (lead) GROUP BY 1")
def ag16(t: Tables) -> DataFrame:
    days = F.datediff(F.coalesce("converted", F.lit("2002-01-01").cast("date")), F.col("d"))
    g = leads(t).join(conversions(t), "lead", "left").groupBy("project").agg(F.sum(days).alias("exposure"), F.count("converted").alias("sales"))
    return g.withColumn("rate", F.round(ratio(30.0 * F.col("sales"), F.col("exposure")), 8))


@query("ag17_stage_composition", f"WITH {PE}, c AS (SELECT project, kind, count(*) n FROM pe GROUP BY 1,2) SELECT project, '{{'||string_agg('\"'||kind||'\":'||n, ',' ORDER BY kind)||'}}' AS composition FROM c GROUP BY 1")
def ag17(t: Tables) -> DataFrame:
    counts = process_events(t).groupBy("project", "kind").agg(F.count("*").alias("n"))
    return counts.groupBy("project").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n"))))).alias("composition"))


@query("ag18_portfolio_rollup", f"WITH {PM} SELECT project, CAST(sum(sales) AS BIGINT) AS sales, CAST(sum(sales-falls) AS BIGINT) AS net FROM pm GROUP BY ROLLUP (project)")
def ag18(t: Tables) -> DataFrame:
    return project_months(t).rollup("project").agg(F.sum("sales").alias("sales"), F.sum(F.col("sales") - F.col("falls")).alias("net"))


CHECKS = (("fecha_nula", "FAIL", "o_orderdate is null"), ("monto_bajo", "WARN", "o_totalprice < 1000"), ("sin_cliente", "FAIL", "o_custkey is null"), ("pendiente", "INFO", "o_orderstatus = 'P'"))


@query("ag19_quality_results", " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{s}' AS severity, count(*) FILTER ({c}) AS failed, CASE WHEN '{s}'='INFO' THEN 'INFO' WHEN count(*) FILTER ({c})=0 THEN 'PASS' ELSE '{s}' END AS status FROM orders" for n, s, c in CHECKS))
def ag19(t: Tables) -> DataFrame:
    one = t.orders.agg(*(F.count_if(F.expr(c)).alias(n) for n, _, c in CHECKS))
    rows = F.inline(F.array(*(F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.col(n).alias("failed")) for n, s, _ in CHECKS)))
    return one.select(rows).withColumn("status", first_of((F.col("severity") == "INFO", "INFO"), (F.col("failed") == 0, "PASS"), otherwise=None)).withColumn("status", F.coalesce("status", "severity"))


@query("ag20_lifecycle_health", f"WITH {LEADS}, {CONV} SELECT count(*) AS leads, count(converted) AS converted, count(*) FILTER (converted IS NULL) AS open, count(*) FILTER (converted<d) AS backwards, count(DISTINCT client) AS clients, count(DISTINCT project) AS projects, min(d) AS first_day, max(d) AS last_day, round(avg(converted-d),6) AS mean_days FROM leads LEFT JOIN conv USING (lead)")
def ag20(t: Tables) -> DataFrame:
    c = F.col("converted")
    return leads(t).join(conversions(t), "lead", "left").agg(F.count("*").alias("leads"), F.count(c).alias("converted"), F.count_if(c.isNull()).alias("open"), F.count_if(c < F.col("d")).alias("backwards"), F.count_distinct("client").alias("clients"), F.count_distinct("project").alias("projects"), F.min("d").alias("first_day"), F.max("d").alias("last_day"), rnd(F.avg(F.datediff(c, "d"))).alias("mean_days"))


@query("ag22_hhi_and_wilson", f"WITH {LEADS}, {CONV}, g AS (SELECT channel, count(*)::DOUBLE AS n, count(converted)::DOUBLE AS k FROM leads LEFT JOIN conv USING (lead) GROUP BY 1), p AS (SELECT *, k/n AS p, sum(n) OVER () AS total, sum(k) OVER () AS hits FROM g) SELECT channel, round((n/total)*(n/total),8) AS hhi_part, round((p+1.9208/n-1.96*sqrt(p*(1-p)/n+0.9604/(n*n)))/(1+3.8416/n),8) AS low, round((p+1.9208/n+1.96*sqrt(p*(1-p)/n+0.9604/(n*n)))/(1+3.8416/n),8) AS high, round(p-hits/total,8) AS gap FROM p")
def ag22(t: Tables) -> DataFrame:
    g = leads(t).join(conversions(t), "lead", "left").groupBy("channel").agg(F.count("*").cast("double").alias("n"), F.count("converted").cast("double").alias("k"))
    total = g.agg(F.sum("n").alias("total"), F.sum("k").alias("hits"))
    p, n, z = F.col("k") / F.col("n"), F.col("n"), 1.96
    half = z * F.sqrt(p * (1 - p) / n + z * z / 4 / (n * n))
    bound = lambda s: F.round((p + z * z / 2 / n + s * half) / (1 + z * z / n), 8)
    return g.crossJoin(F.broadcast(total)).select("channel", F.round((n / F.col("total")) ** 2, 8).alias("hhi_part"), bound(-1).alias("low"), bound(1).alias("high"), F.round(p - F.col("hits") / F.col("total"), 8).alias("gap"))


@query("ag23_column_profile", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n, count(*)-count({c}) AS nulls, round(100.0*(count(*)-count({c}))/count(*),4) AS null_pct, count(DISTINCT {c}) AS distinct_values FROM customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def ag23(t: Tables) -> DataFrame:
    names = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    one = t.customer.agg(F.count("*").alias("n"), *(F.count(c).alias(f"f_{c}") for c in names), *(F.count_distinct(c).alias(f"d_{c}") for c in names))
    return one.select("n", F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"f_{c}").alias("filled"), F.col(f"d_{c}").alias("distinct_values")) for c in names)))).select("column_name", "n", (F.col("n") - F.col("filled")).alias("nulls"), F.round(100.0 * (F.col("n") - F.col("filled")) / F.col("n"), 4).alias("null_pct"), "distinct_values")


@query("ag24_numeric_profile", "SELECT count(o_totalprice) AS n, count(*) FILTER (o_totalprice=0) AS zeros, round(avg(o_totalprice),4) AS mean, round(stddev_samp(o_totalprice),4) AS sd, min(o_totalprice) AS lo, round(quantile_cont(o_totalprice,0.05),4) AS q05, round(quantile_cont(o_totalprice,0.95),4) AS q95, max(o_totalprice) AS hi, round(skewness(o_totalprice),6) AS skew FROM orders")
def ag24(t: Tables) -> DataFrame:
    """skew with the bias correction sqrt(n (n - 1)) / (n - 2); exact quantiles by narrowing intervals."""
    x, n = "o_totalprice", F.count("o_totalprice").cast("double")
    q = exact_quantiles(t.orders, [x], [0.05, 0.95])
    at = lambda p: F.round(F.lit(q[x, p]).cast("double"), 4)
    return t.orders.agg(F.count(x).alias("n"), F.count_if(F.col(x) == 0).alias("zeros"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_samp(x), 4).alias("sd"), F.min(x).alias("lo"), at(0.05).alias("q05"), at(0.95).alias("q95"), F.max(x).alias("hi"), rnd(F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"))


@query("ag25_table_inventory", "SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL) AS null_keys, (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey)>1)) AS multi_unit, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)>1)) AS duplicate_keys")
def ag25(t: Tables) -> DataFrame:
    """One scan: by order and line, then by order, then all."""
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
    orders = lines.groupBy("l_orderkey").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count_if(F.col("n") > 1).alias("twice"))
    return orders.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("l_orderkey").isNull(), F.col("n")).otherwise(0)), F.lit(0)).alias("null_keys"), F.count_if(F.col("lo") < F.col("hi")).alias("multi_unit"), F.coalesce(F.sum("twice"), F.lit(0)).alias("duplicate_keys"))


KEYS = (("l_orderkey",), ("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey"))


@query("ag26_key_candidates", " UNION ALL ".join(f"SELECT '{'+'.join(k)}' AS key, count(*) FILTER (n>1) AS duplicate_groups, count(*) FILTER (n>1)=0 AS is_unique FROM (SELECT count(*) n FROM lineitem GROUP BY {','.join(k)})" for k in KEYS))
def ag26(t: Tables) -> DataFrame:
    out = None
    for k in KEYS:
        one = t.lineitem.groupBy(*k).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_groups")).select(F.lit("+".join(k)).alias("key"), "duplicate_groups", (F.col("duplicate_groups") == 0).alias("is_unique"))
        out = one if out is None else out.unionByName(one)
    return out


@query("ag27_id_collisions", "WITH g AS (SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS names, count(*) AS n FROM events GROUP BY 1) SELECT names, count(*) AS ids, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY 1")
def ag27(t: Tables) -> DataFrame:
    g = t.events.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "|").alias("names"), F.count("*").alias("n"))
    return g.groupBy("names").agg(F.count("*").alias("ids"), F.sum("n").alias("n"))


@query("ag28_timestamp_pairs", "WITH p AS (SELECT date_diff('hour', o_orderdate, l_shipdate) AS h FROM lineitem JOIN orders ON l_orderkey=o_orderkey) SELECT count(*) FILTER (h=0) AS equal, count(*) FILTER (h<0) AS before, count(*) FILTER (h>0) AS after, round(quantile_cont(h,0.5),4) AS median, round(quantile_cont(h,0.9),4) AS p90 FROM p")
def ag28(t: Tables) -> DataFrame:
    h = F.expr("timestampdiff(HOUR, o_orderdate, l_shipdate)")
    p = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(h.alias("h"))
    g = p.where("h is not null").groupBy("h").agg(F.count("*").alias("n"))  # one row a number of hours
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n")).otherwise(0)), F.lit(0))
    return g.agg(n(F.col("h") == 0).alias("equal"), n(F.col("h") < 0).alias("before"), n(F.col("h") > 0).alias("after"), F.round(F.percentile("h", 0.5, F.col("n")), 4).alias("median"), F.round(F.percentile("h", 0.9, F.col("n")), 4).alias("p90"))


@query("ag29_linkage_coverage", "WITH u AS (SELECT DISTINCT user_id FROM events), c AS (SELECT DISTINCT c_custkey FROM customer), f AS (SELECT c_custkey%1000 AS k, count(*) AS n FROM customer GROUP BY 1) SELECT count(*) AS ids, count(c_custkey) AS direct, count(*) FILTER (c_custkey IS NULL AND n=1) AS fallback, count(*) FILTER (c_custkey IS NULL AND n>1) AS ambiguous, round(count(c_custkey)/CAST(count(*) AS DOUBLE),6) AS coverage FROM u LEFT JOIN c ON user_id=c_custkey LEFT JOIN f ON user_id%1000=k")
def ag29(t: Tables) -> DataFrame:
    u, c = t.events.select("user_id").distinct(), t.customer.select("c_custkey").distinct()
    f = t.customer.groupBy((F.col("c_custkey") % 1000).alias("k")).agg(F.count("*").alias("n"))
    j = u.join(c, F.col("user_id") == F.col("c_custkey"), "left").join(f, F.col("user_id") % 1000 == F.col("k"), "left")
    miss = F.col("c_custkey").isNull()
    return j.agg(F.count("*").alias("ids"), F.count("c_custkey").alias("direct"), F.count_if(miss & (F.col("n") == 1)).alias("fallback"), F.count_if(miss & (F.col("n") > 1)).alias("ambiguous"), rnd(ratio(F.count("c_custkey"), F.count("*"))).alias("coverage"))


@query("ag30_top_values", "SELECT p_brand AS v, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, v LIMIT 10")
def ag30(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_brand").alias("v")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(10)


@query("wn04_rolling_6m", f"WITH {PM}, w AS (SELECT project, month, first_value(sales) OVER w AS f, CAST(sum(sales) OVER w AS BIGINT) AS s, count(*) OVER w AS n FROM pm WINDOW w AS (PARTITION BY project ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) SELECT project, month, CASE WHEN n=6 THEN s END AS sales_6m, CASE WHEN n=6 THEN f END AS opening FROM w")
def wn04(t: Tables) -> DataFrame:
    w = Window.partitionBy("project").orderBy("month").rowsBetween(-5, 0)
    full = F.count("*").over(w) == 6
    return project_months(t).select("project", "month", F.when(full, F.sum("sales").over(w)).alias("sales_6m"), F.when(full, F.first("sales").over(w)).alias("opening"))


@query("wn05_latest_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) r FROM orders) WHERE r=1")
def wn05(t: Tables) -> DataFrame:
    return latest(t.orders, ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", "o_totalprice")


@query("wn07_price_changes", "WITH p AS (SELECT o_orderkey, o_custkey, round(o_totalprice,-4) AS price, lag(round(o_totalprice,-4)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders) SELECT o_orderkey, prior, price, price-prior AS delta, round((price-prior)/nullif(prior,0),6) AS pct FROM p WHERE prior IS NOT NULL AND prior IS DISTINCT FROM price")
def wn07(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    p = t.orders.withColumn("price", F.round("o_totalprice", -4)).withColumn("prior", F.lag("price").over(w))
    return p.where(F.col("prior").isNotNull() & ~F.col("prior").eqNullSafe(F.col("price"))).select("o_orderkey", "prior", "price", (F.col("price") - F.col("prior")).alias("delta"), rnd(ratio(F.col("price") - F.col("prior"), F.col("prior"))).alias("pct"))


@query("wn08_relative_to_segment", "SELECT p_partkey, round(p_size/nullif(avg(CASE WHEN p_retailprice>1000 THEN p_size END) OVER (PARTITION BY p_brand),0),6) AS area_ratio FROM part")
def wn08(t: Tables) -> DataFrame:
    mean = F.avg(F.when(F.col("p_retailprice") > 1000, F.col("p_size"))).over(Window.partitionBy("p_brand"))
    return t.part.select("p_partkey", rnd(ratio(F.col("p_size"), mean)).alias("area_ratio"))


@query("wn09_running_filtered_count", "SELECT o_orderkey, count(*) FILTER (o_orderstatus='F') OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS nth, bool_or(o_orderstatus='P') OVER (PARTITION BY o_custkey) AS any_pending FROM orders")
def wn09(t: Tables) -> DataFrame:
    is_f = F.when(F.col("o_orderstatus") == "F", 1)
    return t.orders.select("o_orderkey", F.count(is_f).over(running(["o_custkey"], "o_orderdate", "o_orderkey")).alias("nth"), F.bool_or(F.col("o_orderstatus") == "P").over(Window.partitionBy("o_custkey")).alias("any_pending"))


@query("wn14_share_of_total", f"WITH {PM} SELECT project, month, round(sales/CAST(sum(sales) OVER (PARTITION BY month) AS DOUBLE),8) AS share FROM pm")
def wn14(t: Tables) -> DataFrame:
    return project_months(t).select("project", "month", F.round(ratio(F.col("sales"), F.sum("sales").over(Window.partitionBy("month"))), 8).alias("share"))


@query("wn15_funnel_step_rate", f"WITH {LEADS}, {CONV}, s AS (SELECT project, 1 AS step, count(*) AS n FROM leads GROUP BY 1 UNION ALL SELECT project, 2, count(*) FILTER (amount>50000) FROM leads GROUP BY 1 UNION ALL SELECT project, 3, count(*) FILTER (amount>50000 AND converted IS NOT NULL) FROM leads LEFT JOIN conv USING (lead) GROUP BY 1) SELECT project, step, n, round(n/nullif(CAST(lag(n) OVER (PARTITION BY project ORDER BY step) AS DOUBLE),0),6) AS step_rate FROM s")
def wn15(t: Tables) -> DataFrame:
    big = F.col("amount") > 50000
    g = leads(t).join(conversions(t), "lead", "left").groupBy("project").agg(F.count("*").alias("a"), F.count_if(big).alias("b"), F.count_if(big & F.col("converted").isNotNull()).alias("c"))
    steps = g.select("project", F.expr("stack(3, 1, a, 2, b, 3, c) as (step, n)"))
    return steps.withColumn("step_rate", rnd(ratio(F.col("n"), F.lag("n").over(Window.partitionBy("project").orderBy("step")))))


@query("wn16_touch_flags", f"WITH {LEADS} SELECT lead, d=min(d) OVER (PARTITION BY client) AS is_first, d=max(d) OVER (PARTITION BY client) AS is_last FROM leads")
def wn16(t: Tables) -> DataFrame:
    w = Window.partitionBy("client")
    return leads(t).select("lead", (F.col("d") == F.min("d").over(w)).alias("is_first"), (F.col("d") == F.max("d").over(w)).alias("is_last"))


@query("wn17_balance_weight", f"WITH {LEADS} SELECT lead, round(1.0::DOUBLE/count(*) OVER (PARTITION BY client),8) AS weight FROM leads")
def wn17(t: Tables) -> DataFrame:
    return leads(t).select("lead", F.round(1.0 / F.count("*").over(Window.partitionBy("client")), 8).alias("weight"))


@query("wn18_percentile_rank", "SELECT c_custkey, round(cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal),8) AS pct FROM customer")
def wn18(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.round(F.cume_dist().over(Window.partitionBy("c_nationkey").orderBy("c_acctbal")), 8).alias("pct"))


@query("wn19_months_since_launch", f"WITH {PM} SELECT project, month, date_diff('month', min(month) OVER (PARTITION BY project), month) AS age, CAST(sum(sales) OVER (PARTITION BY project ORDER BY month) AS BIGINT) AS cumulative FROM pm")
def wn19(t: Tables) -> DataFrame:
    first = F.min("month").over(Window.partitionBy("project"))
    return project_months(t).select("project", "month", F.months_between("month", first).cast("long").alias("age"), F.sum("sales").over(running(["project"], "month")).alias("cumulative"))


@query("wn20_observed_cumulatives", f"WITH {PM}, c AS (SELECT project, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT project, min(month) lo, max(month) hi FROM pm GROUP BY 1)), j AS (SELECT c.project, c.month, sales, falls FROM c LEFT JOIN pm USING (project, month)) SELECT project, month, CAST(sum(sales) OVER w AS BIGINT) AS gross, CAST(sum(sales-falls) OVER w AS BIGINT) AS net, round(sum(falls) OVER w/nullif(CAST(sum(sales) OVER w AS DOUBLE),0),8) AS fall_ratio FROM j WINDOW w AS (PARTITION BY project ORDER BY month ROWS UNBOUNDED PRECEDING)")
def wn20(t: Tables) -> DataFrame:
    pm = project_months(t)
    grid = pm.groupBy("project").agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select("project", F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
    w = running(["project"], "month")
    gross, falls = F.sum("sales").over(w), F.sum("falls").over(w)
    return grid.join(pm, ["project", "month"], "left").select("project", "month", gross.alias("gross"), (gross - falls).alias("net"), F.round(ratio(falls, gross), 8).alias("fall_ratio"))


@query("tk02_priority_bands", f"WITH {LEADS}, r AS (SELECT lead, row_number() OVER (PARTITION BY d ORDER BY amount DESC, lead) AS rk, count(*) OVER (PARTITION BY d) AS n FROM leads) SELECT lead, CASE WHEN rk<=0.2*n THEN 'A' WHEN rk<=0.5*n THEN 'B' WHEN rk<=0.8*n THEN 'C' ELSE 'D' END AS band FROM r")
def tk02(t: Tables) -> DataFrame:
    share = F.row_number().over(Window.partitionBy("d").orderBy(F.desc("amount"), "lead")) / F.count("*").over(Window.partitionBy("d"))
    return leads(t).select("lead", share.alias("share")).select("lead", first_of((F.col("share") <= 0.2, "A"), (F.col("share") <= 0.5, "B"), (F.col("share") <= 0.8, "C"), otherwise="D").alias("band"))


@query("tk03_cohort_select", f"WITH {LEADS} SELECT lead, amount FROM leads ORDER BY amount DESC, d, lead LIMIT 100")
def tk03(t: Tables) -> DataFrame:
    return leads(t).orderBy(F.desc("amount"), "d", "lead").limit(100).select("lead", "amount")


@query("tk04_decision_queue", f"WITH {LEADS}, {CONV} SELECT lead, row_number() OVER (PARTITION BY project ORDER BY CASE status WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, converted DESC NULLS LAST, amount DESC, lead) AS place FROM leads LEFT JOIN conv USING (lead)")
def tk04(t: Tables) -> DataFrame:
    order = Window.partitionBy("project").orderBy(first_of((F.col("status") == "P", 1), (F.col("status") == "O", 2), otherwise=3), F.col("converted").desc_nulls_last(), F.desc("amount"), "lead")
    return leads(t).join(conversions(t), "lead", "left").select("lead", F.row_number().over(order).cast("long").alias("place"))


@query("tk05_lift_at_k", f"WITH {LEADS}, r AS (SELECT project, amount>100000 AS hit, row_number() OVER (PARTITION BY project ORDER BY amount%1000 DESC, lead) AS rk FROM leads) SELECT project, round(avg(hit::INT) FILTER (rk<=50),8) AS precision_50, round(sum(hit::INT) FILTER (rk<=50)/nullif(sum(hit::INT)::DOUBLE,0),8) AS recall_50, round(avg(hit::INT) FILTER (rk<=50)/nullif(avg(hit::INT),0),8) AS lift_50 FROM r GROUP BY 1")
def tk05(t: Tables) -> DataFrame:
    w = Window.partitionBy("project").orderBy((F.col("amount") % 1000).desc(), "lead")
    r = leads(t).select("project", (F.col("amount") > 100000).cast("int").alias("hit"), F.row_number().over(w).alias("rk"))
    top = F.when(F.col("rk") <= 50, F.col("hit"))
    return r.groupBy("project").agg(F.round(F.avg(top), 8).alias("precision_50"), F.round(ratio(F.sum(top), F.sum("hit")), 8).alias("recall_50"), F.round(ratio(F.avg(top), F.avg("hit")), 8).alias("lift_50"))


@query("tk07_best_match", "WITH m AS (SELECT c_custkey, s_suppkey, abs(round(c_acctbal-s_acctbal,2)) AS gap FROM customer JOIN supplier ON c_nationkey=s_nationkey) SELECT c_custkey, s_suppkey, gap FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY gap, s_suppkey DESC) r FROM m) WHERE r=1")
def tk07(t: Tables) -> DataFrame:
    """Each customer's supplier of the same nation with the nearest balance, the larger key of ties: two as-of joins by balance, from below and from above, instead of all pairs of a nation."""
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), cents("c_acctbal").alias("at"), (-cents("c_acctbal")).alias("down"))
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("nation"), cents("s_acctbal").alias("when")).agg(F.max("s_suppkey").alias("s_suppkey")).withColumn("own", F.col("when"))
    below = as_of_before(customers, suppliers, ["nation"], "at", "when", ["s_suppkey", "own"], strict=False).withColumnsRenamed({"s_suppkey": "k1", "own": "o1"})
    both = as_of_before(below, suppliers.withColumn("when", -F.col("when")), ["nation"], "down", "when", ["s_suppkey", "own"], strict=False)
    gap1, gap2 = F.col("at") - F.col("o1"), F.col("own") - F.col("at")
    first = F.col("s_suppkey").isNull() | (gap1 < gap2) | ((gap1 == gap2) & (F.col("k1") > F.col("s_suppkey")))
    first = F.col("k1").isNotNull() & first
    return both.where("k1 is not null or s_suppkey is not null").select("c_custkey", F.when(first, F.col("k1")).otherwise(F.col("s_suppkey")).alias("s_suppkey"), F.round(F.when(first, gap1).otherwise(gap2) / 100, 2).alias("gap"))


@query("set04_changed_rows", "WITH a AS (SELECT p_partkey AS k, p_size AS s FROM part WHERE p_partkey%10<>1), z AS (SELECT p_partkey AS k, p_size+(p_partkey%7=0)::INT AS s FROM part WHERE p_partkey%10<>2) SELECT z.k, z.s, 'CAMBIO' AS what FROM z LEFT JOIN a ON a.k=z.k WHERE a.k IS NULL OR a.s IS DISTINCT FROM z.s UNION ALL SELECT a.k, NULL, 'BAJA' FROM a LEFT JOIN z ON a.k=z.k WHERE z.k IS NULL")
def set04(t: Tables) -> DataFrame:
    a = t.part.where("p_partkey % 10 <> 1").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("old"), F.lit(True).alias("had"))
    z = t.part.where("p_partkey % 10 <> 2").select(F.col("p_partkey").alias("k"), (F.col("p_size") + (F.col("p_partkey") % 7 == 0).cast("int")).alias("s"), F.lit(True).alias("has"))
    j = a.join(z, "k", "full_outer").where(F.col("had").isNull() | F.col("has").isNull() | ~F.col("old").eqNullSafe(F.col("s")))
    return j.select("k", "s", F.when(F.col("has").isNull(), "BAJA").otherwise("CAMBIO").alias("what"))


@query("set05_comparable_union", f"WITH {PM} SELECT project, month, sales, 'OBSERVADO' AS evidence FROM pm UNION ALL SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE), count(*), 'INFERIDO' FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1,2")
def set05(t: Tables) -> DataFrame:
    a = project_months(t).select("project", "month", "sales", F.lit("OBSERVADO").alias("evidence"))
    return a.unionByName(leads(t).groupBy("project", month_of(F.col("d")).alias("month")).agg(F.count("*").alias("sales")).withColumn("evidence", F.lit("INFERIDO")))
