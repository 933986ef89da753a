"""Cycles, ledger, daily stock and absorption: queries over process events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of, ratio
from ..operators.ledger import inventory_ledger
from ..operators.temporal import as_of_before, days_affected, first_after, latest, running, trailing
from ..registry import Tables, query
from .mapping import LEDGER, PE, process_events


def ledger(t: Tables) -> DataFrame:
    return inventory_ledger(process_events(t), ["unit", "project"])


def cycles(t: Tables) -> DataFrame:
    """A reservation of a unit, the first sale from then on, and what cancellations follow it."""
    pe = process_events(t)
    base = pe.where("kind = 'SEPARACION'").select(F.col("event_id").alias("cycle"), "unit", "project", F.col("ts").alias("reserved_ts"), F.col("d").alias("reserved"))
    sold = first_after(base, pe.where("kind = 'VENTA'").select("unit", "ts", F.col("event_id").alias("sale_id"), F.col("d").alias("sold")), ["unit"], "reserved_ts", "ts", ["sale_id", "sold"])
    return first_after(sold, pe.where("kind = 'CAIDA'").select("unit", "ts", F.col("event_id").alias("fall_id"), F.col("d").alias("fallen")), ["unit"], "reserved_ts", "ts", ["fall_id", "fallen"])


CYCLES = f"""{PE}, cyc AS (SELECT b.event_id AS cycle, b.unit, b.project, b.ts AS reserved_ts, b.d AS reserved,
 (SELECT min({{'ts': v.ts, 'id': v.event_id, 'd': v.d}}) FROM pe v WHERE v.kind='VENTA' AND v.unit=b.unit AND v.ts>=b.ts) AS v,
 (SELECT min({{'ts': v.ts, 'id': v.event_id, 'd': v.d}}) FROM pe v WHERE v.kind='CAIDA' AND v.unit=b.unit AND v.ts>=b.ts) AS f
 FROM pe b WHERE b.kind='SEPARACION'), cycles AS (SELECT cycle, unit, project, reserved_ts, reserved, v.id AS sale_id, v.d AS sold, f.id AS fall_id, f.d AS fallen FROM cyc)"""
DAYS = """days AS (SELECT project, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT project, min(d) lo, max(d) hi FROM pe GROUP BY 1))"""
MOVES = """moves AS (SELECT project, d AS day, count(*) FILTER (kind='ALTA') AS entries, count(*) FILTER (kind='SEPARACION') AS reservations, count(*) FILTER (kind='VENTA') AS sales, count(*) FILTER (kind='CAIDA') AS falls, CAST(sum(delta_stock) AS BIGINT) AS delta FROM ledger GROUP BY 1,2)"""
STOCK = f"""{LEDGER}, {DAYS}, {MOVES}, stock AS (SELECT project, day, coalesce(entries,0) AS entries, coalesce(reservations,0) AS reservations, coalesce(sales,0) AS sales, coalesce(falls,0) AS falls, coalesce(delta,0) AS delta,
 CAST(sum(coalesce(delta,0)) OVER (PARTITION BY project ORDER BY day) AS BIGINT) AS closing FROM days LEFT JOIN moves USING (project, day))"""


def project_days(t: Tables) -> DataFrame:
    return process_events(t).groupBy("project").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select("project", F.explode(F.sequence("lo", "hi")).alias("day"))


@query("ag01_daily_moves", f"WITH RECURSIVE {LEDGER}, {MOVES} SELECT * FROM moves")
def daily_moves(t: Tables) -> DataFrame:
    n = lambda k: F.count(F.when(F.col("kind") == k, 1))
    return ledger(t).groupBy("project", F.col("d").alias("day")).agg(n("ALTA").alias("entries"), n("SEPARACION").alias("reservations"), n("VENTA").alias("sales"), n("CAIDA").alias("falls"), F.sum("delta_stock").alias("delta"))


@query("dp03_inventory_ledger", f"WITH RECURSIVE {LEDGER} SELECT unit, project, event_id, d, kind, n AS event_order, before_state, after_state, applied, delta_stock FROM ledger")
def dp03(t: Tables) -> DataFrame:
    return ledger(t).select("unit", "project", "event_id", "d", "kind", F.col("event_order").cast("long").alias("event_order"), "before_state", "after_state", "applied", "delta_stock")


@query("dp04_state_current", f"WITH RECURSIVE {LEDGER} SELECT project, after_state, count(*) AS units FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY n DESC) r FROM ledger) WHERE r=1 GROUP BY 1,2")
def dp04(t: Tables) -> DataFrame:
    return latest(ledger(t), ["unit"], F.col("event_order").desc()).groupBy("project", "after_state").agg(F.count("*").alias("units"))


@query("jn01_calendar_moves", f"WITH RECURSIVE {STOCK} SELECT project, day, entries, reservations, sales, falls, delta FROM stock")
def jn01(t: Tables) -> DataFrame:
    names = ["entries", "reservations", "sales", "falls", "delta"]
    return project_days(t).join(daily_moves(t), ["project", "day"], "left").select("project", "day", *(F.coalesce(c, F.lit(0)).alias(c) for c in names))


@query("wn01_running_balance", f"WITH RECURSIVE {STOCK} SELECT project, day, closing-delta AS opening, delta, closing FROM stock")
def stock(t: Tables) -> DataFrame:
    closing = F.sum("delta").over(running(["project"], "day"))
    return jn01(t).select("project", "day", (closing - F.col("delta")).alias("opening"), "delta", closing.alias("closing"))


@query("dp07_daily_stock", f"WITH RECURSIVE {STOCK} SELECT project, day, entries, reservations, sales, falls, closing-delta AS opening, closing, closing<0 AS negative FROM stock")
def dp07(t: Tables) -> DataFrame:
    closing = F.sum("delta").over(running(["project"], "day"))
    return jn01(t).select("project", "day", "entries", "reservations", "sales", "falls", (closing - F.col("delta")).alias("opening"), closing.alias("closing"), (closing < 0).alias("negative"))


def rolled(t: Tables, spans=(7, 30, 90)) -> DataFrame:
    """One row a span of each day; all spans in one sorted pass."""
    base = jn01(t).withColumn("closing", F.sum("delta").over(running(["project"], "day")))
    w = Window.partitionBy("project").orderBy("day")
    sums = [F.struct(F.lit(n).alias("days"), F.sum("reservations").over(over).alias("gross"), F.sum("falls").over(over).alias("falls"), F.lag("closing", n).over(w).alias("start")) for n in spans for over in (trailing(["project"], "day", n),)]
    rows = base.select("project", "day", "closing", *(s.alias(f"s{i}") for i, s in enumerate(sums)))
    rows = rows.select("project", "day", "closing", F.inline(F.array(*(f"s{i}" for i in range(len(sums))))))
    return rows.select("project", "day", "days", "gross", (F.col("gross") - F.col("falls")).alias("net"), F.round(ratio(F.col("gross"), F.col("start")), 6).alias("gross_rate"), F.round(ratio(F.col("falls"), F.col("gross")), 6).alias("fall_rate"), F.round(ratio(F.col("closing"), F.col("gross")) * F.col("days") / 30, 6).alias("months_of_stock"))


def rolled_sql(spans=(7, 30, 90)) -> str:
    one = lambda n: f"""SELECT project, day, {n} AS days, gross, gross-falls_n AS net, round(gross/nullif(CAST(start AS DOUBLE),0),6) AS gross_rate, round(falls_n/nullif(CAST(gross AS DOUBLE),0),6) AS fall_rate, round(closing/nullif(CAST(gross AS DOUBLE),0)*{n}/30,6) AS months_of_stock FROM
 (SELECT project, day, closing, CAST(sum(reservations) OVER w AS BIGINT) AS gross, CAST(sum(falls) OVER w AS BIGINT) AS falls_n, lag(closing,{n}) OVER (PARTITION BY project ORDER BY day) AS start FROM stock WINDOW w AS (PARTITION BY project ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))"""  # noqa: E731
    return " UNION ALL ".join(map(one, spans))


@query("wn02_rolling_absorption", f"WITH RECURSIVE {STOCK} {rolled_sql()}")
def wn02(t: Tables) -> DataFrame:
    return rolled(t)


@query("dp08_daily_absorption", f"WITH RECURSIVE {STOCK}, r AS ({rolled_sql((30,))}) SELECT project, day, gross, net, gross_rate, CASE WHEN gross_rate IS NULL THEN 'SIN_BASE' WHEN gross_rate>=0.5 THEN 'ALTA' ELSE 'NORMAL' END AS quality FROM r")
def dp08(t: Tables) -> DataFrame:
    return rolled(t, (30,)).select("project", "day", "gross", "net", "gross_rate", first_of((F.col("gross_rate").isNull(), "SIN_BASE"), (F.col("gross_rate") >= 0.5, "ALTA"), otherwise="NORMAL").alias("quality"))


@query("jn03_first_sale_after", f"WITH {CYCLES} SELECT cycle, unit, sale_id, sold FROM cycles")
def jn03(t: Tables) -> DataFrame:
    return cycles(t).select("cycle", "unit", "sale_id", "sold")


@query("jn04_falls_after", f"WITH {PE} SELECT b.event_id AS cycle, min(f.d) AS first_fall, max(f.d) AS last_fall, count(f.event_id) AS falls FROM pe b LEFT JOIN pe f ON f.kind='CAIDA' AND f.unit=b.unit AND f.ts>=b.ts WHERE b.kind='SEPARACION' GROUP BY 1")
def jn04(t: Tables) -> DataFrame:
    """By one sorted pass over a unit's events instead of a range join: what lies from a row to the end."""
    rest = Window.partitionBy("unit").orderBy("ts", "event_id").rowsBetween(0, Window.unboundedFollowing)
    fall = F.when(F.col("kind") == "CAIDA", F.col("d"))
    return process_events(t).withColumns({"first_fall": F.min(fall).over(rest), "last_fall": F.max(fall).over(rest), "falls": F.count(fall).over(rest)}).where("kind = 'SEPARACION'").select(F.col("event_id").alias("cycle"), "first_fall", "last_fall", "falls")


@query("jn05_last_price_before", f"WITH {PE}, m AS (SELECT DISTINCT unit, CAST(date_trunc('week', d) AS DATE) AS week FROM pe) SELECT m.unit, m.week, (SELECT max({{'ts': p.ts, 'id': p.event_id, 'v': p.value}}).v FROM pe p WHERE p.unit=m.unit AND p.ts < CAST(m.week AS TIMESTAMP)) AS price FROM m")
def jn05(t: Tables) -> DataFrame:
    pe = process_events(t)
    prices = pe.groupBy("unit", "ts").agg(F.max_by("value", "event_id").alias("price"))
    weeks = pe.select("unit", F.trunc("d", "week").alias("week")).distinct().withColumn("at", F.col("week").cast("timestamp_ntz"))
    return as_of_before(weeks, prices, ["unit"], "at", "ts", ["price"]).select("unit", "week", "price")


@query("jn07_cycles_in_window", f"WITH {PE}, {DAYS} SELECT dd.project, dd.day, count(p.event_id) AS cycles FROM days dd LEFT JOIN pe p ON p.kind='SEPARACION' AND p.project=dd.project AND p.d BETWEEN dd.day - 29 AND dd.day GROUP BY 1,2")
def jn07(t: Tables) -> DataFrame:
    counted = days_affected(process_events(t).where("kind = 'SEPARACION'").groupBy("project", "d").count(), "d", 30).groupBy("project", F.col("counted_on").alias("day")).agg(F.sum("count").alias("cycles"))
    return project_days(t).join(counted, ["project", "day"], "left").select("project", "day", F.coalesce("cycles", F.lit(0)).alias("cycles"))


@query("dp01_commercial_cycle", f"WITH {CYCLES} SELECT cycle, unit, project, reserved, sold, fallen, CASE WHEN sold IS NOT NULL AND (fallen IS NULL OR sold<fallen) THEN 'VENTA' WHEN fallen IS NOT NULL AND (sold IS NULL OR fallen<sold) THEN 'CAIDA' WHEN sold=fallen THEN 'AMBIGUA' ELSE 'ABIERTA' END AS outcome, sold-reserved AS days_to_sale FROM cycles")
def dp01(t: Tables) -> DataFrame:
    sold, fallen = F.col("sold"), F.col("fallen")
    outcome = first_of((sold.isNotNull() & (fallen.isNull() | (sold < fallen)), "VENTA"), (fallen.isNotNull() & (sold.isNull() | (fallen < sold)), "CAIDA"), (sold == fallen, "AMBIGUA"), otherwise="ABIERTA")
    return cycles(t).select("cycle", "unit", "project", "reserved", "sold", "fallen", outcome.alias("outcome"), F.datediff("sold", "reserved").cast("long").alias("days_to_sale"))


LEDGER_CYCLE = f"{LEDGER}, lc AS (SELECT unit, bool_or(kind='VENTA' AND applied) AS sold, bool_or(kind='CAIDA' AND applied) AS fallen, min(d) FILTER (kind='SEPARACION' AND applied) AS first_reserved, min(d) FILTER (kind='VENTA' AND applied) AS first_sold, count(*) FILTER (kind='CAIDA' AND applied) AS falls FROM ledger GROUP BY 1)"


@query("ag02_ledger_cycle", f"WITH RECURSIVE {LEDGER_CYCLE} SELECT * FROM lc")
def ledger_cycle(t: Tables) -> DataFrame:
    on = lambda k: (F.col("kind") == k) & F.col("applied")
    return ledger(t).groupBy("unit").agg(F.bool_or(on("VENTA")).alias("sold"), F.bool_or(on("CAIDA")).alias("fallen"), F.min(F.when(on("SEPARACION"), F.col("d"))).alias("first_reserved"), F.min(F.when(on("VENTA"), F.col("d"))).alias("first_sold"), F.count(F.when(on("CAIDA"), 1)).alias("falls"))


RECON = f"{LEDGER_CYCLE}, docs AS (SELECT unit, min(d) AS doc_sold FROM pe WHERE kind='VENTA' GROUP BY 1), rec AS (SELECT unit, doc_sold, first_sold, CASE WHEN doc_sold IS NULL AND first_sold IS NULL THEN 'SIN_VENTA' WHEN first_sold IS NULL THEN 'SOLO_DOCUMENTO' WHEN doc_sold=first_sold THEN 'CONCILIADO' ELSE 'FECHA_DISTINTA' END AS status FROM lc LEFT JOIN docs USING (unit))"


@query("dp05_reconciled_cycle", f"WITH RECURSIVE {RECON} SELECT unit, doc_sold, first_sold, status, status IN ('SOLO_DOCUMENTO','FECHA_DISTINTA') AS needs_review FROM rec")
def dp05(t: Tables) -> DataFrame:
    docs = process_events(t).where("kind = 'VENTA'").groupBy("unit").agg(F.min("d").alias("doc_sold"))
    a, b = F.col("doc_sold"), F.col("first_sold")
    status = first_of((a.isNull() & b.isNull(), "SIN_VENTA"), (b.isNull(), "SOLO_DOCUMENTO"), (a == b, "CONCILIADO"), otherwise="FECHA_DISTINTA")
    return ledger_cycle(t).join(docs, "unit", "left").select("unit", "doc_sold", "first_sold", status.alias("status")).withColumn("needs_review", F.col("status").isin("SOLO_DOCUMENTO", "FECHA_DISTINTA"))


@query("ag03_reconciliation_summary", f"WITH RECURSIVE {RECON} SELECT status, count(*) AS units, round(100.0*count(*)/sum(count(*)) OVER (),4) AS share FROM rec GROUP BY 1")
def ag03(t: Tables) -> DataFrame:
    counts = dp05(t).groupBy("status").agg(F.count("*").alias("units"))
    return counts.crossJoin(counts.agg(F.sum("units").alias("all"))).select("status", "units", F.round(100.0 * F.col("units") / F.col("all"), 4).alias("share"))


@query("jn02_detail_vs_monthly", f"WITH RECURSIVE {LEDGER}, a AS (SELECT project, count(*) AS detail FROM pe WHERE kind='VENTA' GROUP BY 1), b AS (SELECT project, count(*) AS monthly FROM ledger WHERE kind='VENTA' AND applied GROUP BY 1) SELECT coalesce(a.project,b.project) AS project, coalesce(detail,0) AS detail, coalesce(monthly,0) AS monthly, coalesce(detail,0)-coalesce(monthly,0) AS gap FROM a FULL JOIN b ON a.project=b.project")
def jn02(t: Tables) -> DataFrame:
    detail = process_events(t).where("kind = 'VENTA'").groupBy("project").agg(F.count("*").alias("detail"))
    monthly = ledger(t).where("kind = 'VENTA' and applied").groupBy("project").agg(F.count("*").alias("monthly"))
    a, b = F.coalesce("detail", F.lit(0)), F.coalesce("monthly", F.lit(0))
    return detail.join(monthly, "project", "full_outer").select("project", a.alias("detail"), b.alias("monthly"), (a - b).alias("gap"))


@query("wn06_event_sequence", f"WITH {PE} SELECT event_id, unit, row_number() OVER w AS seq, lag(kind) OVER w AS previous, date_diff('second', lag(date_trunc('second', ts)) OVER w, date_trunc('second', ts)) AS gap_seconds FROM pe WINDOW w AS (PARTITION BY unit ORDER BY ts, event_id)")
def wn06(t: Tables) -> DataFrame:
    w = Window.partitionBy("unit").orderBy("ts", "event_id")
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('second', ts))")
    return process_events(t).withColumn("s", seconds).select("event_id", "unit", F.row_number().over(w).cast("long").alias("seq"), F.lag("kind").over(w).alias("previous"), (F.col("s") - F.lag("s").over(w)).alias("gap_seconds"))


@query("ag21_stock_conservation", f"WITH RECURSIVE {LEDGER}, c AS (SELECT unit, CAST(sum(delta_stock) AS BIGINT) AS balance, count(*) FILTER (kind='ALTA' AND applied) AS entered, count(*) FILTER (kind='CAIDA' AND applied) AS reentered, count(*) FILTER (kind='SEPARACION' AND applied) AS separated FROM ledger GROUP BY 1) SELECT CAST(sum(entered) AS BIGINT) AS entered, count(*) FILTER (balance<0) AS negative, count(*) FILTER (reentered>separated) AS excess_reentry FROM c")
def ag21(t: Tables) -> DataFrame:
    n = lambda k: F.count(F.when((F.col("kind") == k) & F.col("applied"), 1))
    units = ledger(t).groupBy("unit").agg(F.sum("delta_stock").alias("balance"), n("ALTA").alias("entered"), n("CAIDA").alias("reentered"), n("SEPARACION").alias("separated"))
    return units.agg(F.sum("entered").alias("entered"), F.count_if(F.col("balance") < 0).alias("negative"), F.count_if(F.col("reentered") > F.col("separated")).alias("excess_reentry"))


@query("dp06_sales_fact", f"WITH RECURSIVE {LEDGER} SELECT l.unit, l.project, l.d AS sold, p.first_day, p.last_day FROM ledger l JOIN (SELECT project, min(d) AS first_day, max(d) AS last_day FROM ledger GROUP BY 1) p USING (project) WHERE l.kind='VENTA' AND l.applied")
def dp06(t: Tables) -> DataFrame:
    rows = ledger(t)
    period = rows.groupBy("project").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    return rows.where("kind = 'VENTA' and applied").join(period, "project").select("unit", "project", F.col("d").alias("sold"), "first_day", "last_day")


@query("tk01_first_stock_entry", f"WITH {PE} SELECT unit, event_id, d FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY ts, event_id) r FROM pe) WHERE r=1")
def tk01(t: Tables) -> DataFrame:
    return latest(process_events(t), ["unit"], F.col("ts").asc_nulls_last(), F.col("event_id")).select("unit", "event_id", "d")


@query("set01_event_union", f"WITH {PE} SELECT kind, 'EVENTO' AS source, event_id, unit, d FROM pe UNION ALL SELECT 'PEDIDO', 'ORDEN', o_orderkey, o_custkey, CAST(o_orderdate AS DATE) FROM orders")
def set01(t: Tables) -> DataFrame:
    a = process_events(t).select("kind", F.lit("EVENTO").alias("source"), "event_id", "unit", "d")
    b = t.orders.select(F.lit("PEDIDO").alias("kind"), F.lit("ORDEN").alias("source"), F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("unit"), F.to_date("o_orderdate").alias("d"))
    return a.unionByName(b)


@query("set02_affected_keys", f"WITH {PE}, m AS (SELECT max(ts) AS hi FROM pe) SELECT DISTINCT unit FROM pe, m WHERE kind IN ('SEPARACION','VENTA','CAIDA') AND ts >= hi - INTERVAL 48 HOUR")
def set02(t: Tables) -> DataFrame:
    pe = process_events(t)
    since = pe.agg((F.max("ts") - F.expr("INTERVAL 48 HOURS")).alias("since"))
    parts = [pe.where(F.col("kind") == k).crossJoin(F.broadcast(since)).where("ts >= since").select("unit") for k in ("SEPARACION", "VENTA", "CAIDA")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()
