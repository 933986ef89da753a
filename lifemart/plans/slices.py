"""Stock and absorption by unit type, cycles by evidence, and lead evidence of every scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..functions.text import business_date
from ..operators import absorption
from ..operators.history import Past, with_past
from ..operators.temporal import as_of_before, first_after, latest
from ..registry import Tables, query
from .ledger import ledger
from .mapping import LEDGER, PE, process_events
from .marts import LC, lead_conversions

TYPES = ("DEPARTAMENTO", "ESTACIONAMIENTO", "DEPOSITO", "LOCAL")
TYPE_SQL = f"CASE unit%7 {' '.join(f'WHEN {i} THEN {chr(39)}{k}{chr(39)}' for i, k in enumerate(TYPES))} ELSE '{TYPES[0]}' END"


def unit_kind():
    """The type of a unit: a dimension of the units, of which the given tables have none."""
    code = F.col("unit") % 7
    return first_of(*((code == i, k) for i, k in enumerate(TYPES)), otherwise=TYPES[0])


def typed_stock(t: Tables) -> DataFrame:
    return absorption.daily_stock(ledger(t).withColumn("kind_of_unit", unit_kind()), ["project", "kind_of_unit"])


TYPED = f"""{LEDGER}, lt AS MATERIALIZED (SELECT *, {TYPE_SQL} AS kind_of_unit FROM ledger WHERE applied),
mv AS (SELECT project, kind_of_unit, d AS day, count(*) FILTER (kind='ALTA') AS entries, count(*) FILTER (kind='SEPARACION') AS reservations, count(*) FILTER (kind='CAIDA') AS falls, count(*) FILTER (kind='VENTA') AS sales, sum(delta_stock) AS delta_stock, sum((after_state='SEPARATED')::INT-(before_state='SEPARATED')::INT) AS delta_reserved, sum((after_state='SOLD')::INT-(before_state='SOLD')::INT) AS delta_sold FROM lt GROUP BY 1,2,3),
dy AS (SELECT project, kind_of_unit, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT project, kind_of_unit, min(day) AS lo, max(day) AS hi FROM mv GROUP BY 1,2)),
ts AS MATERIALIZED (SELECT project, kind_of_unit, day, coalesce(entries,0) AS entries, coalesce(reservations,0) AS reservations, coalesce(falls,0) AS falls, coalesce(sales,0) AS sales, CAST(coalesce(delta_stock,0) AS BIGINT) AS delta_stock, CAST(sum(coalesce(delta_stock,0)) OVER w AS BIGINT) AS closing, CAST(sum(coalesce(delta_reserved,0)) OVER w AS BIGINT) AS reserved, CAST(sum(coalesce(delta_sold,0)) OVER w AS BIGINT) AS sold FROM dy LEFT JOIN mv USING (project, kind_of_unit, day) WINDOW w AS (PARTITION BY project, kind_of_unit ORDER BY day))"""


@query("dp07_daily_stock_by_type", f"WITH RECURSIVE {TYPED} SELECT project, kind_of_unit, day, closing-delta_stock AS opening, entries, reservations, falls, sales, delta_stock, closing, reserved, sold FROM ts")
def dp07_types(t: Tables) -> DataFrame:
    return typed_stock(t)


def span_sql(n: int) -> str:
    return f"""SELECT project, kind_of_unit, day, {n} AS days, closing, (closing-delta_stock+closing)/2.0::DOUBLE AS mean_stock, CAST(g AS BIGINT) AS gross, CAST(f AS BIGINT) AS fallen, CAST(g-f AS BIGINT) AS net, CAST(s AS BIGINT) AS sales, start, round(g/nullif(CAST(start AS DOUBLE),0),6) AS gross_rate, round((g-f)/nullif(CAST(start AS DOUBLE),0),6) AS net_rate, round(s/nullif(CAST(g AS DOUBLE),0),6) AS conversion, round(f/nullif(CAST(g AS DOUBLE),0),6) AS fall_rate, round(s/{n}.0::DOUBLE,6) AS velocity, round(closing/nullif(CAST(s AS DOUBLE),0)*{n}/30,6) AS months_of_stock
 FROM (SELECT *, sum(reservations) OVER w AS g, sum(falls) OVER w AS f, sum(sales) OVER w AS s, lag(closing,{n}) OVER (PARTITION BY project, kind_of_unit ORDER BY day) AS start FROM ts WINDOW w AS (PARTITION BY project, kind_of_unit ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))"""


def rounded(rows: DataFrame) -> DataFrame:
    rates = {"gross_rate", "net_rate", "conversion", "fall_rate", "velocity", "months_of_stock"}
    return rows.select(*(F.round(c, 6).alias(c) if c in rates else F.col(c) for c in rows.columns))


@query("wn02_absorption_by_type", f"WITH RECURSIVE {TYPED} {' UNION ALL '.join(map(span_sql, (7, 30, 90)))}")
def wn02_types(t: Tables) -> DataFrame:
    """Trailing sums, rates, conversion, velocity and months of stock of each project and unit type."""
    return rounded(absorption.absorption(typed_stock(t), ["project", "kind_of_unit"]))


@query(
    "dp08_current_by_type",
    f"""WITH RECURSIVE {TYPED}, ab AS ({span_sql(30)}), cu AS (SELECT * FROM ab QUALIFY row_number() OVER (PARTITION BY project, kind_of_unit ORDER BY day DESC)=1),
 sn AS (SELECT project, {TYPE_SQL} AS kind_of_unit, count(*) AS n FROM (SELECT project, unit, arg_max(kind, (ts, event_id)) AS stage FROM pe GROUP BY 1,2) WHERE stage IN ('ALTA','CAIDA') GROUP BY 1,2),
 cv AS (SELECT coalesce(c.project,s.project) AS project, coalesce(c.kind_of_unit,s.kind_of_unit) AS kind_of_unit, c.closing AS ledger_stock, s.n AS snapshot_stock, coalesce(c.closing,0)-coalesce(s.n,0) AS gap FROM cu c FULL JOIN sn s ON s.project=c.project AND s.kind_of_unit=c.kind_of_unit)
 SELECT cv.project, cv.kind_of_unit, ledger_stock, snapshot_stock, gap, CASE WHEN ledger_stock IS NULL THEN 'SIN_LEDGER' WHEN snapshot_stock IS NULL THEN 'SIN_SNAPSHOT' WHEN gap=0 THEN 'COMPLETA' WHEN abs(gap)<=0.1*greatest(ledger_stock,snapshot_stock) THEN 'PARCIAL' ELSE 'INSUFICIENTE' END AS quality, day, gross, net, gross_rate, conversion, velocity FROM cv LEFT JOIN cu ON cu.project=cv.project AND cu.kind_of_unit=cv.kind_of_unit""",
)
def dp08_types(t: Tables) -> DataFrame:
    """The last day of each slice over 30 days, and how well its stock agrees with a count of the units' last events."""
    keys = ["project", "kind_of_unit"]
    stock = typed_stock(t)
    stage = process_events(t).groupBy("project", "unit").agg(F.max_by("kind", F.struct("ts", "event_id")).alias("stage"))
    snapshot = stage.where("stage in ('ALTA', 'CAIDA')").groupBy("project", unit_kind().alias("kind_of_unit")).agg(F.count("*").alias("n"))
    now = latest(rounded(absorption.absorption(stock, keys, (30,))), keys, F.col("day").desc()).select(*keys, "day", "gross", "net", "gross_rate", "conversion", "velocity")
    return absorption.coverage(stock, snapshot, keys).join(now, keys, "left")


CUT_OVER = "2024-01-20"
#: Evidence of a sale's date: the last large view of a unit, as text; every tenth says nothing and every seventh is not a date.
EXTRAS_SQL = f"""{PE}, xt AS (SELECT user_id AS unit, event_id, ts, value, CASE WHEN event_id%7=0 THEN '31-02-2024' WHEN event_id%10=0 THEN '' ELSE strftime(CAST(ts AS DATE)+5, '%d-%m-%Y') END AS written, CASE WHEN event_id%7<>0 AND event_id%10<>0 THEN CAST(ts AS DATE)+5 END AS day FROM events WHERE event_type='view'),
mi AS (SELECT unit, day AS minuta, event_id AS extra_id FROM xt WHERE value>=75 QUALIFY row_number() OVER (PARTITION BY unit ORDER BY ts DESC, event_id DESC)=1),
en AS (SELECT unit, min(d) AS entered FROM pe WHERE kind='ALTA' GROUP BY 1),
sb AS (SELECT p.event_id AS cycle, p.unit, p.project, p.d AS reserved_raw, e.entered, greatest(p.d, coalesce(e.entered, p.d)) AS reserved FROM pe p LEFT JOIN en e USING (unit) WHERE kind='SEPARACION'),
cy AS (SELECT s.*, (SELECT min({{'ts': v.ts, 'id': v.event_id, 'd': v.d}}) FROM pe v WHERE v.kind='VENTA' AND v.unit=s.unit AND v.d>=s.reserved) AS v FROM sb s),
fl AS (SELECT s.cycle, min(f.d) AS first_fall, max(f.d) AS last_fall, count(f.event_id) AS falls FROM sb s LEFT JOIN pe f ON f.kind='CAIDA' AND f.unit=s.unit AND f.d>=s.reserved GROUP BY 1),
ev AS (SELECT c.*, v.id AS sale_id, v.d AS signed, CASE WHEN {TYPE_SQL.replace('unit', 'c.unit')}='{TYPES[0]}' THEN m.minuta END AS minuta, first_fall, last_fall, falls FROM cy c JOIN fl USING (cycle) LEFT JOIN mi m ON m.unit=c.unit),
dt AS (SELECT *, coalesce(minuta, CASE WHEN reserved<DATE '{CUT_OVER}' THEN signed END) AS sold, CASE WHEN minuta IS NOT NULL THEN 'FECHA_DE_MINUTA' WHEN reserved<DATE '{CUT_OVER}' AND signed IS NOT NULL THEN 'LEGACY_FECHA_FIRMA' ELSE 'NO_CONFIRMADA' END AS method FROM ev)"""


@query(
    "dp01_evidence_cycle",
    f"WITH {EXTRAS_SQL} SELECT cycle, unit, project, reserved_raw, reserved, reserved>reserved_raw AS adjusted, sale_id, signed, minuta, sold, method, first_fall, last_fall, falls, CASE WHEN sold IS NOT NULL AND (first_fall IS NULL OR sold<=first_fall) THEN 'VENTA' WHEN first_fall IS NOT NULL THEN 'CAIDA' ELSE 'ABIERTA' END AS outcome, CAST(sold-reserved AS INTEGER) AS days_to_sale, CAST(first_fall-reserved AS INTEGER) AS days_to_fall FROM dt",
)
def dp01_evidence(t: Tables, cut_over: str = CUT_OVER) -> DataFrame:
    """Cycles with their sale date by evidence: a written date of the main unit counts first; a signature only for cycles reserved before the cut-over.

    A reservation before its unit came into stock is moved to that day. Sales and falls count from then on: first ones by an as-of join, last ones and
    their number from a unit's falls looked at from the end, so no cycle meets all events of its unit.
    """
    pe = process_events(t)
    entered = pe.where("kind = 'ALTA'").groupBy("unit").agg(F.min("d").alias("entered"))
    base = pe.where("kind = 'SEPARACION'").join(entered, "unit", "left").select(F.col("event_id").alias("cycle"), "unit", "project", F.col("d").alias("reserved_raw"), F.greatest("d", F.coalesce("entered", "d")).alias("reserved"))
    base = base.withColumn("at", F.col("reserved").cast("timestamp_ntz"))
    sold = first_after(base, pe.where("kind = 'VENTA'").select("unit", "ts", F.col("event_id").alias("sale_id"), F.col("d").alias("signed")), ["unit"], "at", "ts", ["sale_id", "signed"])
    rest = Window.partitionBy("unit").orderBy("d").rangeBetween(0, Window.unboundedFollowing)
    falls = pe.where("kind = 'CAIDA'").groupBy("unit", "d").agg(F.count("*").alias("n")).withColumn("d", F.unix_date("d"))
    falls = falls.select("unit", F.col("d").alias("day"), F.sum("n").over(rest).alias("falls"), F.col("d").alias("first_fall"), F.max("d").over(rest).alias("last_fall")).withColumn("when", -F.col("day"))
    both = as_of_before(sold.withColumn("back", -F.unix_date("reserved")), falls, ["unit"], "back", "when", ["first_fall", "last_fall", "falls"], strict=False)
    extra = t.events.where("event_type = 'view' and value >= 75")
    written = F.when(F.col("event_id") % 7 == 0, "31-02-2024").when(F.col("event_id") % 10 == 0, "").otherwise(F.date_format(F.date_add(F.to_date("ts"), 5), "dd-MM-yyyy"))
    minuta = latest(extra.select(F.col("user_id").alias("unit"), "ts", "event_id", written.alias("written")), ["unit"], F.col("ts").desc_nulls_last(), F.col("event_id").desc()).select("unit", business_date(F.col("written")).alias("minuta"))
    rows = both.join(minuta, "unit", "left").withColumn("minuta", F.when(unit_kind() == TYPES[0], F.col("minuta")))
    day = lambda c: F.date_from_unix_date(c).alias(c)
    legacy = F.when(F.col("reserved") < cut_over, F.col("signed"))
    rows = rows.withColumn("sold", F.coalesce("minuta", legacy)).select("cycle", "unit", "project", "reserved_raw", "reserved", "sale_id", "signed", "minuta", "sold", first_of((F.col("minuta").isNotNull(), "FECHA_DE_MINUTA"), (legacy.isNotNull(), "LEGACY_FECHA_FIRMA"), otherwise="NO_CONFIRMADA").alias("method"), day("first_fall"), day("last_fall"), F.coalesce("falls", F.lit(0)).alias("falls"))
    outcome = first_of((F.col("sold").isNotNull() & (F.col("first_fall").isNull() | (F.col("sold") <= F.col("first_fall"))), "VENTA"), (F.col("first_fall").isNotNull(), "CAIDA"), otherwise="ABIERTA")
    return rows.select("*", (F.col("reserved") > F.col("reserved_raw")).alias("adjusted"), outcome.alias("outcome"), F.datediff("sold", "reserved").alias("days_to_sale"), F.datediff("first_fall", "reserved").alias("days_to_fall"))


AS_OF = "2001-10-01"
SCOPES = (("project", "project"), ("advisor", "seller"), ("global", None))


def evidence_sql() -> str:
    span = lambda days, ripe: f"RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND INTERVAL {ripe} DAY PRECEDING"
    parts = []
    for name, scope in SCOPES:
        by = f"PARTITION BY {scope} " if scope else ""
        own = lambda x, scope=scope: f"CASE WHEN {scope} IS NOT NULL THEN {x} END" if scope else x
        if scope:
            parts.append(own(f"count(*) OVER ({by}ORDER BY d {span(90, 1)})") + f" AS {name}_leads_90d")
        parts.append(f"round({own(f'avg(sep_14d) OVER ({by}ORDER BY d {span(90, 14)})')},6) AS {name}_sep_rate_90d")
        parts.append(f"round({own(f'avg(sale_60d) OVER ({by}ORDER BY d {span(180, 60)})')},6) AS {name}_sale_rate_180d")
    return f"""WITH {LC}, l AS (SELECT *, CASE WHEN d+14<=DATE '{AS_OF}' THEN coalesce(days>=0 AND days<14, FALSE)::INT END AS sep_14d, CASE WHEN d+60<=DATE '{AS_OF}' THEN coalesce(days>=0 AND days<60, FALSE)::INT END AS sale_60d FROM lc)
 SELECT lead, sep_14d, sale_60d, CASE WHEN d+60<=DATE '{AS_OF}' THEN 'MATURED' WHEN d+14<=DATE '{AS_OF}' THEN 'SEP_MATURED' ELSE 'PENDING' END AS label_status, count(*) OVER (PARTITION BY client ORDER BY d {span(90, 1)}) AS client_prior_90d, CAST(d-max(d) OVER (PARTITION BY client ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS INTEGER) AS days_since_previous, {', '.join(parts)} FROM l"""


@query("dp42_evidence_scopes", evidence_sql())
def dp42_scopes(t: Tables) -> DataFrame:
    """Labels with their ripeness, and what was known of the client, project, adviser and all when a lead came."""
    days, ripe = F.col("days"), lambda n: F.date_add("d", n) <= AS_OF
    hit = lambda n: F.when(ripe(n), F.coalesce((days >= 0) & (days < n), F.lit(False)).cast("int"))
    rows = lead_conversions(t).select("lead", "client", "project", "seller", "d", hit(14).alias("sep_14d"), hit(60).alias("sale_60d"))
    rows = rows.withColumn("label_status", first_of((ripe(60), "MATURED"), (ripe(14), "SEP_MATURED"), otherwise="PENDING"))
    for name, scope in SCOPES:
        figures = [Past(f"{name}_leads_90d", 90)] if scope else []
        rows = with_past(rows, scope, "d", [*figures, Past(f"{name}_sep_rate_90d", 90, "sep_14d", 14), Past(f"{name}_sale_rate_180d", 180, "sale_60d", 60)])
    own = Window.partitionBy("client").orderBy(F.unix_date("d"))
    rows = rows.withColumns({"client_prior_90d": F.count("*").over(own.rangeBetween(-90, -1)), "days_since_previous": F.datediff("d", F.max("d").over(own.rangeBetween(Window.unboundedPreceding, -1)))})
    return rows.select("lead", "sep_14d", "sale_60d", "label_status", "client_prior_90d", "days_since_previous", *(F.round(c, 6).alias(c) if "rate" in c else F.col(c) for c in rows.columns if c.startswith(("project_", "advisor_", "global_"))))
