"""Queries that run the streaming jobs over the given tables, and the remaining sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import series
from ..registry import Tables, query
from ..session import ship_code
from ..sources import ingest
from ..streaming import exports, messages, streams
from .mapping import KINDS, LEDGER, PM, project_months


def event_stream(t: Tables) -> DataFrame:
    return streams.file_stream(t.events, f"{t.folder}/events.parquet")


@query("st01_upsert_stream", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r=1")
def st01(t: Tables) -> DataFrame:
    return streams.upsert_stream(event_stream(t), ["user_id"], "ts", F.col("ts").desc_nulls_last(), F.col("event_id").desc()).select("user_id", "event_id", "event_type")


@query("st02_ledger_stream", f"WITH RECURSIVE {LEDGER} SELECT unit, event_id, kind, before_state, after_state, applied FROM ledger")
def st02(t: Tables) -> DataFrame:
    ship_code(t.spark)
    kinds = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    rows = event_stream(t).where(F.col("event_type").isin(*KINDS)).select(F.col("user_id").alias("unit"), "event_id", "ts", kinds[F.col("event_type")].alias("kind"))
    return streams.run_to_table(streams.ledger_stream(rows))


@query("st01_bucket_upsert", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r=1")
def st01_buckets(t: Tables) -> DataFrame:
    """The same into hash buckets, of which a batch rewrites only those it touches."""
    return exports.upsert_buckets(event_stream(t), ["user_id"], F.col("ts").desc_nulls_last(), F.col("event_id").desc()).read().select("user_id", "event_id", "event_type")


def disordered(t: Tables, days: int = 5, rows_of_file: int = 1_000_000) -> tuple[str, int]:
    """(folder, files of a step): the process events in steps of so many days, an event up to two days late; then a mark far ahead that says that no more come.

    A step has the same number of files as the others, so that a batch of so many is one step; no file is made of all rows by one task.
    """
    path, staged = streams.shared(t.spark, "disorder"), streams.shared(t.spark, "steps")
    kinds = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    rows = t.events.where(F.col("event_type").isin(*KINDS)).select(F.col("user_id").alias("unit"), "event_id", F.col("ts").cast("timestamp").alias("ts"), kinds[F.col("event_type")].alias("kind"))
    late = F.unix_date(F.to_date("ts")) + F.pmod(F.xxhash64("event_id"), F.lit(3))
    rows.withColumn("step", F.floor(late / days)).write.partitionBy("step").parquet(staged)
    rows = t.spark.read.schema("unit long, event_id long, ts timestamp, kind string, step long").parquet(staged)
    steps = dict(rows.groupBy("step").count().collect())  # one for each step of days
    files = 1 + min(steps.values(), default=0) // rows_of_file
    for step in sorted(steps):
        rows.where(F.col("step") == step).drop("step").repartition(files).write.mode("append").parquet(path)
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).select(F.lit(-1).cast("long").alias("unit"), F.lit(-1).cast("long").alias("event_id"), "ts", F.lit("END").alias("kind"))
    end.coalesce(1).write.mode("append").parquet(path)
    return path, files


@query("st02_disordered_ledger", f"WITH RECURSIVE {LEDGER} SELECT unit, event_id, kind, before_state, after_state, applied FROM ledger")
def st02_disorder(t: Tables) -> DataFrame:
    """The ledger of events that come in files, late by up to two days, also across files."""
    ship_code(t.spark)
    path, files = disordered(t)
    with exports.rocks_state(t.spark):
        stream = t.spark.readStream.schema("unit long, event_id long, ts timestamp, kind string").option("maxFilesPerTrigger", files).parquet(path)
        return streams.run_to_table(exports.ledger_under_disorder(stream, "3 days"))


def timed(df: DataFrame) -> DataFrame:
    return df.withColumn("at", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(conv_id * 60 + turn * 7 as int), 0)"))


@query("st03_conversation_reactions", "WITH x AS (SELECT a.conv_id, a.turn AS announcement, b.turn AS answer, b.turn%4=1 AS explicit, (b.turn-a.turn)*7*60 AS s, a.turn=(b.turn//3)*2 AS named FROM conversations a JOIN conversations b ON a.conv_id=b.conv_id AND a.turn%2=0 AND b.turn%2=1 AND b.turn>a.turn), e AS (SELECT conv_id, announcement, answer, 'EXPLICIT' AS how FROM x WHERE explicit AND named AND s<=86400), i AS (SELECT conv_id, min(announcement) AS announcement, answer, 'INTERVAL' AS how FROM x WHERE NOT explicit AND s<=900 GROUP BY conv_id, answer HAVING count(*)=1) SELECT * FROM e UNION ALL SELECT * FROM i")
def st03(t: Tables) -> DataFrame:
    """Even turns announce, odd ones answer; every other answer names the announcement that it means."""
    rows = timed(streams.file_stream(t.conversations, f"{t.folder}/conversations.parquet"))
    a = rows.where("turn % 2 = 0").select("conv_id", F.col("turn").alias("announcement"), F.col("at").alias("said_at"))
    named = F.when(F.col("turn") % 4 == 1, F.floor(F.col("turn") / 3) * 2)
    b = rows.where("turn % 2 = 1").select("conv_id", F.col("turn").alias("answer"), "at", named.alias("named"))
    return streams.single_reactions(streams.run_to_table(streams.reactions(a, b)))


@query("st04_append_only_guard", "WITH m AS (SELECT max(conv_id)//2 AS m FROM conversations) SELECT count(*) FILTER (conv_id>m) AS suffix, count(*) FILTER (conv_id<=m AND turn=0 AND conv_id%50=0) AS changed FROM conversations, m")
def st04(t: Tables) -> DataFrame:
    """The first half of the conversations was known, and some openings read otherwise then."""
    rows = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("ordinal"), "conv_id", "turn", "text")
    half = t.conversations.agg(F.floor(F.max("conv_id") / 2).alias("half"))
    known = rows.crossJoin(F.broadcast(half)).where("conv_id <= half").withColumn("text", F.when((F.col("turn") == 0) & (F.col("conv_id") % 50 == 0), F.concat("text", F.lit("!"))).otherwise(F.col("text"))).drop("half")
    changed, suffix = streams.append_only(known, rows, "ordinal", "text")
    return suffix.agg(F.count("*").alias("suffix")).crossJoin(changed.agg(F.count("*").alias("changed")))


@query("st04_guarded_exports", "WITH h AS (SELECT conv_id, max(turn)//2 AS half FROM conversations GROUP BY 1) SELECT count(*) AS loaded, count(DISTINCT conv_id) AS sources, TRUE AS refused, count(*) FILTER (turn<=half) AS kept_by_refused FROM conversations JOIN h USING (conv_id)")
def st04_guard(t: Tables) -> DataFrame:
    """Two exports, the second longer, are loaded; into another table the second comes with an opening that reads otherwise, and is refused as a whole."""
    rows = t.conversations.select(F.col("conv_id").alias("source"), (F.col("turn") + 1).cast("long").alias("place"), "role", "text")
    half = rows.groupBy(F.col("source").alias("of")).agg(F.floor((F.max("place") - 1) / 2).alias("half"))
    first = rows.join(half, F.col("source") == F.col("of")).where("place - 1 <= half").select(*rows.columns)
    changed = rows.withColumn("text", F.when(F.col("place") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    found = []
    for second in (rows, changed):
        path = streams.shared(t.spark, "export")
        for export in (first, second):
            export.coalesce(1).write.mode("append").parquet(path)
        stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        table, why = exports.load_exports(stream, "source", "place", ["role", "text"])
        found.append((table.read(rows.schema), why))
    (whole, _), (kept, why) = found
    return whole.agg(F.count("*").alias("loaded"), F.count_distinct("source").alias("sources")).withColumn("refused", F.lit(why is not None)).crossJoin(kept.agg(F.count("*").alias("kept_by_refused")))


@query("st05_windowed_counts", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1,2")
def st05(t: Tables) -> DataFrame:
    rows = event_stream(t).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = streams.run_to_table(streams.windowed_counts(rows, "ts", "1 day", "event_type"), "complete")
    return counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("st06_message_events", "WITH x AS (SELECT conv_id, turn, unnest([{'event':'QUESTION','mentions':len(regexp_extract_all(text,'\\?'))},{'event':'NUMBER','mentions':len(regexp_extract_all(text,'\\d+'))},{'event':'LIST','mentions':len(regexp_extract_all(text,','))}]) AS e FROM conversations) SELECT conv_id, turn, e.event AS event, CAST(e.mentions AS INTEGER) AS mentions, 'v1' AS rules_version FROM x WHERE e.mentions>0")
def st06(t: Tables) -> DataFrame:
    return streams.run_to_table(streams.message_events(streams.file_stream(t.conversations, f"{t.folder}/conversations.parquet")))


CHAT = ("Sala: {n} visitas", "feria, 3 a {n} visitas", "Ayer en sala {n} atendidos", "hoy no hubo visitas", "Separación dpto {u}, precio de lista", "El cliente firmó la minuta", "Unidad {u} bloqueada: no ofrecer", "Felicitaciones por la separación del dpto {u}", "{n} citas para hoy", "Error en CRM desde las 9")
CHAT_SQL = """WITH c AS (SELECT o_orderkey AS message_id, CAST(o_orderdate AS DATE) AS d, o_orderkey%10 AS k, CAST(5+o_orderkey%90 AS INTEGER) AS n, CAST(100+o_orderkey%900 AS VARCHAR) AS u FROM orders),
 e AS (SELECT *, CASE k WHEN 0 THEN 'visita_reporte' WHEN 1 THEN 'visita_reporte' WHEN 2 THEN 'visita_reporte' WHEN 3 THEN 'visita_reporte' WHEN 4 THEN 'separacion_anuncio' WHEN 5 THEN 'minuta_reporte' WHEN 6 THEN 'bloqueo_stock' WHEN 8 THEN 'cita_reporte' WHEN 9 THEN 'incidencia_crm' END AS event FROM c WHERE k<>7)
 SELECT message_id, 1 AS event_index, event, CASE WHEN k=2 THEN d-1 ELSE d END AS reported_on, CASE WHEN k IN (0,2) THEN 'sala' WHEN k=1 THEN 'feria' END AS venue, CASE WHEN k IN (0,2) THEN n WHEN k=1 THEN 3 WHEN k=3 THEN 0 END AS count_min, CASE WHEN k IN (0,1,2) THEN n WHEN k=3 THEN 0 END AS count_max, CASE WHEN k IN (1,8) THEN 'baja' ELSE 'media' END AS confidence, k IN (1,3,5,8) AS review, CASE k WHEN 0 THEN 'unidad_explicita' WHEN 1 THEN 'unidad_explicita' WHEN 2 THEN 'atenciones_explicitas' WHEN 3 THEN 'sin_visitas' WHEN 4 THEN 'anuncio_chat_no_crm' WHEN 5 THEN 'verificar_en_crm' WHEN 8 THEN 'cita_no_equivale_a_visita' ELSE 'senal_operativa' END AS note, CASE WHEN k=4 THEN u END AS unit_code, 2 AS ruleset FROM e"""


@query("st06_commercial_events", CHAT_SQL)
def st06_commercial(t: Tables) -> DataFrame:
    """What messages report, of a stream of messages that the orders' sellers write."""
    key = F.col("o_orderkey")
    n, u = (5 + key % 90).cast("string"), (100 + key % 900).cast("string")
    said = F.element_at(F.array(*map(F.lit, CHAT)), (key % 10 + 1).cast("int"))
    rows = streams.file_stream(t.orders, f"{t.folder}/orders.parquet").select(key.alias("message_id"), F.col("o_orderdate").alias("sent_at"), F.col("o_orderpriority").alias("sender"), F.replace(F.replace(said, F.lit("{n}"), n), F.lit("{u}"), u).alias("body"))
    return streams.run_to_table(messages.commercial_events(rows))


@query("st07_parse_chat_lines", "WITH m AS (SELECT CAST(conv_id AS VARCHAR) AS source, turn+1 AS ordinal, role AS sender, '2024-01-01 10:'||lpad(CAST(turn%60 AS VARCHAR),2,'0') AS sent_at, replace(text, chr(10), chr(10)||'  ') AS body FROM conversations), a AS (SELECT *, row_number() OVER (PARTITION BY source, sent_at, sender, body ORDER BY ordinal) AS again FROM m) SELECT source, ordinal, sender, sent_at, body, sha256(concat_ws('|', source, sent_at, sender, body, CAST(again AS VARCHAR))) AS message_id FROM a")
def st07(t: Tables) -> DataFrame:
    """Writes each message as a header line and its further lines, and puts the messages together again."""
    stamp = F.concat(F.lit("[2024-01-01 10:"), F.lpad((F.col("turn") % 60).cast("string"), 2, "0"), F.lit("] "), "role", F.lit(": "))
    pieces = t.conversations.select(F.col("conv_id").cast("string").alias("source"), "turn", F.posexplode(F.split("text", "\n")).alias("k", "line"), stamp.alias("stamp"))
    text = F.when(F.col("k") == 0, F.concat("stamp", "line")).otherwise(F.concat(F.lit("  "), "line"))
    lines = pieces.select("source", (F.col("turn") * 100_000 + F.col("k")).alias("line_no"), text.alias("text"))
    return streams.parse_chat_lines(lines).select("source", "ordinal", "sender", "sent_at", "body", "message_id")


@query("src04_replace_full", "SELECT c_custkey AS k, c_acctbal*2 AS v FROM customer WHERE c_acctbal>0")
def src04(t: Tables) -> DataFrame:
    """The second table is made from the first, which it replaces."""
    path = streams.shared(t.spark, "full")
    ingest.replace_full(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v")), path)
    ingest.replace_full(t.spark.read.parquet(path).where("v > 0").select("k", (F.col("v") * 2).alias("v")), path)
    return t.spark.read.parquet(path)


UNITS_CSV = "WITH x AS (SELECT 'U-'||c_custkey AS code, CASE WHEN c_custkey%25=1 THEN c_custkey-1 WHEN c_custkey%40=2 THEN NULL ELSE c_custkey END AS id, CASE WHEN c_custkey%3=0 THEN 'Departamento '||c_custkey ELSE trim(c_name) END AS name, c_nationkey AS nation FROM customer), z AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM x)"


def units_csv(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, rows, rejected): a file with headers under other names, some ids missing or written twice, some names to derive."""
    path, k = streams.shared(t.spark, "csv"), F.col("c_custkey")
    unit = F.when(k % 25 == 1, k - 1).when(k % 40 == 2, F.lit(None)).otherwise(k)
    name = F.when(k % 3 == 0, F.lit("  ")).otherwise(F.col("c_name"))
    t.customer.select(F.concat(F.lit("U-"), k).alias("Código"), unit.alias(" ID "), name.alias(" Nombre "), F.lit("Departamento").alias("tipo"), F.col("c_nationkey").alias("PAIS")).write.option("header", True).csv(path)
    raw = t.spark.read.option("header", True).csv(path)
    aliases = {"code": ["codigo", "código", "codigo_unidad"], "id": ["id"], "name": ["nombre", "unidad"], "nation": ["pais"], "kind": ["tipo"]}
    number = F.when(F.col("code").rlike(r"-\d+$"), F.substring_index("code", "-", -1)).otherwise(F.col("code"))
    rows, rejected = ingest.canonical_rows(raw, aliases, ["code", "id"], ["code", "id", "name"], {"name": F.concat_ws(" ", F.coalesce("kind", F.lit("Unidad")), number)})
    return raw, rows, rejected


@query("src09_csv_canonical_load", f"{UNITS_CSV} SELECT code, CAST(id AS BIGINT) AS id, name, nation FROM z WHERE id IS NOT NULL AND n=1")
def src09(t: Tables) -> DataFrame:
    """The accepted rows, by canonical names; blank names are derived from kind and code."""
    return units_csv(t)[1].select("code", F.col("id").try_cast("long").alias("id"), "name", F.col("nation").try_cast("int").alias("nation"))


@query("src09_load_gate", f"{UNITS_CSV} SELECT count(*) AS read, count(*) FILTER (id IS NOT NULL AND n=1) AS loaded, count(*) FILTER (id IS NULL) AS missing, count(*) FILTER (id IS NOT NULL AND n>1) AS duplicate, count(*) FILTER (id IS NOT NULL AND n=1)=count(*) AS passes FROM z")
def src09_gate(t: Tables) -> DataFrame:
    """A load passes only if all rows that were read were loaded."""
    raw, rows, rejected = units_csv(t)
    counts = raw.agg(F.count("*").alias("read")).crossJoin(rows.agg(F.count("*").alias("loaded")))
    reason = lambda r: F.count_if(F.exists("reasons", lambda x: x.startswith(r)))
    return counts.crossJoin(rejected.agg(reason("MISSING").alias("missing"), reason("DUPLICATE").alias("duplicate"))).withColumn("passes", F.col("read") == F.col("loaded"))


def offers_csv(t: Tables) -> tuple[DataFrame, DataFrame]:
    path, k = streams.shared(t.spark, "contract"), F.col("o_orderkey")
    price = F.when(k % 10 == 0, F.lit("n/a")).when(k % 11 == 0, F.lit("-5")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(k % 13 == 0, F.lit("2024-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    since = F.when(k % 17 == 0, F.lit("2024-01-01T00:00:00")).otherwise(F.lit("2024-01-01T00:00:00Z"))
    kind = F.when(k % 19 == 0, F.lit("OTRO")).otherwise(F.lit("LISTA"))
    t.orders.select(k.alias("unit"), kind.alias("kind"), day.alias("day"), since.alias("since"), price.alias("price"), F.lit("").alias("discount")).write.option("header", True).csv(path)
    raw = t.spark.read.option("header", True).schema("unit string, kind string, day string, since string, price string, discount string").csv(path)
    rules = {"kind": F.col("kind").isin("LISTA", "OFERTADO", "CIERRE"), "price": F.col("price") > 0}
    return ingest.contract_rows(raw, ["day"], ["since"], ["price", "discount"], ["discount"], rules)


@query("src10_contract_csv", "WITH x AS (SELECT o_orderkey AS k, list_filter([CASE WHEN o_orderkey%13=0 THEN 'INVALID:day' END, CASE WHEN o_orderkey%17=0 THEN 'INVALID:since' END, CASE WHEN o_orderkey%10=0 THEN 'INVALID:price' END, CASE WHEN o_orderkey%19=0 THEN 'RULE:kind' END, CASE WHEN o_orderkey%10<>0 AND o_orderkey%11=0 THEN 'RULE:price' END], lambda v: v IS NOT NULL) AS r FROM orders) SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN len(r)>0 THEN r ELSE ['ACCEPTED'] END) AS reason FROM x) GROUP BY 1")
def src10(t: Tables) -> DataFrame:
    """Why rows are split out: what doesn't parse strictly, what lacks a zone, and what breaks a rule of the domain."""
    rows, rejected = offers_csv(t)
    why = rejected.select(F.explode("reasons").alias("reason")).unionByName(rows.select(F.lit("ACCEPTED").alias("reason")))
    return why.groupBy("reason").agg(F.count("*").alias("n"))


@query("src10_key_conflicts", "WITH x AS (SELECT o_orderkey AS k FROM orders) SELECT count(*) FILTER (k%5=0) AS added, count(*) FILTER (k%5<>0 AND k%7=0) AS conflicts FROM x")
def src10_conflicts(t: Tables) -> DataFrame:
    """A key with other content is a conflict, one with the same content is left, and new keys are added."""
    price = F.col("o_totalprice")
    batch = t.orders.select(F.col("o_orderkey").alias("k"), F.when((F.col("o_orderkey") % 7 == 0) & (F.col("o_orderkey") % 5 != 0), price + 1).otherwise(price).alias("price"))
    target = t.orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), price.alias("price"))
    added, conflicts = ingest.append_new_keys(target, batch.unionByName(batch), ["k"])
    return added.agg(F.count("*").alias("added")).crossJoin(conflicts.agg(F.count("*").alias("conflicts")))


@query("src16_mart_sink", f"WITH {PM} SELECT project, month, CASE WHEN month=DATE '2000-01-01' AND project%2=0 THEN -sales ELSE sales+(month=DATE '1999-01-01')::BIGINT END AS sales FROM pm UNION ALL SELECT 1000+project, month, -sales FROM pm WHERE month=DATE '2000-01-01' AND project%2=0")
def src16(t: Tables) -> DataFrame:
    """Rewrites one partition of the mart, then upserts rows of another by (month, project), and leaves the rest."""
    path, pm = streams.shared(t.spark, "mart"), project_months(t).select("project", "month", "sales")
    ingest.write_partitions(pm, path, "month")
    ingest.write_partitions(pm.where("month = '1999-01-01'").withColumn("sales", F.col("sales") + 1), path, "month")
    some = pm.where("month = '2000-01-01' and project % 2 = 0").withColumn("sales", -F.col("sales"))
    ingest.upsert_partitions(some.unionByName(some.withColumn("project", F.col("project") + 1000)), path, "month", ["project"])
    return t.spark.read.schema("project int, sales long, month date").parquet(path).select("project", "month", "sales")


@query("udf04_grouped_series", f"WITH {PM} SELECT project, count(*) AS n, round(sum(sales*sales)/CAST(count(*) AS DOUBLE),4) AS power FROM pm GROUP BY 1")
def udf04(t: Tables) -> DataFrame:
    return project_months(t).groupBy("project").agg(F.count("*").alias("n"), F.round(F.sum(F.col("sales") * F.col("sales")) / F.count("*"), 4).alias("power"))


@query("udf04_series_profile")
def udf04_profile(t: Tables) -> DataFrame:
    """What each project's months look like and which models they are enough for."""
    ship_code(t.spark)
    return series.profiles(project_months(t), "project", "month", "sales")
