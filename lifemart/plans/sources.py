"""Queries of scans, merges, contracts, text functions and identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators.temporal import latest, month_of
from ..registry import Tables, query
from ..sources import ingest
from ..streaming.streams import shared
from .mapping import LEADS, PM, leads, project_months


@query("src01_scan_since", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01' - INTERVAL 48 HOUR")
def src01(t: Tables) -> DataFrame:
    return ingest.scan_since(t.orders, ["o_orderkey", "o_orderdate"], "o_orderdate", "2000-06-01 00:00:00", "48 HOURS")


@query("src01_initial_scan", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus='F' ORDER BY o_orderdate, o_orderkey LIMIT 5000")
def src01_initial(t: Tables) -> DataFrame:
    """The first load: its own condition, and a batch of 5,000 rows from the oldest on."""
    return ingest.scan_since(t.orders, ["o_orderkey", "o_orderdate"], "o_orderdate", initial_where=F.col("o_orderstatus") == "F", batch=5000, keys=["o_orderkey"])


@query("src02_merge_incremental", "WITH b AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate>=TIMESTAMP '2000-01-01'), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) r FROM b) WHERE r=1) SELECT o_custkey, o_orderkey FROM n UNION ALL SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_orderdate<TIMESTAMP '2000-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM n) GROUP BY 1")
def src02(t: Tables) -> DataFrame:
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    target = t.orders.where(F.col("o_orderdate") < cut).groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    batch = t.orders.where(F.col("o_orderdate") >= cut).select("o_custkey", "o_orderkey", "o_orderdate")
    return ingest.merge_incremental(target.withColumn("o_orderdate", F.lit(None).cast("timestamp_ntz")), batch, ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey")


@query("src03_merge_append", "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS run FROM orders WHERE o_orderdate<TIMESTAMP '2000-01-01' UNION ALL SELECT o_orderkey, 'r1' FROM orders WHERE o_orderdate>=TIMESTAMP '2000-01-01'")
def src03(t: Tables) -> DataFrame:
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    out = ingest.merge_append(t.orders.where(F.col("o_orderdate") < cut), t.orders.where(F.col("o_orderdate") >= cut), "r1", "2024-01-01 00:00:00")
    return out.select("o_orderkey", F.col("_etl_source_run_id").alias("run"))


@query("src05_next_watermark", "SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS watermark, count(*) AS n FROM orders")
def src05(t: Tables) -> DataFrame:
    return t.orders.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("watermark"), F.count("*").alias("n"))


@query("src06_cast_to_contract", "SELECT count(*) FILTER (p_type IS NOT NULL AND try_cast(p_type AS INTEGER) IS NULL) AS p_type, count(*) FILTER (try_cast(p_size AS INTEGER) IS NULL) AS p_size, count(*) FILTER (try_cast(split_part(p_brand,'#',2) AS INTEGER) IS NULL) AS brand_no FROM part")
def src06(t: Tables) -> DataFrame:
    rows = t.part.withColumn("brand_no", F.split_part("p_brand", F.lit("#"), F.lit(2)))
    return ingest.cast_to_contract(rows, {"p_type": "int", "p_size": "int", "brand_no": "int"})[1]


@query("src07_evolve_schema", "SELECT s_suppkey AS k, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src07(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return ingest.evolve_schema(a, t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), ["k"])


@query("src08_key_audit", "SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL) AS null_keys, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*)>1)) AS duplicate_groups, min(l_shipdate) AS min_watermark, max(l_shipdate) AS max_watermark FROM lineitem")
def src08(t: Tables) -> DataFrame:
    return ingest.key_audit(t.lineitem, ["l_orderkey"], "l_shipdate")


@query("src11_multi_source_units", "SELECT 'A-'||c_custkey AS unit_key, 'A' AS source, upper(trim(c_name)) AS name, c_acctbal AS price FROM customer UNION ALL SELECT 'B-'||s_suppkey, 'B', upper(trim(s_name)), s_acctbal FROM supplier")
def src11(t: Tables) -> DataFrame:
    one = lambda df, label, key, name, price: df.select(F.concat(F.lit(label + "-"), F.col(key)).alias("unit_key"), F.lit(label).alias("source"), F.upper(F.trim(name)).alias("name"), F.col(price).alias("price"))
    return one(t.customer, "A", "c_custkey", "c_name", "c_acctbal").unionByName(one(t.supplier, "B", "s_suppkey", "s_name", "s_acctbal"))


@query("src12_unit_dim", "SELECT right(trim(p_brand),2) AS location, count(*) AS reported, count(DISTINCT p_partkey) AS counted, count(*)=count(DISTINCT p_partkey) AS matches FROM part GROUP BY 1")
def src12(t: Tables) -> DataFrame:
    g = t.part.groupBy(F.right(F.trim("p_brand"), F.lit(2)).alias("location")).agg(F.count("*").alias("reported"), F.count_distinct("p_partkey").alias("counted"))
    return g.withColumn("matches", F.col("reported") == F.col("counted"))


@query("src13_sanitized_project_month")
def src13(t: Tables) -> DataFrame:
    """No key leaves in the clear; the hash covers what is published. (HMAC has no SQL twin; tests hold it against Python's.)"""
    rows = project_months(t).select(text.hmac_sha256(b"secret", F.col("project").cast("string")).alias("project_hash"), "month", "sales", "falls")
    return rows.withColumn("content_hash", ingest.row_hash(rows, ["project_hash", "month", "sales", "falls"]))


@query("src14_next_month_pairs", f"WITH {PM} SELECT a.project, a.month, a.sales, b.sales AS next_sales FROM pm a JOIN pm b ON a.project=b.project AND b.month=CAST(a.month + INTERVAL 1 MONTH AS DATE) WHERE a.n_lines>1 AND b.n_lines>1")
def src14(t: Tables) -> DataFrame:
    pm = project_months(t).where("n_lines > 1")
    nxt = pm.select("project", F.add_months("month", -1).alias("month"), F.col("sales").alias("next_sales"))
    return pm.join(nxt, ["project", "month"]).select("project", "month", "sales", "next_sales")


@query("src15_privacy_audit", "SELECT count(*) AS n, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS emails, count(*) FILTER (regexp_matches(text, '\\d{9,}')) AS long_numbers FROM documents")
def src15(t: Tables) -> DataFrame:
    return t.documents.agg(F.count("*").alias("n"), F.count_if(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")).alias("emails"), F.count_if(F.col("text").rlike(r"\d{9,}")).alias("long_numbers"))


@query("src17_incremental_by_hash", "WITH s AS (SELECT c_custkey, c_acctbal+(c_custkey%11=0)::INT AS v FROM customer WHERE c_custkey%13<>1), z AS (SELECT c_custkey, c_acctbal AS v FROM customer WHERE c_custkey%17<>1) SELECT CASE WHEN z.c_custkey IS NULL THEN 'INSERT' WHEN s.c_custkey IS NULL THEN 'DELETE' WHEN s.v<>z.v THEN 'UPDATE' ELSE 'UNCHANGED' END AS what, count(*) AS n FROM s FULL JOIN z ON s.c_custkey=z.c_custkey GROUP BY 1")
def src17(t: Tables) -> DataFrame:
    s = t.customer.where("c_custkey % 13 <> 1").select("c_custkey", (F.col("c_acctbal") + (F.col("c_custkey") % 11 == 0).cast("int")).alias("v"))
    z = t.customer.where("c_custkey % 17 <> 1").select("c_custkey", F.col("c_acctbal").alias("v"))
    return ingest.incremental_by_hash(s, z, ["c_custkey"], ["v"]).groupBy("what").agg(F.count("*").alias("n"))


@query("src18_panel_export", f"WITH {PM} SELECT project, strftime(month, '%Y-%m') AS period, sales, falls FROM pm")
def src18(t: Tables) -> DataFrame:
    """Writes the panel as one folder a project, rows by period, and reads all projects back."""
    panel = project_months(t).select("project", F.date_format("month", "yyyy-MM").alias("period"), "sales", "falls")
    path = ingest.export_by(panel, shared(t.spark, "panel"), "project", "period")
    return t.spark.read.option("header", True).schema("period string, sales long, falls long, project int").csv(path).select("project", "period", "sales", "falls")


@query("src18_one_project", f"WITH {PM} SELECT strftime(month, '%Y-%m') AS period, sales, falls FROM pm WHERE project=(SELECT min(project) FROM pm)")
def src18_one(t: Tables) -> DataFrame:
    """The export of one project is a table of its own: only its folder is read."""
    pm = project_months(t)
    panel = pm.select("project", F.date_format("month", "yyyy-MM").alias("period"), "sales", "falls")
    path = ingest.export_by(panel, shared(t.spark, "panel"), "project", "period")
    return t.spark.read.option("header", True).schema("period string, sales long, falls long").csv(f"{path}/project={pm.agg(F.min('project')).first()[0]}")


@query("sc01_business_date", "WITH x AS (SELECT o_orderkey, CASE o_orderkey%4 WHEN 0 THEN strftime(o_orderdate,'%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate,'%d-%m-%Y') WHEN 2 THEN '31-02-2024' ELSE strftime(o_orderdate,'%Y/%m/%d') END AS s FROM orders) SELECT o_orderkey, CASE WHEN regexp_matches(s,'^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(try_strptime(s,'%Y-%m-%d') AS DATE) WHEN regexp_matches(s,'^\\d{2}-\\d{2}-\\d{4}$') THEN CAST(try_strptime(s,'%d-%m-%Y') AS DATE) END AS d FROM x")
def sc01(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 4, "o_orderdate"
    s = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd-MM-yyyy")).when(k == 2, "31-02-2024").otherwise(F.date_format(d, "yyyy/MM/dd"))
    return t.orders.select("o_orderkey", text.business_date(s).alias("d"))


@query("sc02_numeric", "SELECT p_partkey, CASE WHEN p_partkey%4 IN (0,1,2) THEN round(p_retailprice,1) ELSE CAST(NULL AS DOUBLE) END AS v FROM part")
def sc02(t: Tables) -> DataFrame:
    """Prices written in three styles and one that is no number."""
    k, price = F.col("p_partkey") % 4, F.round("p_retailprice", 1)
    plain = F.format_string("%.1f", price)
    s = F.when(k == 0, plain).when(k == 1, F.regexp_replace(plain, r"\.", ",")).when(k == 2, F.concat(F.lit("S/ "), F.format_number(price, 1))).otherwise("1.2.3x")
    return t.part.select("p_partkey", text.numeric(s).alias("v"))


@query("sc03_normalize_text", "SELECT p_partkey, nullif(trim(regexp_replace(CASE WHEN p_partkey%5=0 THEN '   ' ELSE '  '||p_name||'  x ' END, '\\s+', ' ', 'g')), '') AS name FROM part")
def sc03(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.normalize(F.when(F.col("p_partkey") % 5 == 0, "   ").otherwise(F.concat(F.lit("  "), "p_name", F.lit("  x ")))).alias("name"))


@query("sc04_canonical_name", "SELECT p_partkey, list_aggregate(list_sort(list_filter(string_split(translate(upper(p_name||' é ñu'),'ÁÉÍÓÚÜÑ','AEIOUUN'),' '), lambda w: len(w)>1)), 'string_agg', ' ') AS name FROM part")
def sc04(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.canonical_name(F.concat("p_name", F.lit(" é ñu"))).alias("name"))


@query("sc05_phone_quality", "SELECT c_custkey, CAST(900000000+c_custkey AS VARCHAR) AS phone, TRUE AS ok FROM customer")
def sc05(t: Tables) -> DataFrame:
    local = (F.col("c_custkey") + 900000000).cast("string")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("+51 "), F.substring(local, 1, 3), F.lit(" "), F.substring(local, 4, 3), F.lit(" "), F.substring(local, 7, 3))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("0051"), local)).otherwise(local)
    return t.customer.select("c_custkey", text.phone(raw).alias("phone"), text.phone_ok(raw).alias("ok"))


@query("sc06_valid_contacts", "SELECT c_custkey, c_custkey%2=0 AS email_ok, CASE WHEN c_custkey%3=0 THEN lpad(CAST(c_custkey AS VARCHAR),8,'0') END AS dni FROM customer")
def sc06(t: Tables) -> DataFrame:
    mail = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("a"), "c_custkey", F.lit("@mail.example"))).otherwise("a@b")
    doc = F.when(F.col("c_custkey") % 3 == 0, F.lpad(F.col("c_custkey").cast("string"), 8, "0")).otherwise("auto-12345678")
    return t.customer.select("c_custkey", text.email_ok(mail).alias("email_ok"), text.document8(doc).alias("dni"))


CLIENT = """cl AS (SELECT c_custkey, c_custkey%5<>0 AS name_ok, c_custkey%7<>0 AS doc_ok, c_custkey%2=0 AS phone_ok, c_custkey%3=0 AS email_ok, c_mktsegment<>'BUILDING' AS channel_ok, c_nationkey<>3 AS project_ok FROM customer),
q AS (SELECT c_custkey, greatest(0, 100-(CASE WHEN name_ok THEN 0 ELSE 15 END)-(CASE WHEN doc_ok THEN 0 ELSE 15 END)-(CASE WHEN phone_ok OR email_ok THEN 0 ELSE 40 END)-(CASE WHEN channel_ok THEN 0 ELSE 10 END)-(CASE WHEN project_ok THEN 0 ELSE 10 END)-(CASE WHEN NOT phone_ok AND email_ok THEN 20 ELSE 0 END)) AS score FROM cl)"""


@query("sc07_client_dq_score", f"WITH {CLIENT} SELECT c_custkey, score FROM q")
def sc07(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select("c_custkey", text.quality_score(k % 5 != 0, k % 7 != 0, k % 2 == 0, k % 3 == 0, F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey") != 3).alias("score"))


@query("dp19_client_quality", f"WITH {CLIENT} SELECT CASE WHEN score>=90 THEN 'ALTA' WHEN score>=60 THEN 'MEDIA' ELSE 'BAJA' END AS level, count(*) AS clients, round(avg(score),6) AS mean_score FROM q GROUP BY 1")
def dp19(t: Tables) -> DataFrame:
    level = rules.first_of((F.col("score") >= 90, "ALTA"), (F.col("score") >= 60, "MEDIA"), otherwise="BAJA")
    return sc07(t).groupBy(level.alias("level")).agg(F.count("*").alias("clients"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("sc08_person_key", "SELECT c_custkey, CASE WHEN c_custkey%3=0 THEN 'DOC:'||c_custkey WHEN c_custkey%5=0 THEN 'EMAIL:'||lower(c_name) ELSE 'SRC:'||c_custkey END AS person FROM customer")
def sc08(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    doc, mail = F.when(k % 3 == 0, k.cast("string")).otherwise(""), F.when(k % 5 == 0, F.lower("c_name"))
    return t.customer.select("c_custkey", F.coalesce(F.concat(F.lit("DOC:"), F.nullif(doc, F.lit(""))), F.concat(F.lit("EMAIL:"), mail), F.concat(F.lit("SRC:"), k)).alias("person"))


@query("sc10_match_status", "WITH m AS (SELECT c_custkey, c_custkey%101 AS id_score, c_custkey%97 AS name_score, c_custkey%89 AS contact_score FROM customer) SELECT c_custkey, CASE WHEN id_score=100 THEN 'CONFIRMADO' WHEN name_score>=85 AND contact_score>=80 THEN 'CONFIRMADO' WHEN name_score>=70 AND contact_score>=50 THEN 'PROBABLE' WHEN name_score>=60 OR contact_score>=60 THEN 'REVISAR' ELSE 'NO MATCH' END AS status FROM m")
def sc10(t: Tables) -> DataFrame:
    i, n, c = F.col("c_custkey") % 101, F.col("c_custkey") % 97, F.col("c_custkey") % 89
    return t.customer.select("c_custkey", rules.first_of((i == 100, "CONFIRMADO"), ((n >= 85) & (c >= 80), "CONFIRMADO"), ((n >= 70) & (c >= 50), "PROBABLE"), ((n >= 60) | (c >= 60), "REVISAR"), otherwise="NO MATCH").alias("status"))


@query("sc11_surrogate_key", "SELECT o_orderkey, md5(o_orderkey||'|'||o_custkey||'|'||o_orderstatus) AS key FROM orders")
def sc11(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.surrogate_key("o_orderkey", "o_custkey", "o_orderstatus").alias("key"))


@query("sc14_split_to_rows", "SELECT DISTINCT o_custkey, CAST(trim(x) AS BIGINT) AS part FROM (SELECT o_custkey, unnest(string_split_regex(o_orderkey||', '||(o_orderkey%7)||';x|'||(o_orderkey%5), '[,;|]')) AS x FROM orders) WHERE regexp_matches(trim(x),'^\\d+$')")
def sc14(t: Tables) -> DataFrame:
    listed = F.concat("o_orderkey", F.lit(", "), F.col("o_orderkey") % 7, F.lit(";x|"), F.col("o_orderkey") % 5)
    return t.orders.select("o_custkey", F.explode(F.split(listed, "[,;|]")).alias("x")).where(F.trim("x").rlike(r"^\d+$")).select("o_custkey", F.trim("x").cast("long").alias("part")).distinct()


@query("sc15_json_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def sc15(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("sc16_json_build", "SELECT p_partkey, '{\"k\":'||p_partkey||',\"name\":\"'||p_name||'\"}' AS payload FROM part")
def sc16(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.to_json(F.struct(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))).alias("payload"))


@query("sc17_reason_text", f"WITH {LEADS} SELECT lead, concat_ws('; ', CASE WHEN status='P' THEN 'pendiente' END, CASE WHEN amount>150000 THEN 'monto alto '||CAST(floor(amount/1000) AS BIGINT) END) AS reason FROM leads")
def sc17(t: Tables) -> DataFrame:
    return leads(t).select("lead", F.concat_ws("; ", F.when(F.col("status") == "P", "pendiente"), F.when(F.col("amount") > 150000, F.concat(F.lit("monto alto "), F.floor(F.col("amount") / 1000).cast("long")))).alias("reason"))


@query("sc18_economic_value", "SELECT o_orderkey, round(greatest(0,least(1,(o_orderkey%100)/100.0::DOUBLE+0.1))*o_totalprice-(o_orderkey%100)/100.0::DOUBLE*o_totalprice-50,4) AS added FROM orders")
def sc18(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(rules.expected_value((F.col("o_orderkey") % 100) / 100.0, F.col("o_totalprice"), F.lit(50.0), F.lit(0.1)), 4).alias("added"))


@query("sc19_confidence_adjusted", "SELECT o_orderkey, round(o_totalprice*(o_orderkey%10)/10.0::DOUBLE,4) AS adjusted FROM orders")
def sc19(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * (F.col("o_orderkey") % 10) / 10.0, 4).alias("adjusted"))


@query("sc20_risk_score", "WITH x AS (SELECT o_orderkey, o_orderkey%90 AS days, o_orderkey%2=0 AS contacted, o_orderkey%4 AS n, o_orderstatus='P' AS blocked FROM orders), s AS (SELECT o_orderkey, round(least(1.0::DOUBLE, (CASE WHEN days>60 THEN 0.4 WHEN days>30 THEN 0.25 ELSE 0.1 END)::DOUBLE+(CASE WHEN NOT contacted THEN 0.25 ELSE 0 END)::DOUBLE+(CASE WHEN n<2 THEN 0.2 ELSE 0 END)::DOUBLE+(CASE WHEN blocked THEN 0.3 ELSE 0 END)::DOUBLE),6) AS risk FROM x) SELECT o_orderkey, risk, CASE WHEN risk>=0.7 THEN 'LLAMAR' WHEN risk>=0.45 THEN 'SEGUIR' ELSE 'OBSERVAR' END AS action FROM s")
def sc20(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    risk = F.round(rules.risk_score(k % 90, k % 2 == 0, k % 4, F.col("o_orderstatus") == "P"), 6)
    return t.orders.select("o_orderkey", risk.alias("risk")).withColumn("action", rules.first_of((F.col("risk") >= 0.7, "LLAMAR"), (F.col("risk") >= 0.45, "SEGUIR"), otherwise="OBSERVAR"))


@query("sc24_freshness", "WITH f AS (SELECT event_type, date_diff('hour', max(ts), TIMESTAMP '2024-01-31 12:00:00') AS lag_hours FROM events GROUP BY 1) SELECT event_type, lag_hours, CASE WHEN lag_hours<=12 THEN 'OK' WHEN lag_hours<=18 THEN 'WARN' ELSE 'FAIL' END AS health FROM f")
def sc24(t: Tables) -> DataFrame:
    f = t.events.groupBy("event_type").agg(F.max("ts").alias("last"))
    hour = lambda c: F.expr(f"timestampdiff(HOUR, date_trunc('hour', {c}), timestamp_ntz'2024-01-31 12:00:00')")
    return f.select("event_type", hour("last").alias("lag_hours")).withColumn("health", rules.freshness(F.col("lag_hours"), 12))


@query("sc25_mart_health", f"WITH {PM} SELECT project, (CASE WHEN max(month)>=DATE '2001-06-01' THEN 45 ELSE 0 END)+(CASE WHEN count(*)>=60 THEN 30 ELSE 0 END)+(CASE WHEN sum(falls)=0 THEN 20 ELSE 10 END)+5 AS score FROM pm GROUP BY 1")
def sc25(t: Tables) -> DataFrame:
    return project_months(t).groupBy("project").agg((F.when(F.max("month") >= "2001-06-01", 45).otherwise(0) + F.when(F.count("*") >= 60, 30).otherwise(0) + F.when(F.sum("falls") == 0, 20).otherwise(10) + 5).alias("score"))


TAXONOMY = {"NEGATIVO": ["stupid", "trash", "idiot"], "LICENCIA": ["licensed", "copyright"], "PASO": ["token"]}


@query("sc26_tag_taxonomy", "WITH x AS (SELECT lower(text) AS s FROM documents), g AS (SELECT list_filter([CASE WHEN contains(s,'stupid') OR contains(s,'trash') OR contains(s,'idiot') THEN 'NEGATIVO' END, CASE WHEN contains(s,'licensed') OR contains(s,'copyright') THEN 'LICENCIA' END, CASE WHEN contains(s,'token') THEN 'PASO' END], lambda v: v IS NOT NULL) AS l FROM x) SELECT tag, count(*) AS n FROM (SELECT unnest(CASE WHEN len(l)>0 THEN l ELSE ['OTRO'] END) AS tag FROM g) GROUP BY 1")
def sc26(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(text.tags(F.col("text"), TAXONOMY, "OTRO")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("udf01_sql_functions", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def udf01(t: Tables) -> DataFrame:
    """The same expressions as SQL functions of the session."""
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION business_date(s STRING) RETURNS DATE RETURN CASE WHEN s RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' THEN CAST(try_to_timestamp(s, 'yyyy-MM-dd') AS DATE) WHEN s RLIKE '^[0-9]{2}-[0-9]{2}-[0-9]{4}$' THEN CAST(try_to_timestamp(s, 'dd-MM-yyyy') AS DATE) END")
    return t.orders.select("o_orderkey", F.expr("business_date(date_format(o_orderdate, 'dd-MM-yyyy'))").alias("d"))


@query("udf05_has_mature_outcomes", "SELECT bool_or(o_orderstatus='F' AND o_orderdate<TIMESTAMP '1996-01-01') AS has_mature, n_nationkey FROM orders CROSS JOIN nation GROUP BY 2")
def udf05(t: Tables) -> DataFrame:
    probe = t.orders.agg(F.bool_or((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))).alias("has_mature"))
    return t.nation.select("n_nationkey").crossJoin(F.broadcast(probe))
