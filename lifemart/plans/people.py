"""Leads and buyers as people: blocks, scores, best matches and attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..operators import matching
from ..operators.temporal import latest
from ..registry import Tables, query
from ..session import ship_code

PEOPLE = """p AS (SELECT c_custkey AS k, c_mktsegment AS channel, translate(md5(CAST(c_custkey AS VARCHAR)),'0123456789abcdef','BCDFGHJKLMNPQRST') AS t FROM customer),
lead AS (SELECT k AS lead, CASE WHEN k%3=0 THEN lpad(CAST(k*7919%100000000 AS VARCHAR),8,'0') END AS document, CASE WHEN k%3=0 THEN lpad(CAST(k*7919%100000000 AS VARCHAR),8,'0') WHEN k%9=4 THEN 'auto-'||k END AS source, CASE WHEN k%4<3 THEN t[1:6]||' '||t[7:11]||' '||t[12:18] END AS name, CASE WHEN k%5<3 THEN '9'||lpad(CAST(k*104729%100000000 AS VARCHAR),8,'0') END AS phone, CASE WHEN k%2=0 THEN lower(t[1:6])||k||'@mail'||(k%7)||'.pe' END AS email FROM p),
buyer AS (SELECT k AS buyer, CASE WHEN k%6=0 THEN lpad(CAST(k*7919%100000000 AS VARCHAR),8,'0') END AS document, CASE WHEN k%6=0 THEN lpad(CAST(k*7919%100000000 AS VARCHAR),8,'0') ELSE 'auto-'||k END AS source, t[12:18]||' '||(CASE WHEN k%7=0 THEN t[2:6] ELSE t[1:6] END)||' '||t[7:11] AS name, CASE WHEN k%5<2 THEN '8'||lpad(CAST(k*104729%100000000 AS VARCHAR),8,'0') ELSE '9'||lpad(CAST(k*104729%100000000 AS VARCHAR),8,'0') END AS phone, lower(t[1:6])||k||(CASE WHEN k%4=0 THEN 'x' ELSE '' END)||'@mail'||(k%7)||'.pe' AS email FROM p WHERE k%3<>1)"""
BLOCKS = """list_filter(list_distinct(list_concat(['D:'||document,'I:'||source,'E:'||email,'P:'||split_part(email,'@',1)[1:3]||'@'||split_part(email,'@',2),'T:'||phone,'S:'||right(phone,6)], coalesce(list_transform(list_filter(string_split(name,' '), lambda w: length(w)>=4), lambda w: 'N:'||w), []))), lambda x: x IS NOT NULL)"""
CANDIDATES = f"""{PEOPLE}, lb AS (SELECT lead, unnest({BLOCKS}) AS block FROM lead), bb AS (SELECT buyer, unnest({BLOCKS}) AS block FROM buyer), cand AS (SELECT DISTINCT lead, buyer FROM lb JOIN bb USING (block))"""


def people(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(leads, buyers) made from the customers: each side lacks some fields and writes others differently."""
    ship_code(t.spark)
    k = F.col("c_custkey")
    clients = t.customer.select("c_custkey", "c_mktsegment").repartition("c_custkey")  # names cost more than they weigh: a small file would be few tasks
    c = clients.withColumn("t", F.translate(F.md5(k.cast("string")), "0123456789abcdef", "BCDFGHJKLMNPQRST"))
    part = lambda a, b: F.substring("t", a, b - a + 1)
    document, digits, domain = F.lpad((k * 7919 % 100_000_000).cast("string"), 8, "0"), F.lpad((k * 104729 % 100_000_000).cast("string"), 8, "0"), F.concat(F.lit("@mail"), k % 7, F.lit(".pe"))
    lead = matching.identity(c.withColumn("lead", k), "lead", F.when(k % 3 == 0, document).when(k % 9 == 4, F.concat(F.lit("AUTO-"), k)), F.when(k % 4 < 3, F.concat_ws(" ", part(1, 6), part(7, 11), part(12, 18))), F.when(k % 5 < 3, F.concat(F.lit("9"), digits)), F.when(k % 2 == 0, F.concat(F.lower(part(1, 6)), k, domain)), F.col("c_mktsegment").alias("channel"))
    other = F.concat_ws(" ", part(12, 18), F.when(k % 7 == 0, part(2, 6)).otherwise(part(1, 6)), part(7, 11))
    buyer = matching.identity(c.where("c_custkey % 3 <> 1").withColumn("buyer", k), "buyer", F.when(k % 6 == 0, document).otherwise(F.concat(F.lit(" auto- "), k)), other, F.concat(F.when(k % 5 < 2, "8").otherwise("9"), digits), F.concat(F.lower(part(1, 6)), k, F.when(k % 4 == 0, "x").otherwise(""), domain))
    return lead, buyer


def pairs(t: Tables) -> DataFrame:
    lead, buyer = people(t)
    return matching.candidates(lead, buyer, "lead", "buyer")


@query("jn20_blocked_fuzzy", f"WITH {CANDIDATES} SELECT lead, buyer FROM cand")
def jn20(t: Tables) -> DataFrame:
    """Candidates that share any block key, each once."""
    return pairs(t)


@query("jn20_block_report", f"WITH {CANDIDATES}, n AS (SELECT block, a*b AS pairs FROM (SELECT block, count(*) AS a FROM lb GROUP BY 1) JOIN (SELECT block, count(*) AS b FROM bb GROUP BY 1) USING (block)) SELECT block[1:1] AS kind, count(*) AS blocks, CAST(sum(pairs) AS BIGINT) AS pairs, max(pairs) AS largest FROM n GROUP BY 1")
def jn20_report(t: Tables) -> DataFrame:
    """How skewed the blocks are; none is dropped."""
    return matching.block_report(*people(t))


@query("sc09_name_similarity", f"WITH {CANDIDATES}, w AS (SELECT lead, buyer, list_distinct(string_split(l.name,' ')) AS x, list_distinct(string_split(b.name,' ')) AS y FROM cand JOIN lead l USING (lead) JOIN buyer b USING (buyer) WHERE l.name IS NOT NULL) SELECT lead, buyer, round(100.0::DOUBLE*len(list_intersect(x,y))/len(list_distinct(list_concat(x,y))),6) AS jaccard FROM w")
def sc09(t: Tables) -> DataFrame:
    """Jaccard of the names' words over the candidates."""
    lead, buyer = people(t)
    named = lambda df, key, name: df.where("canonical is not null").select(key, F.col("canonical").alias(name))
    both = matching.candidates(lead, buyer, "lead", "buyer").join(named(lead, "lead", "x"), "lead").join(named(buyer, "buyer", "y"), "buyer")
    return both.select("lead", "buyer", F.round(matching.word_jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))


NAMES = "n AS (SELECT p_brand, p_name, min(p_partkey) AS id, list_distinct(string_split(p_name,' ')) AS w FROM part GROUP BY ALL)"


def name_pairs(t: Tables) -> DataFrame:
    """a, x, b, y: the different names of a brand that share a word, by the smallest id of each."""
    names = t.part.groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("id"))
    words = names.select("p_brand", "id", "p_name", F.explode(F.array_distinct(F.split("p_name", " "))).alias("word"))
    a, b = (words.select("p_brand", "word", F.col("id").alias(i), F.col("p_name").alias(n)) for i, n in (("a", "x"), ("b", "y")))
    return a.join(b, ["p_brand", "word"]).where("a < b").select("a", "x", "b", "y").distinct()


@query("sc09_name_similarity_all", f"WITH {NAMES} SELECT a.id AS a, b.id AS b, round(len(list_intersect(a.w, b.w))/CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE),6) AS jaccard FROM n a JOIN n b ON a.p_brand=b.p_brand AND a.id<b.id WHERE len(list_intersect(a.w, b.w))>0")
def sc09_all(t: Tables) -> DataFrame:
    """Word Jaccard above 0 of the different names of a brand; parts of one name are one, under their smallest id."""
    return name_pairs(t).select("a", "b", F.round(matching.word_jaccard(F.col("x"), F.col("y")) / 100.0, 6).alias("jaccard"))


@query("sc09_name_members", "SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_brand, p_name) AS name_id FROM part")
def sc09_members(t: Tables) -> DataFrame:
    """The id under which a part's name is compared."""
    names = t.part.groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("name_id"))
    return t.part.join(names, ["p_brand", "p_name"]).select("p_partkey", "name_id")


@query("udf03_pair_similarity")
def udf03(t: Tables) -> DataFrame:
    """Sequence ratios (percent) of the different names of a brand that share a word. (No SQL has this ratio.)"""
    ship_code(t.spark)
    return name_pairs(t).select("a", "b", F.pandas_udf(matching.ratios, "double")("x", "y").alias("ratio"))


@query("sc09_match_scores")
def match_scores(t: Tables) -> DataFrame:
    """All candidates with their scores and status. (No SQL has the sequence ratio; the tests hold it against plain Python.)"""
    lead, buyer = people(t)
    return matching.matched(lead, buyer, "lead", "buyer")


SCORED = "m AS (SELECT c_custkey, (c_custkey%11=0)::INT*100.0 AS d, c_custkey%101 AS n, (c_custkey*7)%103 AS e, (c_custkey*13)%107 AS p FROM customer), v AS (SELECT *, round(0.45*greatest(e,p)+0.30*least(e,p)+0.25*n,2)::DOUBLE AS plain FROM m)"


@query("sc10_match_rules", f"WITH {SCORED} SELECT c_custkey, CASE WHEN d>=100 THEN 'CONFIRMADO' WHEN e>=99 AND p>=99 THEN 'CONFIRMADO' WHEN n>=92 AND greatest(e,p)>=99 THEN 'CONFIRMADO' WHEN (n>=88 AND greatest(e,p)>=94) OR (e>=97 AND p>=94) THEN 'PROBABLE' WHEN n>=82 AND greatest(e,p)>=88 THEN 'REVISAR' ELSE 'NO MATCH' END AS status, CASE WHEN d>=100 THEN 100.0 WHEN e>=99 AND p>=99 THEN greatest(plain,99) WHEN n>=92 AND greatest(e,p)>=99 THEN greatest(plain,97) WHEN (n>=88 AND greatest(e,p)>=94) OR (e>=97 AND p>=94) THEN greatest(plain,90) WHEN n>=82 AND greatest(e,p)>=88 THEN greatest(plain,80) ELSE plain END::DOUBLE AS score FROM v")
def sc10_rules(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    status, score = matching.match(F.when(k % 11 == 0, 100.0).otherwise(0.0), k % 101, k * 13 % 107, k * 7 % 103)
    return t.customer.select("c_custkey", status.alias("status"), score.alias("score"))


@query("tk07_best_person")
def best_person(t: Tables) -> DataFrame:
    """The best buyer of each lead, by status, score, document, contact and name."""
    return matching.best_match(match_scores(t), "lead", "buyer")


@query("dp20_matched_attribution")
def matched_attribution(t: Tables) -> DataFrame:
    """One lead for each conversion: leads are matched to buyers as people, only confirmed or probable matches of a purchase on or after
    the lead count, and of the leads that match one buyer the source with priority, then the earliest, gets it."""
    lead, _ = people(t)
    bought = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("buyer")).agg(F.max(F.to_date("o_orderdate")).alias("converted"))
    asked = t.orders.groupBy(F.col("o_custkey").alias("lead")).agg(F.min(F.to_date("o_orderdate")).alias("d"))
    best = best_person(t).where("status in ('CONFIRMADO', 'PROBABLE')").join(bought, "buyer").join(asked, "lead").join(lead.select("lead", "channel"), "lead").where("d <= converted")
    order = first_of((F.col("channel") == "BUILDING", 1), (F.col("channel") == "AUTOMOBILE", 2), otherwise=3)
    return latest(best, ["buyer"], order, F.col("d"), F.col("lead")).select("buyer", "lead", "channel", "d", "converted", "status", "score")
