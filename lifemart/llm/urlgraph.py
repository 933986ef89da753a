"""op3: URL verdicts by host and path rules and, where no rule fits, by propagation over the graph of hosts.

Hosts with pages that rules allow are seeds of trust, hosts with pages that rules block seeds of distrust, each by
the share of such pages among those that rules judge: pages without a rule say nothing of their host. Trust follows links (personalised PageRank), distrust goes against them: who links to a
blocked host is distrusted. Host edges are the links between hosts and, both ways, those between a host and the one
above it, down to names of LABELS labels: who owns a host owns what is under it. Each walk also carries the rank that
every host would have if all were seeds; trust and distrust are shares of that (0 to 1), so a host without edges
keeps its seed. A host whose distrust exceeds its trust by THRESHOLD is blocked. A round is one join and one sum over
the table of edges. Moves shrink by DAMPING a round, so TOLERANCE is reached before ROUNDS are over. In the graph, hosts are
without user and port.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING, THRESHOLD, ROUNDS, TOLERANCE = 0.85, 0.4, 50, 1e-3
#: Labels of the shortest host name that counts as an owner of those under it.
LABELS = 2
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for what has no ://."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s).*?://", "")).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict): the longest rule whose host is this or above it and whose path begins this path; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def graph_host(host: Column) -> Column:
    return ascii_lower(F.regexp_replace(host, r"^.*@|:\d*$", ""))


def owner_edges(hosts: DataFrame, labels: int = LABELS) -> DataFrame:
    """src, dst, n: each host with the one above it, and so on up to names of so many labels, both ways. hosts: host, each once."""
    parts = F.split("host", r"\.")
    names = hosts.where("host <> ''").select("host", parts.alias("parts")).select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("parts") - labels + 1, F.lit(1))), lambda i: F.array_join(F.slice("parts", i, F.size("parts")), "."))).alias("host")).distinct()
    up = names.where(F.size(parts) > labels).select(F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst")).where("dst <> ''")
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, each as a share of the rank with all hosts as seeds. seeds: host, trust, distrust; edges: src, dst, n (links), src <> dst.

    Stops when no share moved by the tolerance; every round is a written table.
    """
    kinds = F.explode(F.array(F.lit("trust"), F.lit("distrust")))
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    steps = materialise(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all") * damping).alias("share")), "steps")
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed"))
    linked = steps.select(F.explode(F.array("src", "dst")).alias("host")).distinct().select("host", kinds.alias("kind"), F.lit(0.0).alias("seed"))
    nodes = materialise(start.unionByName(linked).groupBy("host", "kind").agg(F.sum("seed").alias("seed")), "nodes")
    rank = nodes.select("host", "kind", F.col("seed").alias("score"), F.lit(1.0).alias("base"))
    for _ in range(0 if steps.isEmpty() else rounds):
        got = [F.sum(F.col(c) * F.col("share")).alias(f"{c}_got") for c in ("score", "base")]
        moved = rank.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).groupBy(F.col("dst").alias("host"), "kind").agg(*got)
        new = nodes.join(moved, ["host", "kind"], "left").select("host", "kind", (F.col("seed") + F.coalesce("score_got", F.lit(0.0))).alias("score"), (1.0 + F.coalesce("base_got", F.lit(0.0))).alias("base"))
        stepped = materialise(new.join(rank.select("host", "kind", (F.col("score") / F.col("base")).alias("was")), ["host", "kind"]), "ranks")
        rank = stepped.select("host", "kind", "score", "base")
        if (stepped.agg(F.max(F.abs(F.col("score") / F.col("base") - F.col("was")))).first()[0] or 0) < tolerance:
            break
    share = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score") / F.col("base")).otherwise(0.0)).alias(kind)
    return rank.groupBy("host").agg(share("trust"), share("distrust"))


def host_edges(pages: DataFrame, host: Column) -> DataFrame:
    """src, dst, n: pages of src with a link to dst, and owner_edges of the hosts of pages and of links."""
    src = graph_host(host)
    links = pages.select(src.alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), graph_host))).alias("dst"))
    links = materialise(links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n")), "links")
    hosts = pages.select(src.alias("host")).unionByName(links.select(F.col("dst").alias("host"))).distinct()
    return links.unionByName(owner_edges(hosts)).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of pages (page_id, url, html).

    A null url or html has no host or no links; pages without a host are allowed unless a rule says otherwise.
    Rows that repeat an id, equal or not, are judged one by one, and an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    placed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("said", verdict).withColumn("node", graph_host(F.col("host")))
    share = lambda said: F.coalesce(F.avg(F.when(F.col("said").isNotNull(), (F.col("said") == said).cast("double"))), F.lit(0.0))
    seeds = placed.where("node <> ''").groupBy(F.col("node").alias("host")).agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(materialise(seeds, "seeds"), materialise(host_edges(pages, host), "edges"))
    blocked = materialise(scores.where(F.col("distrust") - F.col("trust") > threshold).select(F.col("host").alias("node"), F.lit("block").alias("node_verdict")), "blocked")
    return placed.join(blocked, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("said", "node_verdict", F.lit("allow")).alias("verdict"))
