"""Outputs that no SQL holds, against brute force."""

import datetime
import difflib
import random

import pandas as pd
from pyspark.sql import functions as F

from lifemart import registry
from lifemart.operators import matching
from lifemart.operators.models import synthetic_weights
from lifemart.plans import load_all, models, people

load_all()
FOLDER = "/root/testdata/sf0.001"


def test_name_pairs(spark):
    names = {}
    for r in spark.read.parquet(f"{FOLDER}/part.parquet").collect():
        k = r["p_brand"], r["p_name"]
        names[k] = min(names.get(k, r["p_partkey"]), r["p_partkey"])
    pairs = {(i, j): (x, y) for (p, x), i in names.items() for (q, y), j in names.items() if p == q and i < j and set(x.split(" ")) & set(y.split(" "))}
    assert any(b - a >= 40 for a, b in pairs)
    found = registry.QUERIES["udf03_pair_similarity"](spark, FOLDER).collect()
    assert sorted((r["a"], r["b"], r["ratio"]) for r in found) == sorted((*k, round(100 * difflib.SequenceMatcher(None, *v).ratio(), 2)) for k, v in pairs.items())


def ratio(a, b):
    return round(100.0 * difflib.SequenceMatcher(None, a, b).ratio(), 2) if a and b else 0.0


def similarity(a, b):
    """document, name, phone and email score of two people: (document, name, phone, email)."""
    name = phone = email = 0.0
    if a[1] and b[1]:
        x, y = (" ".join(sorted(n.split())) for n in (a[1], b[1]))
        u, v = set(x.split()), set(y.split())
        name = round(max(ratio(a[1], b[1]), ratio(x, y), 100 * len(u & v) / len(u | v)), 2)
    if a[2] and b[2]:
        phone = 100.0 if a[2] == b[2] else 96.0 if a[2][-7:] == b[2][-7:] else ratio(a[2], b[2])
    if a[3] and b[3]:
        (l1, d1), (l2, d2) = a[3].split("@"), b[3].split("@")
        email = 100.0 if a[3] == b[3] else round(min(max(ratio(a[3], b[3]), 0.8 * ratio(l1, l2) + 20), 100) if d1 == d2 else min(ratio(a[3], b[3]), 92), 2)
    return 100.0 if a[0] and a[0] == b[0] else 0.0, name, phone, email


def test_short_texts_are_compared_together(monkeypatch):
    """The ratio is difflib's, for texts of any letters, but short texts don't go through it one pair at a time."""
    draw = random.Random(11)
    word = lambda letters, n: "".join(draw.choice(letters) for _ in range(draw.randrange(n)))
    for letters, n in (("ab", 40), ("BCDFGH ", 25), ("0123456789", 12), ("\u00e1\U0001f600b\0", 20), ("ab", 199)):
        x, y = ([word(letters, n) for _ in range(500)] for _ in "xy")
        want = [ratio(a, b) for a, b in zip(x, y)]
        with monkeypatch.context() as m:
            m.setattr(matching, "SequenceMatcher", None)
            assert matching.ratios(pd.Series(x), pd.Series(y)).tolist() == want
    x, y = ["ab" * 120, "ab", None, ""], ["ba" * 130, "b" * 300, "a", None]
    assert matching.ratios(pd.Series(x), pd.Series(y)).tolist() == [ratio(a, b) for a, b in zip(x, y)]


def test_records_of_pairs_are_prepared_once(spark, monkeypatch):
    """Candidates read records that were keyed once; neither normal forms nor joins follow the pairs."""
    kept = []
    monkeypatch.setattr(matching, "written", lambda df, label: kept.append(label) or df)
    registry.QUERIES["jn20_blocked_fuzzy"](spark, FOLDER)
    assert kept == ["people", "people"]


#: Scores of document, name, phone and email, and what follows from them.
GOLDEN = [
    ((100, 0, 0, 0), "CONFIRMADO", 100.0),
    ((0, 0, 100, 100), "CONFIRMADO", 99.0),
    ((0, 0, 98.9, 100), "PROBABLE", 90.0),
    ((0, 92, 0, 99), "CONFIRMADO", 97.0),
    ((0, 91.9, 0, 100), "PROBABLE", 90.0),
    ((0, 100, 100, 100), "CONFIRMADO", 100.0),
    ((0, 100, 100, 0), "CONFIRMADO", 97.0),
    ((0, 88, 94, 0), "PROBABLE", 90.0),
    ((0, 87.9, 94, 0), "REVISAR", 80.0),
    ((0, 0, 94, 97), "PROBABLE", 90.0),
    ((0, 0, 97, 94), "NO MATCH", 71.85),
    ((0, 82, 88, 0), "REVISAR", 80.0),
    ((0, 82, 87, 80), "NO MATCH", 83.65),
    ((0, 100, 0, 0), "NO MATCH", 25.0),
    ((99, 100, 50, 50), "NO MATCH", 62.5),
    ((0, 0, 0, 0), "NO MATCH", 0.0),
]


def test_match_rules(spark):
    rows = spark.createDataFrame([(i, *map(float, scores)) for i, (scores, _, _) in enumerate(GOLDEN)], "i int, d double, n double, p double, e double")
    status, score = matching.match(*map(F.col, "dnpe"))
    found = {r["i"]: (r["status"], r["score"]) for r in rows.select("i", status.alias("status"), score.alias("score")).collect()}
    assert found == {i: (status, score) for i, (_, status, score) in enumerate(GOLDEN)}


def test_people(spark):
    leads, buyers = (f.collect() for f in people.people(registry.Tables(spark, FOLDER)))
    who = lambda r: (r["document"], r["name"], r["phone"], r["email"])

    def blocks(r):
        words = sorted((w for w in (r["canonical"] or "").split() if len(w) >= 4), key=len, reverse=True)[:3]
        email = r["email"] and r["email"].split("@")
        return {x for x in (r["document"] and "D" + r["document"], r["source"] and "I" + r["source"], r["email"] and "E" + r["email"], email and f"P{email[0][:3]}@{email[1]}", r["phone"] and "T" + r["phone"], r["phone"] and "S" + r["phone"][-6:], *("N" + w for w in words)) if x}

    lead_blocks, buyer_blocks = {r["lead"]: blocks(r) for r in leads}, {r["buyer"]: blocks(r) for r in buyers}
    lead_of, buyer_of = {r["lead"]: who(r) for r in leads}, {r["buyer"]: who(r) for r in buyers}
    wanted = {(i, j): similarity(lead_of[i], buyer_of[j]) for i, x in lead_blocks.items() for j, y in buyer_blocks.items() if x & y}
    scored = registry.QUERIES["sc09_match_scores"](spark, FOLDER)
    found = {(r["lead"], r["buyer"]): tuple(r[2:]) for r in scored.collect()}
    assert found.keys() == wanted.keys()
    for k, v in wanted.items():
        assert all(abs(x - y) < 0.011 for x, y in zip(found[k][:4], v, strict=True)), (k, found[k], v)
    status, score = matching.match(*(F.col(f"{c}_score") for c in ("document", "name", "phone", "email")))
    assert scored.where((F.col("status") != status) | (F.abs(F.col("score") - score) > 0.011)).count() == 0
    assert {v[4] for v in found.values()} >= {"CONFIRMADO", "PROBABLE"}
    rank = {"NO MATCH": 0, "REVISAR": 1, "PROBABLE": 2, "CONFIRMADO": 3}
    best = {}
    for (i, j), v in found.items():
        best[i] = max(best.get(i, ((-1,),)), ((rank[v[4]], v[5], v[0], max(v[2], v[3]), v[1], -j), j, v[4]))
    rows = registry.QUERIES["tk07_best_person"](spark, FOLDER).collect()
    assert {r["lead"]: (r["buyer"], r["status"]) for r in rows} == {i: x[1:] for i, x in best.items()}
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").collect()
    first, last = {}, {}
    for r in orders:
        day = r["o_orderdate"].date()
        first[r["o_custkey"]] = min(first.get(r["o_custkey"], day), day)
        if r["o_orderstatus"] == "F":
            last[r["o_custkey"]] = max(last.get(r["o_custkey"], day), day)
    channel, given = {r["lead"]: r["channel"] for r in leads}, {}
    for i, (_, j, status) in best.items():
        if rank[status] > 1 and i in first and j in last and first[i] <= last[j]:
            given.setdefault(j, []).append(({"BUILDING": 1, "AUTOMOBILE": 2}.get(channel[i], 3), first[i], i))
    rows = registry.QUERIES["dp20_matched_attribution"](spark, FOLDER).collect()
    assert {r["buyer"]: r["lead"] for r in rows} == {j: min(x)[2] for j, x in given.items()} and rows


def test_synthetic_control_all_donors(spark, monkeypatch):
    draw, rows = random.Random(5), []
    for m in range(60):
        month = datetime.date(1995 + m // 12, 1 + m % 12, 1)
        sales = {p: draw.randrange(100, 900) for p in range(1, 25)}
        sales[0] = 0.6 * sales[7] + 0.4 * sales[19] if m < 40 else 1e6
        rows += [(p, month, float(v)) for p, v in sales.items()]
    panel = spark.createDataFrame(rows, "project int, month date, sales double")
    found = {r["project"]: r["weight"] for r in synthetic_weights(panel, 0, "1998-05-01").collect()}
    assert set(found) == set(range(1, 25))
    assert all(abs(w - {7: 0.6, 19: 0.4}.get(p, 0)) < 1e-6 for p, w in found.items())
    monkeypatch.setattr(models, "project_months", lambda t: panel)
    real = {(p, m): v for p, m, v in rows}
    for r in models.ml21(registry.Tables(spark, FOLDER), 0, "1998-05-01").collect():
        assert abs(r["synthetic"] - 0.6 * real[7, r["month"]] - 0.4 * real[19, r["month"]]) < 1e-3
    assert {r["project"] for r in synthetic_weights(panel, 3, "1998-05-01").collect()} == set(range(25)) - {3}
