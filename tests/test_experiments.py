"""Experiments, loads under rules and figures of a scope's past against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lifemart.functions import text
from lifemart.operators import absorption, experiments, history, matching
from lifemart.sources import ingest


def test_performance_and_its_guards(spark):
    rows = [("a", "TREATED", 1, True, True)] * 6 + [("a", "TREATED", 0, True, False)] * 4 + [("a", "CONTROL", 1, False, False)] * 3 + [("a", "CONTROL", 0, False, False)] * 7 + [("a", "CONTROL", None, False, False)]
    rows += [("dirty", "TREATED", 1, True, True), ("dirty", "CONTROL", 0, False, True), ("young", "TREATED", None, True, False), ("young", "CONTROL", 1, False, False), ("alone", "TREATED", 1, True, True)]
    found = {r["k"]: r for r in experiments.performance(spark.createDataFrame(rows, "k string, arm string, outcome int, recommended boolean, acted boolean"), ["k"]).collect()}
    a = found["a"]
    assert (a["treated_assigned"], a["treated_matured"], a["treated_positive"], a["control_assigned"], a["control_matured"]) == (10, 10, 6, 11, 10)
    se = (0.6 * 0.4 / 10 + 0.3 * 0.7 / 10) ** 0.5
    assert (a["itt_points"], a["itt_low"], a["itt_high"], a["lift"]) == pytest.approx((30, 30 - 196 * se, 30 + 196 * se, 1.0))
    assert a["action_rate"] == 0.6 and a["control_maturity"] == pytest.approx(10 / 11)
    assert {k: r["status"] for k, r in found.items()} == {"a": "READY_FOR_ITT_REVIEW", "dirty": "CONTROL_CONTAMINATION", "young": "WAITING_MATURITY", "alone": "NO_COMPARISON_GROUP"}
    assert found["young"]["itt_points"] is None and found["alone"]["lift"] is None and found["dirty"]["lift"] is None and found["dirty"]["itt_points"] == 100


def test_value_is_told_when_complete(spark):
    rows = [("a", "TREATED", 1, 300.0, 50.0), ("a", "TREATED", 0, 0.0, 0.0), ("a", "TREATED", None, None, 50.0), ("a", "CONTROL", 0, 40.0, 0.0), ("b", "TREATED", 1, None, 0.0), ("b", "CONTROL", 0, 1.0, 0.0), ("c", "TREATED", 1, 5.0, 0.0), ("c", "CONTROL", None, 5.0, 0.0)]
    found = {r["k"]: r for r in experiments.economic_value(spark.createDataFrame(rows, "k string, arm string, outcome int, value double, cost double"), ["k"]).collect()}
    assert (found["a"]["incremental_value"], found["a"]["net_value"], found["a"]["return_on_cost"]) == ((150 - 40) * 2, 220 - 100, 1.2)
    assert found["b"]["status"] == "WAITING_REALIZED_VALUE" and found["b"]["net_value"] is None
    assert found["c"]["status"] == "WAITING_OUTCOME_MATURITY" and found["c"]["return_on_cost"] is None


def test_loads_under_rules(spark):
    target = ingest.hashed(spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string"), ["v"], "r1")
    source = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k int, v string")
    plan = lambda rules: {r["k"]: r["what"] for r in ingest.load_plan(source, target, ["k"], ["v"], rules).collect()}
    assert plan("r1") == {1: "UNCHANGED", 2: "UPDATE", 3: "UNCHANGED", 4: "DELETE", 5: "INSERT"}
    assert plan("r2") == {1: "REBUILD", 2: "REBUILD", 3: "REBUILD", 4: "DELETE", 5: "INSERT"}
    for rules in ("r1", "r2"):
        made = ingest.apply_plan(source, target, ["k"], ["v"], rules)
        assert sorted((r["k"], r["v"] or "", r["_rules"]) for r in made.collect()) == [(1, "a", rules), (2, "x", rules), (3, "", rules), (5, "e", rules)]
        assert ingest.hash_mismatches(source, made, ["k"], ["v"], rules).count() == 0
    assert ingest.hash_mismatches(source, target, ["k"], ["v"], "r1").count() == 3
    with pytest.raises(ValueError, match="reserved"):
        ingest.evolve_schema(source, source.withColumn("_Run_Id", F.lit(1)), ["k"])


def test_past_knows_only_ripe_labels(spark):
    draw, start = random.Random(3), dt.date(2024, 1, 1)
    rows = [(i, draw.choice(["a", "b", None]), start + dt.timedelta(days=draw.randrange(60)), draw.choice([0, 1, None])) for i in range(200)]
    frame = spark.createDataFrame(rows, "i int, who string, d date, y int")
    for scope in ("who", None):
        figures = [history.Past("n", 20), history.Past("rate", 20, "y", 7)]
        found = {r["i"]: r for r in history.with_past(frame, scope, "d", figures).collect()}
        assert len(found) == 200
        for i, who, d, _ in rows:
            if scope and who is None:
                assert found[i]["n"] is None and found[i]["rate"] is None
                continue
            own = [(e, y) for _, w, e, y in rows if not scope or w == who]
            ripe = [y for e, y in own if 7 <= (d - e).days <= 20 and y is not None]
            assert found[i]["n"] == sum(1 <= (d - e).days <= 20 for e, _ in own)
            assert found[i]["rate"] == (pytest.approx(sum(ripe) / len(ripe)) if ripe else None)


def test_candidates_are_all_pairs_that_share_a_block_once(spark):
    draw = random.Random(5)
    person = lambda i: (i, draw.choice([None, f"{draw.randrange(12):08d}", f" Auto-{draw.randrange(9)} "]), " ".join(draw.sample(["GARCIA", "LOPEZ", "QUISPE", "ROJAS", "ANA", "SOLIS"], 3)), draw.choice([None, "9" + f"{draw.randrange(20):08d}"]), draw.choice([None, f"ab{draw.randrange(30)}@x.pe", "a@@x.pe", "@x.pe", "a@pe"]))
    shape = "k long, document string, name string, phone string, email string"
    sides = [matching.identity(spark.createDataFrame([person(i) for i in range(n)], shape).withColumnRenamed("k", key), key, F.col("document"), F.col("name"), F.col("phone"), F.col("email")) for key, n in (("a", 70), ("b", 40))]
    keys = [{r[0]: set(r[1]) for r in side.select(key, matching.block_keys()).collect()} for side, key in zip(sides, "ab", strict=True)]
    want = sorted((i, j) for i, x in keys[0].items() for j, y in keys[1].items() if x & y)
    for most in (3, 1_000_000):  # blocks dealt to many parts, and to one
        assert sorted(map(tuple, matching.candidates(*sides, "a", "b", most).collect())) == want


def test_normal_forms(spark):
    emails = {"A @x.Pe": "a@x.pe", "a@b": None, "a@@b.c": None, "@x.y": None, "a@x.y": "a@x.y", "x.y": None, None: None}
    rows = spark.createDataFrame([(e,) for e in emails], "e string").select("e", matching.normal_email(F.col("e")).alias("n")).collect()
    assert {r["e"]: r["n"] for r in rows} == emails
    sources = {" AUTO-12 3 ": "auto-123", "12345678.0": "12345678", "1.5": "1.5", "-": None, "NaN": None, None: None}
    rows = spark.createDataFrame([(e,) for e in sources], "e string").select("e", matching.normal_source(F.col("e")).alias("n")).collect()
    assert {r["e"]: r["n"] for r in rows} == sources
    folded = {"Čapek Ñandú Ångström": "CAPEK NANDU ANGSTROM", "été": "ETE", "Việt": "VIET"}
    rows = spark.createDataFrame([(e,) for e in folded], "e string").select("e", text.fold(F.col("e")).alias("n")).collect()
    assert {r["e"]: r["n"] for r in rows} == folded


def test_coverage_of_stock(spark):
    day = dt.date(2024, 1, 1)
    stock = spark.createDataFrame([(k, day + dt.timedelta(days=i), v) for k, vs in {"a": [5, 10], "b": [3, 100], "c": [9], "d": [50]}.items() for i, v in enumerate(vs)], "k string, day date, closing long")
    found = {r["k"]: (r["gap"], r["quality"]) for r in absorption.coverage(stock, spark.createDataFrame([("a", 10), ("b", 95), ("d", 10), ("e", 2)], "k string, n long"), ["k"]).collect()}
    assert found == {"a": (0, "COMPLETA"), "b": (5, "PARCIAL"), "c": (9, "SIN_SNAPSHOT"), "d": (40, "INSUFICIENTE"), "e": (-2, "SIN_LEDGER")}
