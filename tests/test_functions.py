"""Golden values of functions and operators on small tables made by hand."""

import datetime
import hashlib
import hmac

from pyspark.sql import functions as F

from lifemart.functions import rules, text
from lifemart.operators.ledger import inventory_ledger
from lifemart.operators.temporal import as_of_before, first_after, latest
from lifemart.sources import ingest
from lifemart.streaming import streams


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_business_date(spark):
    d = datetime.date
    assert column(spark, ["2024-02-29", "29-02-2024", "31-02-2024", "2024-2-1", "", None], text.business_date) == [d(2024, 2, 29), d(2024, 2, 29), None, None, None, None]


def test_numeric(spark):
    assert column(spark, ["1.234,56", "1,234.56", "12,5", "1,234", "S/ 10", "1.2.3", None], text.numeric) == [1234.56, 1234.56, 12.5, 1234.0, 10.0, None, None]


def test_contacts(spark):
    assert column(spark, ["+51 987 654 321", "0051987654321", "987-654-321", "", None], text.phone) == ["987654321", "987654321", "987654321", None, None]
    assert column(spark, ["a@b.pe", "a@b", None], text.email_ok) == [True, False, False]
    assert column(spark, ["12345678", "auto-12345678", None], text.document8) == ["12345678", None, None]
    assert column(spark, ["  José   Pérez e ", " ", None], text.canonical_name) == ["JOSE PEREZ", None, None]


def test_hmac(spark):
    assert column(spark, ["abc", ""], lambda c: text.hmac_sha256(b"key", c)) == [hmac.new(b"key", s, hashlib.sha256).hexdigest() for s in (b"abc", b"")]


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(rules.ratio(F.lit(1), F.lit(0)).alias("r")).first()["r"] is None


def events(spark):
    t = lambda day, hour: datetime.datetime(2024, 1, day, hour)
    rows = [(1, t(1, 0), 1, "ALTA"), (1, t(2, 0), 2, "SEPARACION"), (1, t(2, 0), 3, "SEPARACION"), (1, t(20, 0), 4, "VENTA"), (1, t(21, 0), 5, "CAIDA"), (2, t(1, 0), 6, "VENTA")]
    return spark.createDataFrame(rows, "unit long, ts timestamp_ntz, event_id long, kind string")


def test_ledger_over_weeks(spark):
    rows = inventory_ledger(events(spark), ["unit"]).orderBy("unit", "event_order").collect()
    assert [(r["event_id"], r["after_state"], r["applied"], r["delta_stock"]) for r in rows] == [(1, "AVAILABLE", True, 1), (2, "SEPARATED", True, -1), (3, "SEPARATED", False, 0), (4, "SOLD", True, 0), (5, "AVAILABLE", True, 1), (6, "NOT_OFFERED", False, 0)]


def test_as_of_is_strict_and_forward_takes_ties(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 3)], "k string, t int")
    right = spark.createDataFrame([("a", 1, 10), ("a", 5, 20), ("a", None, 30)], "k string, w int, v int")
    before = {(r["k"], r["t"]): r["v"] for r in as_of_before(left, right, ["k"], "t", "w", ["v"]).collect()}
    assert before == {("a", 5): 10, ("a", 1): None, ("b", 3): None}
    ahead = {(r["k"], r["t"]): r["v"] for r in first_after(left, right, ["k"], "t", "w", ["v"]).collect()}
    assert ahead == {("a", 5): 20, ("a", 1): 10, ("b", 3): None}


def test_latest_puts_nulls_last(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (1, 4, "z")], "k int, o int, v string")
    assert latest(rows, ["k"], F.col("o").desc_nulls_last()).first()["v"] == "y"


def test_scan_and_hash(spark):
    rows = spark.createDataFrame([(1, datetime.datetime(2026, 8, 4, 12), "a"), (2, datetime.datetime(2026, 8, 4, 11), "b")], "id long, at timestamp_ntz, name string")
    assert [r["id"] for r in ingest.scan_since(rows, ["id"], "at", "2026-08-06 12:00:00", "48 HOURS").collect()] == [1]
    old = spark.createDataFrame([(1, "a"), (3, "c")], "id long, name string")
    new = spark.createDataFrame([(1, "A"), (2, None)], "id long, name string")
    assert {r["id"]: r["what"] for r in ingest.incremental_by_hash(new, old, ["id"], ["name"]).collect()} == {1: "UPDATE", 2: "INSERT", 3: "DELETE"}


def test_chat_lines(spark):
    lines = ["noise", "[2024-01-01 10:00] Ana: hola", "sigue", "[2024-01-01 10:00] Ana: hola", "sigue"]
    rows = streams.parse_chat_lines(spark.createDataFrame([("s", i, x) for i, x in enumerate(lines)], "source string, line_no long, text string")).orderBy("ordinal").collect()
    assert [(r["sender"], r["body"]) for r in rows] == [("Ana", "hola\nsigue")] * 2
    assert rows[0]["message_id"] != rows[1]["message_id"]
