"""Streams that keep tables: what they rewrite, refuse and hold back."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lifemart.operators import ledger
from lifemart.session import ship_code
from lifemart.streaming import exports, streams


def folder():
    return tempfile.mkdtemp(prefix="spark-")


def rows_of(table):
    return {r["k"]: r["v"] for r in table.read().collect()}


def test_buckets_rewrite_only_what_a_batch_touches(spark):
    base = folder()
    frame = lambda rows: spark.createDataFrame(rows, "k long, v long, at long")
    shape = frame([]).schema
    order = [F.col("at").desc_nulls_last(), F.col("v").desc()]
    table = exports.Buckets(spark, base, shape, ["k"], order, 8)
    assert table.read().count() == 0
    table.merge(frame([(k, 0, 1) for k in range(100)]), 0)
    assert rows_of(table) == dict.fromkeys(range(100), 0) and set(table.versions.values()) == {0} and len(table.versions) == 8
    table.merge(frame([(5, 7, 2), (5, 6, 2), (5, 9, 0), (6, 1, 0)]), 1)  # an older row changes nothing
    want = dict.fromkeys(range(100), 0) | {5: 7}
    assert rows_of(table) == want
    assert 1 <= sum(v == 1 for v in table.versions.values()) <= 2  # the buckets of 5 and 6
    table.merge(frame([]), 2)
    assert rows_of(table) == want
    again = exports.Buckets(spark, base, shape, ["k"], order, 8)  # after a restart
    again.restore(1)
    assert rows_of(again) == want
    again.merge(frame([(5, 7, 2), (5, 6, 2), (5, 9, 0), (6, 1, 0)]), 1)  # the batch again
    assert rows_of(again) == want
    again.merge(frame([(200, 1, None)]), 3)
    assert rows_of(again) == want | {200: 1}


def test_exports_only_grow(spark):
    frame = lambda rows: spark.createDataFrame(rows, "s string, i long, text string")
    first = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)]
    table = exports.Exports(spark, folder(), "s", "i", ["text"])
    held = lambda: sorted(map(tuple, table.read(frame([]).schema).collect()), key=str)
    table.load(frame(first), 0)
    assert held() == sorted(first, key=str)
    refused = {
        "changed": [("a", 1, "x"), ("a", 2, "z"), ("a", 3, "n")],
        "exchanged": [("a", 1, "y"), ("a", 2, "x")],
        "shorter": [("a", 1, "x")],
        "twice": [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z")],
        "a gap": [("a", 1, "x"), ("a", 2, "y"), ("a", 4, "n")],
        "new and told otherwise": [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "n"), ("a", 3, "m")],
        "one of two": [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "n"), ("b", 1, "")],
    }
    for what, rows in refused.items():
        with pytest.raises(exports.HistoryChanged):
            table.load(frame(rows), 1)
        assert held() == sorted(first, key=str), what
    more = [*first, ("a", 3, "n"), ("c", 1, "new")]
    table.load(frame([*more, *more]), 1)  # the same export twice
    assert held() == sorted(more, key=str)
    table.load(frame(first[2:]), 2)  # only one source
    table.load(frame([]), 3)
    assert held() == sorted(more, key=str)


def states(events):
    now, out = {}, {}
    for unit, event, _, kind in sorted(events, key=lambda e: (e[2], e[1])):
        old = now.get(unit, 0)
        now[unit] = exports.STEPS.get((kind, old), old)
        out[event] = (unit, kind, ledger.STATES[old], ledger.STATES[now[unit]], now[unit] != old)
    return out


def drawn_events(seed, n=400, units=6):
    draw = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(draw.randrange(units), i, start + dt.timedelta(minutes=draw.randrange(60 * 24 * 12)), draw.choice(["ALTA", "SEPARACION", "SEPARACION", "VENTA", "CAIDA"])) for i in range(n)]


def test_ledger_under_disorder(spark):
    ship_code(spark)
    events, path = drawn_events(1), folder()
    draw = random.Random(2)
    arrival = sorted(events, key=lambda e: e[2] + dt.timedelta(hours=draw.randrange(30)))
    shape = "unit long, event_id long, ts timestamp, kind string"
    files = [arrival[i : i + 80] for i in range(0, len(arrival), 80)]
    assert any(min(e[2] for e in b) < max(e[2] for e in a) for a, b in zip(files, files[1:], strict=False))
    for rows in [*files, [(-1, -1, dt.datetime(2024, 3, 1), "END")]]:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(path)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with exports.rocks_state(spark):
        found = streams.run_to_table(exports.ledger_under_disorder(stream, "2 days")).collect()
    assert spark.conf.get(key) == before
    assert len(found) == len(events)
    assert {r["event_id"]: (r["unit"], r["kind"], r["before_state"], r["after_state"], r["applied"]) for r in found} == states(events)


class Handle:
    """What a stateful processor asks of its handle, for one key."""

    def __init__(self):
        self.timers, self.calls = set(), 0

    def getValueState(self, name, shape):  # noqa: N802
        held = type("Value", (), {"row": None, "get": lambda self: self.row, "exists": lambda self: self.row is not None})()
        held.update = lambda row: setattr(held, "row", row)
        return held

    def getListState(self, name, shape):  # noqa: N802
        rows = []
        return type("List", (), {"get": lambda self: iter(rows), "appendValue": lambda self, row: rows.append(row), "put": lambda self, new: rows.__setitem__(slice(None), new), "clear": lambda self: rows.clear()})()

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


def test_ledger_has_one_timer_at_a_time():
    import pandas as pd

    handle, out = Handle(), []
    ledger_of = exports._Ledger()
    ledger_of.init(handle)
    events = drawn_events(4, units=5) + [(None, 1000 + i, dt.datetime(2024, 1, 2 + i), k) for i, k in enumerate(["ALTA", "SEPARACION", "CAIDA"])]
    micros = lambda e: int((e[2] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    arrival = sorted(events, key=lambda e: e[2] + dt.timedelta(hours=e[1] % 30))
    batches, top = [arrival[i : i + 90] for i in range(0, len(arrival), 90)], 0
    for limit, batch in [*((None, b) for b in batches), (10**13, [])]:
        before = handle.calls
        if batch:
            ledger_of.handleInputRows((1,), iter([pd.DataFrame([(str(e[0]) if e[0] is not None else None, e[1], micros(e), e[3]) for e in batch], columns=["unit", "event_id", "micros", "kind"])]), None)
            top = max([top, *map(micros, batch)])
            assert handle.calls - before <= 1 and len(handle.timers) == 1
        limit = limit or top // 1000 - 2 * 86_400_000
        watermark = type("Times", (), {"getCurrentWatermarkInMs": lambda self, at=limit: at})()
        for at in [x for x in handle.timers if x <= limit]:
            handle.timers.remove(at)
            out += [tuple(r) for f in ledger_of.handleExpiredTimer((1,), watermark, None) for r in f.itertuples(index=False)]
        assert len(handle.timers) <= 1
    assert not handle.timers
    found = {event: (None if unit is pd.NA else unit, kind, before, after, applied) for unit, event, kind, before, after, applied in out}
    assert len(out) == len(events) and found == states(events)


@pytest.mark.parametrize("hot", [0, 70, 1_000_000])
def test_ledger_of_hot_keys(spark, hot):
    events = drawn_events(3) + [(99, 1000 + i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), k) for i, k in enumerate(["VENTA", "CAIDA", "ALTA", "VENTA", "SEPARACION", "CAIDA", "SEPARACION", "VENTA", "VENTA", "CAIDA", "ALTA"])]
    frame = spark.createDataFrame(events, "unit long, event_id long, ts timestamp, kind string")
    found = ledger.inventory_ledger(frame, ["unit"], hot=hot).collect()
    assert {r["event_id"]: (r["unit"], r["kind"], r["before_state"], r["after_state"], r["applied"]) for r in found} == states(events)
    place = {}
    for unit, event, _, _ in sorted(events, key=lambda e: (e[2], e[1])):
        place.setdefault(unit, []).append(event)
    assert {(r["unit"], r["event_order"], r["event_id"]) for r in found} == {(u, i + 1, e) for u, es in place.items() for i, e in enumerate(es)}
    delta = {"ALTA": 1, "CAIDA": 1, "SEPARACION": -1, "VENTA": 0}
    assert all(r["delta_stock"] == (delta[r["kind"]] if r["applied"] else 0) for r in found)


SAID = {
    "Sala: 12 visitas": [("visita_reporte", 12, 12, False)],
    "hoy vinieron una visita y nada más\nferia 5-3 visitas": [("visita_reporte", 1, 1, False), ("visita_reporte", 3, 5, True)],
    "Visitas: 7": [("visita_reporte", 7, 7, True)],
    "3 a 5 visitas en la caseta": [("visita_reporte", 3, 5, True)],
    "sala, 20 atendidos": [("visita_reporte", 20, 20, False)],
    "cero visitas en feria": [("visita_reporte", 0, 0, False)],
    "No hubo visitas": [("visita_reporte", 0, 0, True)],
    "el grupo tiene 30 personas": [],
    "en sala 30 personas": [("visita_reporte", 30, 30, False)],
    "Caída del dpto 1204, 3 visitas": [],
    "Separación dpto. A-1204 precio 350": [("separacion_anuncio", None, None, False)],
    "Separación del departamento": [("separacion_anuncio", None, None, True)],
    "¡Felicidades! separación dpto 1204": [],
    "no separación dpto 1204": [],
    "Ya firmó la minuta": [("minuta_reporte", None, None, True)],
    "falta firmar minuta, no firmó la minuta": [],
    "pago de inicial dpto 301": [("pago_inicial_reporte", None, None, True)],
    "falta el pago de inicial": [],
    "una cita y bloqueo de la unidad 301": [("cita_reporte", None, None, True), ("bloqueo_stock", None, None, False)],
    "2 citas por confirmar": [],
    "Sperant caído": [("incidencia_crm", None, None, False)],
    "buenos días": [],
    "": [],
}


def test_messages_report(spark):
    from lifemart.streaming import messages

    sent = dt.datetime(2024, 5, 2, 23, 30)
    rows = [(i, sent, "Ana", text) for i, text in enumerate(SAID)] + [(100, sent, None, "Sala: 12 visitas"), (101, sent, "Ana", None), (102, sent, "Ana", "ayer 4 visitas en sala")]
    found = {}
    for r in messages.commercial_events(spark.createDataFrame(rows, "message_id long, sent_at timestamp, sender string, body string")).collect():
        found.setdefault(r["message_id"], []).append(r)
    for i, (text, want) in enumerate(SAID.items()):
        mine = sorted(found.get(i, []), key=lambda r: r["event_index"])
        assert [(r["event"], r["count_min"], r["count_max"], r["review"]) for r in mine] == want, text
        assert all(r["reported_on"] == sent.date() and r["ruleset"] == messages.VERSION for r in mine)
    assert 100 not in found and 101 not in found
    assert found[102][0]["reported_on"] == dt.date(2024, 5, 1) and found[102][0]["venue"] == "sala"
    units = {r["unit_code"] for rs in found.values() for r in rs}
    assert units == {None, "A1204"}
