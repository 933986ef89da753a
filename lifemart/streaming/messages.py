"""Commercial signals in chat messages, by versioned rules: one row for each thing a message reports. Expressions only, so it runs on tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import first_of
from ..functions.text import fold

VERSION = 2
# What counts as a report. Patterns read text without accents, in capitals.
COUNT = r"(?<!\w)(?:\d{1,3}|UNA?|CERO)\s*(?:[-–A]\s*\d{1,3})?\s*(?:VISITAS?|CLIENTES|PERSONAS|ATENCIONES?|TRANSITOS?)\b"
REVERSED = r"\b(?:VISITAS?|CLIENTES|PERSONAS|ATENCIONES?)\s*[:=]\s*\d{1,3}(?:\s*[-–A]\s*\d{1,3})?\b"
ATTENDED = r"\b\d{1,3}\s*(?:ATENDI|ATENDIO|ATENDIMOS|ATENDIDOS?)(?!\w)"
NO_VISITS = r"\b(?:NO\s+(?:LLEGARON|HUBO|TUVIMOS)|SIN)\s+(?:VISITAS?|CLIENTES?|ATENCIONES?)\b"
VISIT_CONTEXT = r"\b(?:VISITAS?|ATENDI(?:MOS|O)?|ATENCIONES?|TRANSITOS?|SALIDA|FERIA|SALA|CASETA|SHOWROOM)\b"
PEOPLE = r"\b(?:CLIENTES?|PERSONAS?)\b"
UNIT = r"\b(?:DPTO\.?|DEPARTAMENTO|UNIDAD)\s*[:.#-]*\s*((?:[A-Z]\s*-?\s*)?\d{3,4})\b"
SALE = r"\bSEPARACION\b"
SALE_CONTEXT = r"\b(?:DPTO\.?|DEPARTAMENTO|EDIFICIO|PROYECTO|UNIDAD|PRECIO|S/|\d{3,4}\b)"
CHEERS = r"\b(?:FELICITACION(?:ES)?|FELICIDADES|BUENA|BRAVO|VAMOS|ESOOO|SEPARACIONES\s+MAS)\b"
FALLEN = r"\b(?:CAIDA|ANULAD[AO])\b"
DENIED_SALE = r"\b(?:CAIDA|ANULAD[AO]|SEPARACION\?|NO\s+SEPARACION)"
#: event, pattern, pattern that speaks against it, confidence, whether it is always reviewed, note
SIGNALS = (
    ("minuta_reporte", r"\b(?:FIRMO|FIRMAD[AO])\s+(?:LA\s+)?MINUTA\b", r"\b(?:NO|SIN|FALTA)\s+(?:FIRMAR|FIRMA)\s+MINUTA\b", "media", True, "verificar_en_crm"),
    ("pago_inicial_reporte", r"\b(?:PAGO\s+(?:DE\s+)?INICIAL|INICIAL\s+(?:DPTO\.?|DEPARTAMENTO|EDIFICIO))\b", r"\b(?:PENDIENTE|FALTA|NO\s+PAGO|CUANDO)\b", "media", True, "verificar_en_crm"),
    ("cita_reporte", r"\b(?:\d+|UNA?)\s+CITAS?\b", r"\b(?:POR CONFIRMAR|NO\s+LLEGARON)\b", "baja", True, "cita_no_equivale_a_visita"),
    ("bloqueo_stock", r"\b(?:BLOQUEAD[AO]S?|BLOQUEO|NO\s+OFRECER)\b", None, "media", False, "senal_operativa"),
    ("incidencia_crm", r"\b(?:SPERANT|ERROR\s+EN\s+(?:CRM|SISTEMA))\b", None, "media", False, "senal_operativa"),
)


def _venue(text: Column) -> Column:
    return first_of((text.rlike(r"\bFERIA\b"), "feria"), (text.rlike(r"\b(?:SALA|CASETA|SHOWROOM)\b"), "sala"), (text.rlike(r"^\s*SALIDA\b"), "sala_inferida"))


def _number(text: Column) -> Column:
    return first_of((text.startswith("UN"), 1), (text == "CERO", 0), otherwise=text.try_cast("int"))


def _event(kind: str, confidence, review: Column, note, low=None, high=None, unit=None) -> Column:
    as_int = lambda x: F.lit(None).cast("int") if x is None else x.cast("int")
    as_text = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(F.lit(kind).alias("event"), as_int(low).alias("count_min"), as_int(high).alias("count_max"), as_text(confidence).alias("confidence"), review.alias("review"), as_text(note).alias("note"), as_text(unit).alias("unit_code"))


def _visits(line: Column, venue: Column) -> Column:
    """The counts of visits that a line gives, as events; people and clients only count where the line or message is about visits."""
    found = F.regexp_extract_all(line, F.lit(f"{COUNT}|{REVERSED}|{ATTENDED}"), 0)
    about = line.rlike(VISIT_CONTEXT) | venue.isNotNull()
    kept = F.filter(found, lambda m: about | ~m.rlike(PEOPLE))

    def event(m: Column) -> Column:
        numbers = F.regexp_extract_all(m, F.lit(r"\d{1,3}|\bUNA?\b|\bCERO\b"), 0)
        a = F.coalesce(_number(F.element_at(numbers, 1)), F.lit(0))
        b = F.when(F.size(numbers) > 1, _number(F.element_at(numbers, 2))).otherwise(a)
        unsure = (a != b) | ~F.coalesce(venue.isin("sala", "feria"), F.lit(False))
        return _event("visita_reporte", F.when(unsure, "baja").otherwise("media"), unsure, F.when(m.rlike(r"ATENDI"), "atenciones_explicitas").otherwise("unidad_explicita"), F.least(a, b), F.greatest(a, b))

    none = F.when((F.size(found) == 0) & line.rlike(NO_VISITS), F.array(_event("visita_reporte", "media", ~F.coalesce(venue.isin("sala", "feria"), F.lit(False)), "sin_visitas", F.lit(0), F.lit(0))))
    return F.coalesce(none, F.transform(kept, event))


def commercial_events(messages: DataFrame) -> DataFrame:
    """message_id, event_index, event, reported_on, venue, count_min, count_max, confidence, review, note, unit_code, ruleset of messages (message_id, sent_at, sender, body).

    A message without a sender or text says nothing. Reports of yesterday count for the day before. Congratulations are no announcements, and a
    message that opens with a fall gives no visits. The id of an event is its message, index and version, so older versions' rows stay as they are.
    """
    whole = fold(F.trim("body"))
    opening = F.substring(whole, 1, 120)
    venue = _venue(whole)
    visits = F.when(~F.substring(whole, 1, 100).rlike(FALLEN), F.flatten(F.transform(F.split(whole, r"\r?\n"), lambda line: _visits(line, F.coalesce(_venue(line), venue)))))
    announced = whole.rlike(SALE) & whole.rlike(SALE_CONTEXT) & ~F.substring(whole, 1, 100).rlike(CHEERS) & ~opening.rlike(DENIED_SALE)
    unit = F.nullif(F.regexp_replace(F.regexp_extract(whole, UNIT, 1), r"[\s-]+", ""), F.lit(""))
    others = [F.when(announced, _event("separacion_anuncio", "media", unit.isNull(), "anuncio_chat_no_crm", unit=unit))]
    for kind, said, denied, confidence, review, note in SIGNALS:
        against = F.lit(False) if denied is None else (F.substring(whole, 1, 100) if kind == "pago_inicial_reporte" else whole).rlike(denied)
        others.append(F.when(whole.rlike(said) & ~against, _event(kind, confidence, F.lit(review), note)))
    found = F.concat(F.coalesce(visits, F.array().cast("array<struct<event:string,count_min:int,count_max:int,confidence:string,review:boolean,note:string,unit_code:string>>")), F.array_compact(F.array(*others)))
    rows = messages.where("sender is not null and body is not null").select("message_id", "sent_at", venue.alias("venue"), opening.alias("_opening"), F.posexplode(found).alias("_i", "_e"))
    day = F.to_date("sent_at")
    return rows.select("message_id", (F.col("_i") + 1).alias("event_index"), "_e.event", F.when(F.col("_opening").rlike(r"\bAYER\b"), F.date_sub(day, 1)).otherwise(day).alias("reported_on"), "venue", "_e.count_min", "_e.count_max", "_e.confidence", "_e.review", "_e.note", "_e.unit_code", F.lit(VERSION).alias("ruleset"))
