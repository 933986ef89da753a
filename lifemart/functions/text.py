"""Parsing, cleaning and scoring of text columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



def _plain(letter: str) -> str:
    """The letter without its marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)).upper()


#: Letters of Latin scripts that are a plain letter with marks, and those plain letters.
ACCENTS = tuple(map("".join, zip(*((c, _plain(c)) for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if len(_plain(c)) == 1 and _plain(c).isascii()), strict=True)))


def business_date(text: Column) -> Column:
    """A date written YYYY-MM-DD or DD-MM-YYYY that exists in the calendar; else null."""
    iso, day_first = text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.rlike(r"^\d{2}-\d{2}-\d{4}$")
    return F.when(iso, F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")).when(day_first, F.try_to_timestamp(text, F.lit("dd-MM-yyyy")).cast("date"))


def numeric(text: Column) -> Column:
    """A number with either decimal separator: the last one counts; a lone comma only before one or two digits."""
    kept = F.regexp_replace(text, r"[^0-9,.\-]", "")
    comma, dot = F.length(kept) - F.length(F.regexp_replace(kept, ",", "")), F.length(kept) - F.length(F.regexp_replace(kept, r"\.", ""))
    last_comma = F.instr(F.reverse(kept), ",")
    last_dot = F.instr(F.reverse(kept), ".")
    plain = (
        F.when((comma > 0) & (dot > 0) & (last_comma < last_dot), F.regexp_replace(F.regexp_replace(kept, r"\.", ""), ",", "."))
        .when((comma > 0) & (dot > 0), F.regexp_replace(kept, ",", ""))
        .when((comma == 1) & kept.rlike(r",\d{1,2}$"), F.regexp_replace(kept, ",", "."))
        .when(comma > 0, F.regexp_replace(kept, ",", ""))
        .otherwise(kept)
    )
    return F.when(plain.rlike(r"^-?\d+(\.\d+)?$"), plain.cast("double"))


def normalize(text: Column) -> Column:
    """Single spaces, none at the ends; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def fold(text: Column) -> Column:
    """Upper case without accents: precomposed letters lose their marks, and marks of their own go."""
    return F.regexp_replace(F.translate(F.upper(text), *ACCENTS), r"\p{M}+", "")


def canonical_name(text: Column) -> Column:
    """The folded words of more than one letter, sorted."""
    words = F.split(F.trim(F.regexp_replace(fold(text), r"[^A-Z0-9]+", " ")), " ")
    return F.nullif(F.array_join(F.array_sort(F.filter(words, lambda w: F.length(w) > 1)), " "), F.lit(""))


def phone(text: Column) -> Column:
    """Local digits: separators, an international prefix and country code 51 removed."""
    digits = F.regexp_replace(F.regexp_replace(text, r"[^0-9]", ""), r"^00", "")
    return F.nullif(F.when((F.length(digits) == 11) & digits.startswith("51"), F.substring(digits, 3, 9)).otherwise(digits), F.lit(""))


def phone_ok(text: Column) -> Column:
    return F.coalesce(phone(text).rlike(r"^9\d{8}$"), F.lit(False))


def email_ok(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).rlike(r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"), F.lit(False))


def document8(text: Column) -> Column:
    """An eight-digit identity number, if the text is one."""
    return F.when(F.trim(text).rlike(r"^\d{8}$"), F.trim(text))


def quality_score(name_ok: Column, document_ok: Column, phone_good: Column, email_good: Column, channel_ok: Column, project_ok: Column) -> Column:
    """100 less penalties; no way of contact costs most."""
    bad = lambda ok, n: F.when(~ok, n).otherwise(0)
    return F.greatest(F.lit(0), F.lit(100) - bad(name_ok, 15) - bad(document_ok, 15) - bad(phone_good | email_good, 40) - bad(channel_ok, 10) - bad(project_ok, 10) - F.when(~phone_good & email_good, 20).otherwise(0))


def unit_type(text: Column) -> Column:
    low = F.lower(text)
    kinds = (("departamento", "DEPARTAMENTO"), ("estacionamiento", "ESTACIONAMIENTO"), ("deposito", "DEPOSITO"), ("local", "LOCAL"))
    out = F.lit("OTRO")
    for key, name in reversed(kinds):
        out = F.when(low.contains(key), name).otherwise(out)
    return out


def tags(text: Column, taxonomy: dict[str, list[str]], fallback: str) -> Column:
    """All labels whose keywords occur; the fallback if none does."""
    low = F.lower(text)
    found = F.array_compact(F.array(*(F.when(_any([low.contains(k) for k in keys]), label) for label, keys in taxonomy.items())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(fallback)))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def surrogate_key(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def hmac_sha256(key: bytes, text: Column) -> Column:
    """Lower-case hex, from SHA-256 and the two padded keys."""
    padded = key.ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in padded).hex() for pad in (0x36, 0x5C))
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(text, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)
