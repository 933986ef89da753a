"""Matching of people: block keys, similarity of names, emails and phones, status and best match."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.rules import first_of
from ..session import written

STATUSES = ("NO MATCH", "REVISAR", "PROBABLE", "CONFIRMADO")
#: Texts that say nothing.
EMPTY = ("", "-", "none", "null", "nan", "n/a")
#: Pairs of a block that one task makes; a block of more is dealt to several.
PAIRS = 1_000_000
#: Texts shorter than this are compared many pairs at a time, so many at once; difflib counts frequent letters of longer ones differently.
SHORT, BATCH = 200, 4096


def normal_email(email: Column) -> Column:
    """Lower case without blanks, if it has one @ with something before it and a dot after it."""
    low = F.replace(F.lower(email), F.lit(" "), F.lit(""))
    return F.when(low.rlike(r"^[^@]+@[^@]*\.[^@]*$"), low)


def normal_source(document: Column) -> Column:
    """The key that a source gives a person: lower case without blanks and without a number's .0; made-up keys stay keys."""
    low = F.lower(F.trim(document))
    return F.when(~low.isin(*EMPTY), F.regexp_replace(F.regexp_replace(low, r"^(\d+)\.0$", "$1"), r"\s+", ""))


def normal_phone(phone: Column) -> Column:
    """Digits without an international prefix; nine of them after country code 51; at most the last 15."""
    digits = F.regexp_replace(F.regexp_replace(phone, r"\D", ""), r"^00", "")
    return F.nullif(F.when((F.length(digits) >= 11) & (F.substring(F.right(digits, F.lit(11)), 1, 2) == "51"), F.right(digits, F.lit(9))).otherwise(F.right(digits, F.lit(15))), F.lit(""))


def identity(df: DataFrame, key: str, document: Column, name: Column, phone: Column, email: Column, *more: Column) -> DataFrame:
    """key, document (of eight digits), source (as the source writes it), name, canonical, phone, email in normal form, and the columns in more."""
    return df.select(key, text.document8(document).alias("document"), normal_source(document).alias("source"), text.normalize(text.fold(name)).alias("name"), text.canonical_name(name).alias("canonical"), normal_phone(phone).alias("phone"), normal_email(email).alias("email"), *more)


def block_keys() -> Column:
    """What two records of one person may share: document, source key, email, its first letters and domain, phone, its last six digits, and each of the three longest words of the name."""
    local, domain = F.substring_index("email", "@", 1), F.substring_index("email", "@", -1)
    words = F.filter(F.split("canonical", " "), lambda w: F.length(w) >= 4)
    longest = F.transform(F.slice(F.array_sort(F.transform(words, lambda w, i: F.struct((-F.length(w)).alias("n"), i.alias("i"), w.alias("w")))), 1, 3), lambda x: F.concat(F.lit("N:"), x["w"]))
    keys = [F.concat(F.lit(kind + ":"), value) for kind, value in (("D", F.col("document")), ("I", F.col("source")), ("E", F.col("email")), ("P", F.concat(F.substring(local, 1, 3), F.lit("@"), domain)), ("T", F.col("phone")), ("S", F.when(F.length("phone") >= 6, F.right("phone", F.lit(6)))))]
    return F.array_distinct(F.concat(F.array_compact(F.array(*keys)), F.coalesce(longest, F.array().cast("array<string>"))))


def _keyed(df: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """key, keys of each record that shares a block: its shared blocks with their pairs, rarest first."""
    blocks = df.select(key, F.explode("blocks").alias("block")).join(sizes, "block")
    return blocks.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("pairs", "block", "parts", "left_larger"))).alias("keys"))  # as many as kinds of keys and words


def candidates(left: DataFrame, right: DataFrame, left_key: str, right_key: str, pairs_of_task: int = PAIRS, carried: tuple[str, ...] = ()) -> DataFrame:
    """left_key, right_key of every pair that shares a block key, once, with the columns in carried as l_ and r_ ones. Keys should be each record's own.

    A pair is made in the rarest block that both records have, which each task sees from the blocks that come with the records, so no pair is
    made twice and pairs are never shuffled, nor joined to what is carried. A block of more than pairs_of_task pairs is dealt: the larger side's
    records go to one part each, the smaller side's to every part. No block is cut. Records are put in normal form and keyed once.
    """
    left, right = (written(df.select(key, *carried, block_keys().alias("blocks")), "people") for df, key in ((left, left_key), (right, right_key)))
    n = lambda df, name: df.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.count("*").alias(name))
    sizes = n(left, "a").join(n(right, "b"), "block").select("block", (F.col("a") * F.col("b")).alias("pairs"), F.least(F.greatest("a", "b"), F.ceil(F.col("a") * F.col("b") / pairs_of_task)).cast("int").alias("parts"), (F.col("a") >= F.col("b")).alias("left_larger"))

    def dealt(df: DataFrame, key: str, side: str, larger: Column) -> DataFrame:
        rows = _keyed(df, key, sizes)
        if carried:
            rows = rows.join(df.select(key, *(F.col(c).alias(f"{side}_{c}") for c in carried)), key)
        kept = [key, *(f"{side}_{c}" for c in carried)]
        rarer = F.slice(F.transform("keys", lambda x: x["block"]), F.lit(1), F.col("place")).alias(f"{side}_rarer")
        rows = rows.select(*kept, "keys", F.posexplode("keys").alias("place", "own")).select(*kept, rarer, "own")
        own = F.pmod(F.xxhash64(key), F.col("own.parts")).cast("int")
        places = F.when(larger, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("own.parts") - 1))
        return rows.select(*kept, f"{side}_rarer", F.col("own.block").alias("block"), F.explode(places).alias("part"))

    a, b = dealt(left, left_key, "l", F.col("own.left_larger")), dealt(right, right_key, "r", ~F.col("own.left_larger"))
    return a.join(b, ["block", "part"]).where(~F.arrays_overlap("l_rarer", "r_rarer")).select(left_key, right_key, *(f"{side}_{c}" for side in "lr" for c in carried))


def block_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """kind, blocks, pairs, largest: how many pairs each kind of key makes, and the pairs of its largest block."""
    n = lambda df, name: df.select(F.explode(block_keys()).alias("block")).groupBy("block").agg(F.count("*").alias(name))
    pairs = n(left, "a").join(n(right, "b"), "block").select(F.substring("block", 1, 1).alias("kind"), (F.col("a") * F.col("b")).alias("pairs"))
    return pairs.groupBy("kind").agg(F.count("*").alias("blocks"), F.sum("pairs").alias("pairs"), F.max("pairs").alias("largest"))


def ratio(x: str, y: str) -> float:
    """The share of letters in matching blocks (Ratcliff and Obershelp), in percent; it depends on the order."""
    return round(100.0 * SequenceMatcher(None, x, y).ratio(), 2) if x and y else 0.0


@lru_cache(maxsize=1)
def _percents() -> np.ndarray:
    """The ratio by letters in matching blocks and letters of both texts, rounded as ratio does."""
    return np.array([[round(100.0 * (2.0 * m / n), 2) if n else 0.0 for n in range(2 * SHORT)] for m in range(SHORT)])


def _letters(texts: list[str]) -> np.ndarray:
    """The code points of each text in a column, zeros behind its end."""
    width = max(map(len, texts))
    codes = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)
    return np.ascontiguousarray(codes.T)


def _pieces(letters: np.ndarray, pair: np.ndarray, low: np.ndarray, high: np.ndarray, behind: int) -> np.ndarray:
    """letters of each piece from low to high in a column, behind where it has ended."""
    place = low + np.arange((high - low).max())[:, None]
    return np.where(place < high, letters[np.minimum(place, len(letters) - 1), pair], letters.dtype.type(behind))


def _longest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, begin in a, begin in b) of the longest common run of each column; the first in a, then in b, of equal ones."""
    n = a.shape[1]
    best, end_a, end_b = (np.zeros(n, np.int64) for _ in range(3))
    last, run = np.zeros((len(b) + 1, n), np.uint8), np.zeros((len(b) + 1, n), np.uint8)
    for i, letter in enumerate(a):
        np.add(last[:-1], 1, out=run[1:])
        run[1:] *= (b == letter).view(np.uint8)
        longest = run.max(axis=0)
        better = np.flatnonzero(longest > best)
        if len(better):
            best[better], end_a[better], end_b[better] = longest[better], i + 1, run[:, better].argmax(axis=0)
        last, run = run, last
    return best, end_a - best, end_b - best


def _matching(x: list[str], y: list[str]) -> np.ndarray:
    """Letters in matching blocks of each pair of texts, neither empty nor of SHORT letters: the longest common run, then those left and right of it, of all pairs together."""
    a, b = _letters(x), _letters(y)
    bare = max(a.max(), b.max()) < 254
    a, b = (v.astype(np.uint8 if bare else np.uint32) for v in (a, b))
    over = (254, 255) if bare else (0xFFFFFFFE, 0xFFFFFFFF)  # no letters
    found = np.zeros(len(x), np.int64)
    pair = np.arange(len(x))
    a_low, b_low = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    a_high, b_high = (np.fromiter(map(len, v), np.int64, len(x)) for v in (x, y))
    while len(pair):
        length, i, j = _longest(_pieces(a, pair, a_low, a_high, over[0]), _pieces(b, pair, b_low, b_high, over[1]))
        found += np.bincount(pair, length, len(x)).astype(np.int64)
        i, j = i + a_low, j + b_low
        left, right = (length > 0) & (i > a_low) & (j > b_low), (length > 0) & (i + length < a_high) & (j + length < b_high)
        ends = i + length, j + length
        pair, a_low, a_high, b_low, b_high = (np.concatenate((u[left], v[right])) for u, v in ((pair, pair), (a_low, ends[0]), (i, a_high), (b_low, ends[1]), (j, b_high)))
    return found


def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """ratio of each pair of texts. Short ones, as names, phones and emails are, are compared together."""
    x, y = a.fillna("").to_numpy(object), b.fillna("").to_numpy(object)
    m, n = (np.fromiter(map(len, v), np.int64, len(v)) for v in (x, y))
    out = np.zeros(len(x))
    for k in np.flatnonzero((m > 0) & (n > 0) & ((m >= SHORT) | (n >= SHORT))):
        out[k] = ratio(x[k], y[k])
    short = np.flatnonzero((m > 0) & (n > 0) & (m < SHORT) & (n < SHORT))
    for begin in range(0, len(short), BATCH):
        k = short[begin : begin + BATCH]
        out[k] = _percents()[_matching(x[k].tolist(), y[k].tolist()), m[k] + n[k]]
    return pd.Series(out)


def word_jaccard(x: Column, y: Column) -> Column:
    a, b = F.array_distinct(F.split(x, " ")), F.array_distinct(F.split(y, " "))
    return 100.0 * F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def name_score(a: str, b: str) -> Column:
    """The best of the ratio of names, that of their sorted words and the Jaccard of words. a, b: prefixes of the columns of a pair."""
    similar = F.pandas_udf(ratios, "double")
    x, y = (F.coalesce(f"{p}_canonical", F.lit("")) for p in (a, b))
    best = F.greatest(similar(F.coalesce(f"{a}_name", F.lit("")), F.coalesce(f"{b}_name", F.lit(""))), similar(x, y), word_jaccard(x, y))
    return F.when(F.col(f"{a}_name").isNull() | F.col(f"{b}_name").isNull(), 0.0).otherwise(F.round(best, 2))


def email_score(a: str, b: str) -> Column:
    x, y = F.col(f"{a}_email"), F.col(f"{b}_email")
    part = lambda c, i: F.substring_index(c, "@", i)
    similar = F.pandas_udf(ratios, "double")
    own, local, same = similar(x, y), similar(part(x, 1), part(y, 1)), part(x, -1) == part(y, -1)
    return first_of((x.isNull() | y.isNull(), 0.0), (x == y, 100.0), (same, F.round(F.least(F.greatest(own, 0.8 * local + 20.0), F.lit(100.0)), 2)), otherwise=F.round(F.least(own, F.lit(92.0)), 2))


def phone_score(a: str, b: str) -> Column:
    x, y = F.col(f"{a}_phone"), F.col(f"{b}_phone")
    tail = (F.length(x) >= 7) & (F.length(y) >= 7) & (F.right(x, F.lit(7)) == F.right(y, F.lit(7)))
    return first_of((x.isNull() | y.isNull(), 0.0), (x == y, 100.0), (tail, 96.0), otherwise=F.pandas_udf(ratios, "double")(x, y))


def match(document: Column, name: Column, phone: Column, email: Column) -> tuple[Column, Column]:
    """(status, score) of a pair by its scores of 0 to 100: equal documents, two contacts, name and contact, partial evidence."""
    best, other = F.greatest(email, phone), F.least(email, phone)
    plain = F.round(0.45 * best + 0.30 * other + 0.25 * name, 2)
    cases = (
        (document >= 100, "CONFIRMADO", F.lit(100.0)),
        ((email >= 99) & (phone >= 99), "CONFIRMADO", F.greatest(plain, F.lit(99.0))),
        ((name >= 92) & (best >= 99), "CONFIRMADO", F.greatest(plain, F.lit(97.0))),
        (((name >= 88) & (best >= 94)) | ((email >= 97) & (phone >= 94)), "PROBABLE", F.greatest(plain, F.lit(90.0))),
        ((name >= 82) & (best >= 88), "REVISAR", F.greatest(plain, F.lit(80.0))),
    )
    return first_of(*((c, s) for c, s, _ in cases), otherwise="NO MATCH"), first_of(*((c, v) for c, _, v in cases), otherwise=plain)


def matched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The candidates of both sides with document_score, name_score, phone_score, email_score, status and score."""
    both = candidates(left, right, left_key, right_key, carried=("document", "name", "canonical", "phone", "email"))
    scores = both.select(left_key, right_key, F.when(F.col("l_document") == F.col("r_document"), 100.0).otherwise(0.0).alias("document_score"), name_score("l", "r").alias("name_score"), phone_score("l", "r").alias("phone_score"), email_score("l", "r").alias("email_score"))
    status, score = match(F.col("document_score"), F.col("name_score"), F.col("phone_score"), F.col("email_score"))
    return scores.withColumns({"status": status, "score": score})


def best_match(found: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row of each left key: by status, score, document, contact and name, then the smallest right key."""
    rank = first_of(*((F.col("status") == s, i) for i, s in enumerate(STATUSES)), otherwise=0)
    order = F.struct(rank.alias("rank"), "score", "document_score", F.greatest("email_score", "phone_score").alias("contact"), "name_score", (-F.col(right_key)).alias("key"))
    return found.groupBy(left_key).agg(F.max_by(F.struct(right_key, "status", "score"), order).alias("best")).select(left_key, "best.*")
