"""op6: canonical exact digests of documents.

A text's canonical form is NFKC, case-folded, NFKC again, with each run of white space as one space and none at
the ends. Its digest is the 128-bit xxh3 of that form. Documents with one digest form a bucket, and inside a
bucket of several the forms themselves are compared (the aggregation key holds the bytes): a form that differs
from the bucket's first, by id, gets a suffix, so that equal fingerprints always mean equal forms.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialise, tidy

#: Bits of the filter that spares unique forms the shuffle: eight for each repeated digest, this many at most.
FILTER_BITS = 1 << 27


def canonical(text: str) -> str:
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(text.split())


def digest(form: str) -> str:
    return xxhash.xxh3_128_hexdigest(form.encode())


def _bit(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name)


def later_forms(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """doc_id, fingerprint, variant (2, 3, ...) of documents whose form shares its digest with an earlier, different form.

    docs: doc_id, text; digests: doc_id, fingerprint of all of them. A filter of bounded size, set by the digests
    that occur twice or more, keeps most unique forms out of the shuffle; copies meet as one row a task before it.
    """
    again = materialise(digests.groupBy("fingerprint").count().where("count > 1").select("fingerprint"), "digests")
    bits = min(FILTER_BITS, 1 << max(10, (8 * again.count()).bit_length()))

    def places(batches):
        for batch in batches:
            at = np.array([_bit(x) & (bits - 1) for x in batch.column("fingerprint").to_pylist()], np.int64)
            yield pa.RecordBatch.from_pydict({"word": at >> 6, "bit": np.left_shift(np.int64(1), at & 63)})

    words = again.mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # as many as the filter has words at most
    mask = np.zeros(bits >> 6, np.int64)
    mask[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(mask)

    def forms(batches):
        for batch in batches:
            ids, names, kept = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                form = canonical(text)
                at = _bit(name := digest(form)) & (bits - 1)
                if held.value[at >> 6] >> (at & 63) & 1:
                    ids.append(doc_id)
                    names.append(name)
                    kept.append(form)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "fingerprint": names, "form": kept}, schema=shape)

    shape = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), ("form", pa.string())])
    members = docs.mapInArrow(forms, "doc_id long, fingerprint string, form string")
    kinds = members.groupBy("fingerprint", "form").agg(F.min("doc_id").alias("first"))
    mixed = materialise(kinds.groupBy("fingerprint").agg(F.count("*").alias("kinds")).where("kinds > 1").select("fingerprint"), "mixed")
    if mixed.isEmpty():  # no two forms share a digest
        return digests.where("false").select("doc_id", "fingerprint", F.lit(1).alias("variant"))
    order = Window.partitionBy("fingerprint").orderBy(F.col("first").asc_nulls_last(), "form")
    later = kinds.join(mixed, "fingerprint", "left_semi").withColumn("variant", F.row_number().over(order)).where("variant > 1")
    return members.join(later, ["fingerprint", "form"]).select("doc_id", "fingerprint", "variant").distinct()


def _row(doc_id, text: str, form: str, following: str, next_form: str) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + following[:cut]
    same = (edited_form := canonical(edited)) == form
    name = digest(form)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), name, name if same else digest(edited_form), float(same), float(next_form == form)


def _in_order(batches):
    """ROW: the rows of a sorted part but its last, each with the one after it; FIRST and LAST: the texts at its ends."""
    part, held, rows = TaskContext.get().partitionId(), None, []
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = (doc_id, text, canonical(text))
            if held is None:
                yield _table([(FIRST, part, doc_id, *[None] * 6, text)], _PART)
            else:
                rows.append((ROW, part, *_row(*held, *own[1:]), None))
            held = own
        yield _table(rows, _PART)
        rows = []
    if held:
        yield _table([(LAST, part, held[0], *[None] * 6, held[1])], _PART)


def _at_seams(batches):
    for batch in batches:
        yield _table([_row(doc_id, text, canonical(text), following, canonical(following)) for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True)], _OWN)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


ROW, FIRST, LAST = 0, 1, 2
_OWN = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_PART = pa.schema([("kind", pa.int8()), ("part", pa.int32()), *_OWN, ("text", pa.string())])
SHAPE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document.

    The next document is the one with the next smaller id (null ids come last, equal ids by a hash of the text); after
    the last comes the first. An exact fingerprint is like another (1) only if the canonical forms are equal, else 0.
    Texts are dealt to sorted ranges of ids and hashes, so that each meets its follower and no id makes a range large;
    only the texts at the ends of ranges meet in a join. Null text: empty; a single document follows itself; an empty
    table gives an empty one.
    """
    docs = documents(docs)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    made = materialise(ranged.mapInArrow(tidy(_in_order), f"kind byte, part int, {SHAPE}, text string"), "ranges")
    first, last = (made.where(F.col("kind") == k).select("part", "doc_id", "text") for k in (FIRST, LAST))
    parts = Window.orderBy("part")  # one number for each range
    after = first.select("part", F.coalesce(F.lead("part").over(parts), F.min("part").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    seams = last.join(after, "part").join(first.select(F.col("part").alias("next"), F.col("text").alias("following")), "next")
    names = SHAPE.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    found = made.where(F.col("kind") == ROW).select(*names).unionByName(seams.select("doc_id", "text", "following").mapInArrow(_at_seams, SHAPE))
    later = later_forms(docs, found.select("doc_id", "fingerprint"))
    named = F.concat_ws("-", "fingerprint", "variant")
    same = F.col("near_edited") == 1
    return found.join(later, ["doc_id", "fingerprint"], "left").select(
        "doc_id", "n_chars", "edited_sha256", named.alias("fingerprint"), F.when(same, named).otherwise(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next"
    )
