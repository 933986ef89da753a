"""op4: removal of text units that occur earlier, by hashing lines and the sentences in them.

A unit is a sentence with what follows it up to the next, or a line's rest; units tile the text, and their offsets
are those of the original. Its normal form is lower case with single spaces. Digests (128 bits) of all units are
grouped globally; the occurrence with the smallest (doc_id, row, offset) is kept, where row tells rows of one id (and rows
without one) apart. A unit that occurs earlier goes if it and the adjoining units that also do have MIN_WORDS words or more together, so that short phrases that many texts share by
chance stay. A long passage goes from its first whole sentence to its last; a sentence with one word changed stays.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_batches, materialise, tidy

MIN_WORDS = 20
PACKET_BYTES = 8 << 20
REMOVED, LAST = "removed_spans", (1 << 63) - 1
#: The end of a unit: line breaks, or the white space after a sentence's end mark.
ENDS = regex.compile(r"\n\s*|(?<=[.!?…。！？])[^\S\n]+")


def units(text: str) -> list[int]:
    """The offsets at which units begin, and the text's length."""
    cuts = [m.end() for m in ENDS.finditer(text)]
    return [0, *(c for c in cuts if c < len(text)), len(text)] if text else [0]


def normal(unit: str) -> bytes:
    return " ".join(unit.lower().split()).encode()


def digest(form: bytes) -> bytes:
    return xxhash.xxh3_128_digest(form)


def row_number(packet: int, i: int) -> int:
    """Of row i of a packet: the packet's random bits and the place there."""
    return packet >> 24 << 24 | i


def _pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """packet, digest, doc, row, place (of the earliest occurrence there), n of each packet's units; its rows as one value."""
    shape = pa.schema([("packet", pa.int64()), ("digest", pa.binary()), ("doc", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("rows", pa.binary())])

    def close(held: list[pa.RecordBatch]):
        packet = int.from_bytes(os.urandom(8), "little", signed=True)
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        yield pa.RecordBatch.from_pydict({"packet": [packet], "digest": [b""], "doc": [0], "row": [0], "place": [0], "n": [0], "rows": [sink.getvalue().to_pybytes()]}, schema=shape)
        first: dict[bytes, list] = {}
        for i, (doc, text) in enumerate(zip(table.column(id_col).to_pylist(), table.column(text_col).to_pylist(), strict=True)):
            doc, row, cuts = LAST if doc is None else doc, row_number(packet, i), units(text or "")
            for a, b in zip(cuts, cuts[1:]):
                if form := normal(text[a:b]):
                    key = digest(form)
                    seen = first.get(key)
                    if seen is None:
                        first[key] = [doc, row, a, 1]
                    else:
                        seen[3] += 1
                        if (doc, row, a) < (seen[0], seen[1], seen[2]):
                            seen[:3] = doc, row, a
        keys = list(first)
        for lo in range(0, len(keys), 50_000):
            part = keys[lo : lo + 50_000]
            own = np.array([first[k] for k in part], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), packet)), pa.array(part, pa.binary()), *(pa.array(own[:, k]) for k in range(4)), pa.nulls(len(part), pa.binary())], schema=shape)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACKET_BYTES:
                yield from close(held)
                held, size = [], 0
        if sum(map(len, held)):
            yield from close(held)

    return docs.mapInArrow(tidy(run), "packet long, digest binary, doc long, row long, place long, n long, rows binary")


def removals(rank: tuple[int, ...], text: str, earlier: dict[bytes, tuple[int, ...]], least: int) -> list[tuple[int, int]]:
    """The spans to remove of the text with this rank. earlier: by digest, the rank and offset at which a unit that occurs more than once occurs first."""
    cuts, spans, start, words = units(text), [], None, 0
    for a, b in zip(cuts, cuts[1:]):
        form = normal(text[a:b])
        seen = (*rank, a) if not form else earlier.get(digest(form), (*rank, a))
        if not form and start is not None or seen != (*rank, a):
            start, words = a if start is None else start, words + len(form.split())
            continue
        if start is not None and words >= least:
            spans.append((start, a))
        start, words = None, 0
    if start is not None and words >= least:
        spans.append((start, len(text)))
    return spans


def _cleaner(names: list[str], id_col: str, text_col: str, least: int, fields: pa.Schema):
    def run(packets: pa.Table, values: pa.Table) -> pa.Table:
        if not packets.num_rows:
            return fields.empty_table()
        with pa.ipc.open_stream(packets.column("rows")[0].as_py()) as file:
            table = file.read_all()
        earlier = dict(zip(values.column("digest").to_pylist(), zip(*(values.column(c).to_pylist() for c in ("doc", "row", "place")), strict=True), strict=True))
        packet = packets.column("owner")[0].as_py()
        texts, spans = table.column(text_col).to_pylist(), []
        for i, doc in enumerate(table.column(id_col).to_pylist()):
            found = removals((LAST if doc is None else doc, row_number(packet, i)), texts[i] or "", earlier, least)
            if found:
                cuts = [0, *(x for s in found for x in s), len(texts[i])]
                texts[i] = "".join(texts[i][a:b] for a, b in zip(cuts[::2], cuts[1::2]))
            spans.append([{"start": a, "end": b} for a, b in found])
        new = {text_col: pa.array(texts, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()), REMOVED: pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
        return pa.table([new[n] if n in (text_col, "n_chars", REMOVED) else table.column(n) for n in names], names=names).cast(fields)

    return run


def remove_repeats(docs: DataFrame, least: int = MIN_WORDS, spans: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with all its columns, without units that occur earlier; n_chars, if there, is set anew.

    spans adds removed_spans: (start, end) of what went, in characters of the original text. Null texts stay null, empty ones empty; a text
    may become empty and its row stays. Null ids rank last. Of rows with one id, or without one, any comes
    first: what they share stays in one of them. An empty table stays so, and other columns, whatever their names, are carried on (one named removed_spans is
    replaced if spans are asked for).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if isinstance(docs.schema[id_col].dataType, T.LongType) is False:
        docs = docs.withColumn(id_col, F.col(id_col).cast("long"))
    if spans:
        docs = docs.drop(REMOVED)
    out = T.StructType([*docs.schema.fields, *([T.StructField(REMOVED, T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))] if spans else [])])
    made = materialise(_pack(docs, id_col, text_col), "packets")
    own = made.where("rows is null")
    first = own.groupBy("digest").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "row", "place")).alias("first")).where("n > 1")
    earlier = own.select("packet", "digest").join(materialise(first.select("digest", "first.doc", "first.row", "first.place"), "first"), "digest")
    packets = made.where("rows is not null").select(F.col("packet").alias("owner"), "rows")
    return packets.groupBy("owner").cogroup(earlier.groupBy("packet")).applyInArrow(_cleaner(out.names, id_col, text_col, least, to_arrow_schema(out)), out)
