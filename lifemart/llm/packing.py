"""op2: documents as token sequences of bounded length, packed by best fit over a histogram of lengths.

The plan is made from how many pieces have each length, not from pieces: lengths go from long to short, and all
pieces of a length are put at once into the open sequences with the least room that still takes them, as ranges
of ranks to ranges of sequences. The plan has some entries for each pair of a length and a room at most, whatever
the number of documents. A piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialise, tidy
from .encoding import read_vocabulary
from .merges import SPLIT, byte_symbols

_encoders: dict[int, object] = {}


class LibraryEncoder:
    """Byte-level BPE of a tokenizers file by a compiled library; equal to the file's own where ids follow the merges."""

    def __init__(self, spec: str):
        read = json.loads(spec)
        symbols, self.special = byte_symbols(), {t["content"]: t["id"] for t in read["added_tokens"]}
        vocab = read["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        if [vocab[a + b] for a, b in pairs] != list(range(256, 256 + len(pairs))):
            raise ValueError("the ids don't follow the merges")
        ranks = {bytes(symbols[c] for c in s): i for s, i in vocab.items() if s not in self.special}
        self.code = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def encode(self, text: str) -> list[int]:
        if self.marks and any(s in text for s in self.special):
            ids: list[int] = []
            for part in self.marks.split(text):
                ids += [self.special[part]] if part in self.special else self.code.encode_ordinary(part)
            return ids
        return self.code.encode_ordinary(text)


def library_encoder(spec: str) -> LibraryEncoder:
    key = hash(spec)
    if key not in _encoders:
        _encoders[key] = LibraryEncoder(spec)
    return _encoders[key]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset): best fit, longest first. Pieces from one entry's first rank up to
    the next entry's of that length lie at the offset in consecutive sequences. Exact for any counts."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    rows, made = [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, bins: int, free: int, length: int = length) -> int:
            """Puts pieces into bins that have this much room, each as full as it gets; the number of bins used."""
            nonlocal left, rank
            each = free // length
            whole, rest = min(bins, left // each), 0
            if whole < bins:
                rest = min(each, left - whole * each)
            for at, n, k in ((first, whole, each), (first + whole, 1, rest)):
                if n and k:
                    for i in range(k):
                        rows.append((length, rank, at, capacity - free + i * length))
                        rank += n
                    left -= n * k
                    if free > k * length:
                        room[free - k * length].append((at, n))
            return whole + bool(rest)

        for free in range(length, capacity + 1):
            while left and room[free]:
                first, bins = room[free].pop()
                if (used := fill(first, bins, free)) < bins:
                    room[free].append((first + used, bins - used))
            if not left:
                break
        if left:
            made += fill(made, left, capacity)
    return rows


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids if asked for) of each piece of each document's ids and the end id."""
    docs = documents(docs)
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches):
        code = library_encoder(held.value)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = code.encode(text)
                own.append(end_id)
                raw, n = np.array(own, "<u4"), len(own)
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(raw[a:b].tobytes()))
                    if ids:
                        out["ids"].append(own[a:b])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if ids else []))
    return docs.mapInArrow(tidy(run), "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else ""))


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset: no sequence is longer than capacity, and places are gapless from 0.

    Documents longer than capacity are cut so that the first piece is the short one. A null or empty text is the
    end id alone. Repeated rows are packed one by one, and an empty table gives an empty result. Pieces of one length, a
    hot one too, are ranked in parts by the hash of a row number (so rows that repeat an id are spread as well), as many as a
    part of the most frequent length has rows (the root of its count): neither the parts nor the sums over them grow
    large. Only the counts of lengths (capacity rows) go to the driver.
    """
    cut = materialise(pieces(docs, vocabulary, capacity, end_id, ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = math.isqrt(max(counts.values(), default=0)) + 1
    salted = cut.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = salted.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "part").orderBy("row")
    ranked = salted.withColumn("rank", F.row_number().over(own)).join(ahead, ["length", "part"]).withColumn("rank", F.col("rank") - 1 + F.col("ahead")).drop("part", "ahead")
    rows = np.array(plan(counts, capacity), np.int64).reshape(-1, 4)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    held = docs.sparkSession.sparkContext.broadcast(rows)

    def place(batches):
        lengths = held.value[:, 0]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                lo, hi = np.searchsorted(lengths, [n, n + 1])
                on = length == n
                at[on] = lo + np.searchsorted(held.value[lo:hi, 1], rank[on], side="right") - 1
            row = held.value[at]
            own = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])], [*own, "sequence_id", "offset"])

    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else []), F.col("rank").cast("long").alias("rank"))
    return kept.mapInArrow(tidy(place), "doc_id long, piece int, start long, length long, ids_crc32 long, " + ("ids array<int>, " if ids else "") + "sequence_id long, offset long")
