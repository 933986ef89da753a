"""op1: language-model scores of texts by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ORDER bytes, held as a table of grams (context and next symbol) with
their counts in the training texts. A symbol is coded at the longest context that has seen it; each longer
context costs an escape, estimated at half a count for each distinct symbol it has seen, which those symbols give
up (method D), and symbols that a longer context has seen are excluded from the shorter ones. The symbols that context x has seen are a subset of
those that x without its first byte has, so what is left after exclusion are plain differences of counts, and
the code length of a gram follows from that of the gram one byte shorter: one join and one window a level.

Texts travel in packets of some MB. A packet sends only its distinct grams and words to the global tables and gets their
values back, so the shuffles grow with the vocabulary of packets and not with positions. A symbol's 9 bits hold a byte,
the end of the text or the pad before its start; grams are whole numbers of 9 bits for each symbol.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, give_back, materialise, tidy
from .quality import held_out
from .words import folded, words_of

ORDER = 5
END, PAD, BITS, ALPHABET = 256, 257, 9, 257
PACKET_BYTES = 32 << 20
CHUNK = 1 << 19
#: Keys that wait to be merged into those of a packet.
MOST_WAITING = 1 << 19
#: The key of a text's end as a token.
END_KEY = -(1 << 63)


def spelled(texts: list[bytes]):
    """(text numbers, keys) of the words: negative, where grams aren't, and never that of the end."""
    for owner, keys in words_of(texts):
        keys = (keys | np.uint64(1 << 63)).view(np.int64)
        yield owner, np.where(keys == END_KEY, END_KEY + 1, keys)


def gram_chunks(texts: list[bytes], order: int):
    """(text numbers, grams) of all positions of the texts and of their ends, about CHUNK at a time."""
    owner, parts, counts, size = [], [], [], 0

    def made():
        stream = np.concatenate(parts).astype(np.int64)
        grams = np.zeros(len(stream) - order, np.int64)
        for k in range(order + 1):
            grams = grams << BITS | stream[k : k + len(grams)]
        keep = np.concatenate([np.concatenate([np.zeros(order, bool), np.ones(n, bool)]) for n in counts])[order:]
        return np.repeat(owner, counts), grams[keep]

    for i, text in enumerate(texts):
        body = np.concatenate([np.full(order, PAD, np.uint16), np.frombuffer(text, np.uint8), np.array([END], np.uint16)])
        for lo in range(0, len(body) - order, CHUNK):
            part = body[lo : lo + order + CHUNK]
            owner.append(i)
            parts.append(part)
            counts.append(len(part) - order)
            size += len(part)
            if size >= CHUNK:
                yield made()
                owner, parts, counts, size = [], [], [], 0
    if parts:
        yield made()


class Tally:
    """Sorted keys and their counts; what is added waits until it is as much as what is there."""

    def __init__(self):
        self.key, self.count, self.waiting, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        key, count = np.unique(keys, return_counts=True)
        self.waiting.append((key, count * weight))
        self.size += len(key)
        if self.size >= max(MOST_WAITING, len(self.key) // 2):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            key, count = (np.concatenate(x) for x in zip((self.key, self.count), *self.waiting, strict=True))
            self.waiting, self.size = [], 0
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            self.key, self.count = key[first], np.add.reduceat(count, first) if len(first) else count
        return self.key, self.count


def _packets(docs: DataFrame, order: int) -> DataFrame:
    """packet, key, n (count in training texts) of each packet's distinct grams and words, and its texts as one row."""
    shape = pa.schema([("packet", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("texts", pa.binary())])

    def run(batches):
        sink = None
        for batch in batches:
            if not len(batch):
                continue
            if sink is None:
                sink, size, tally = pa.BufferOutputStream(), 0, Tally()
                out = pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6)))
            out.write_batch(batch)
            size += batch.column("text").nbytes
            texts, apart = [folded(t) for t in batch.column("text").to_pylist()], batch.column("held_out").to_numpy(zero_copy_only=False)
            for parts in (gram_chunks(texts, order), spelled(texts)):
                for owner, keys in parts:
                    out_of_it = apart[owner]
                    tally.add(keys[~out_of_it], 1)
                    tally.add(keys[out_of_it], 0)
            tally.add(np.full(int((~apart).sum()), END_KEY), 1)
            tally.add(np.array([END_KEY]), 0)
            del texts, batch
            if size >= PACKET_BYTES:
                yield from close(sink, out, tally)
                sink = out = tally = None
                give_back()
        if sink is not None:
            yield from close(sink, out, tally)

    def close(sink: pa.BufferOutputStream, out: pa.ipc.RecordBatchStreamWriter, tally: Tally):
        out.close()
        packet = int.from_bytes(os.urandom(8), "little", signed=True)
        yield pa.RecordBatch.from_arrays([pa.array([packet]), pa.array([0]), pa.array([0]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=shape)
        keys, n = tally.settle()
        for lo in range(0, len(keys), 50_000):
            k = keys[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), packet)), pa.array(k), pa.array(n[lo : lo + 50_000]), pa.nulls(len(k), pa.binary())], schema=shape)

    return docs.mapInArrow(tidy(run), "packet long, key long, n long, texts binary")


def gram_scores(grams: DataFrame, order: int) -> DataFrame:
    """key, value (log10 probability of the gram's last symbol after the others) of grams: key, n.

    grams has each key once. From the empty context up: of a level's rows, each context has at most as many as there are symbols.
    """
    log = lambda c: F.log10(c)
    below = None
    for level in range(order + 1):
        rows = grams if level == order else grams.groupBy(F.col("key").bitwiseAND(F.lit((1 << BITS * (level + 1)) - 1)).alias("key")).agg(F.sum("n").alias("n"))
        context = Window.partitionBy(F.shiftright("key", BITS))
        total, kinds = F.sum("n").over(context), F.sum((F.col("n") > 0).cast("long")).over(context)
        if below is None:
            rows = rows.select("key", "n", total.alias("total"), kinds.alias("kinds"))
            below = rows.withColumn("rest", -log(F.greatest(F.lit(ALPHABET) - F.col("kinds"), F.lit(1)).cast("double")))
            continue
        lower = below.select(F.col("key").alias("low"), F.col("n").alias("n0"), F.col("total").alias("total0"), F.col("kinds").alias("kinds0"), F.col("rest").alias("rest0"))
        rows = rows.withColumn("low", F.col("key").bitwiseAND(F.lit((1 << BITS * level) - 1))).join(lower, "low")
        rows = rows.select("key", "n", "n0", "total0", "kinds0", "rest0", total.alias("total"), kinds.alias("kinds"), F.sum(F.when(F.col("n") > 0, F.col("n0")).otherwise(0)).over(context).alias("barred"))
        new = F.col("kinds0") - F.col("kinds")
        left = (2 * (F.col("total0") - F.col("barred"))).cast("double")
        rest = F.when(F.col("n0") > 0, log((2 * F.col("n0") - 1) / F.greatest(left, F.lit(1.0)))).otherwise(F.col("rest0") + F.when(new > 0, log(new / left)).otherwise(0.0))
        below = rows.select("key", "n", "total", "kinds", rest.alias("rest"))
    whole = (2 * F.col("total")).cast("double")
    value = F.when(F.col("n") > 0, log((2 * F.col("n") - 1) / F.greatest(whole, F.lit(1.0)))).otherwise(F.col("rest") + F.when(F.col("total") > 0, log(F.col("kinds") / whole)).otherwise(0.0))
    return below.select("key", value.alias("value"))


def _score(order: int):
    shape = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64())])

    def run(texts: pa.Table, values: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return shape.empty_table()
        known, value = pd.Index(values.column("key").to_numpy()), np.append(values.column("value").to_numpy(), 0.0)  # words that aren't known have no value: at -1
        end, parts = value[known.get_indexer([END_KEY])[0]], []
        with pa.ipc.open_stream(texts.column("texts")[0].as_py()) as file:
            for batch in file:
                raw = [folded(t) for t in batch.column("text").to_pylist()]
                score, logs, n_tokens, n_known = np.zeros(len(raw)), np.full(len(raw), end), np.ones(len(raw), np.int64), np.full(len(raw), int(end > 0))
                for owner, grams in gram_chunks(raw, order):
                    score += np.bincount(owner, value[known.get_indexer(grams)], len(raw))
                for owner, keys in spelled(raw):
                    found = value[known.get_indexer(keys)]
                    logs += np.bincount(owner, found, len(raw))
                    n_tokens += np.bincount(owner, minlength=len(raw))
                    n_known += np.bincount(owner[found > 0], minlength=len(raw))
                parts.append(pa.table([batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens), pa.array(n_known), pa.array(logs), pa.array(score)], schema=shape))
        del known, value
        give_back()
        return pa.concat_tables(parts)

    return run


def score_texts(docs: DataFrame, order: int = ORDER, parts: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    The model learns from the documents that aren't held out. score: log10 probability of the lower-cased bytes and
    the end; base_score: that of the words under add-one counts. A null or empty text is its end alone; without
    training texts every symbol has the same probability and base_score is 0.
    """
    docs = documents(docs).withColumn("held_out", held_out(parts=parts))
    made = materialise(_packets(docs, order), "packets", "zstd")  # sorted keys
    rows = made.where("texts is null").select("packet", "key", "n")
    summed = materialise(rows.groupBy("key").agg(F.sum("n").alias("n")), "sums")
    words, grams = summed.where("key < 0 and n > 0"), summed.where("key >= 0")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    every = gram_scores(grams, order).unionByName(words.select("key", F.log10(F.col("n") + 1.0).alias("value")))
    values = rows.select("packet", "key").join(every, "key").select("packet", "key", "value")
    texts = made.where("texts is not null").select(F.col("packet").alias("owner"), "texts")
    scored = texts.groupBy("owner").cogroup(values.groupBy("packet")).applyInArrow(_score(order), "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score")
