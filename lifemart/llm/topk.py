"""op13: exact top-k inner products of whole-number vectors, by descending length.

Candidates are sorted by length (Euclidean norm) into blocks. The SEEDS longest give each query a first threshold: no candidate
whose length times the query's is below it can be among its best. So a query meets only the blocks that begin with a length that may still reach,
which are the first ones, and chunks of queries are sorted by that reach, so that a chunk meets a run of blocks from the first. Chunk
and block meet in one task. There, candidates come in slices, longest first, and the thresholds rise as they do; vectors are rotated by the right
singular vectors of the table, so their first coordinates hold most of a product, and what the others can add at most is the product of what is left of both
lengths (Cauchy-Schwarz). Partial sums plus that bound drop pairs in steps; the rest are multiplied as whole numbers. A float
only ever drops pairs, by a bound with a margin, so results are exact. A task holds one chunk and one block, and gives k rows for each query at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tidy
from .vectors import by_length, kept_rows, matrix, number, scaled

SCALE, QUERY_STEP, K = 64, 20, 20
#: Candidates of a block and of a slice of it, queries of a chunk, longest vectors that give first thresholds.
BLOCK, SLICE, CHUNK, SEEDS = 4096, 1024, 1024, 512
#: Shares of the coordinates that partial sums take one after another, and the rounding that a bound allows for, as a share of both lengths.
STEPS, MARGIN = (0.125, 0.375), 1e-9
SCHEMA = "query_id long, rank int, vec_id long, score long"
_LAST = np.iinfo(np.int64).max  # stands for an absent id, which comes last


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def rotation(rows: DataFrame, length: int) -> np.ndarray:
    """The right singular vectors of the rows' vectors, strongest first, as columns."""

    def run(batches):
        total = np.zeros((length, length))
        for batch in batches:
            x = matrix(batch.column("x"), length).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["at", "row"])

    if not length:
        return np.zeros((0, 0))
    parts = rows.select("x").mapInArrow(tidy(run), "at int, row array<double>").select("at", F.posexplode("row"))
    total = np.zeros((length, length))
    for r in parts.groupBy("at", "pos").agg(F.sum("col").alias("total")).collect():
        total[r["at"], r["pos"]] = r["total"]
    return np.linalg.svd(total / max(1.0, np.abs(total).max()))[2].T


class Side:
    """Vectors of a task: keys, ids, whole numbers, and their rotated form with what is left of their lengths after each step."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray, turn: np.ndarray):
        self.keys, self.ids, self.x = keys, ids, x
        self.turned = x.astype(np.float64) @ turn
        self.ends = [max(1, math.ceil(s * x.shape[1])) for s in STEPS]
        self.norm = _norms(x)
        self.rest = [np.sqrt((self.turned[:, end:] ** 2).sum(1)) for end in self.ends]

    def __getitem__(self, at) -> Side:
        new = object.__new__(Side)
        new.keys, new.ids, new.x, new.turned, new.norm, new.ends = self.keys[at], self.ids[at], self.x[at], self.turned[at], self.norm[at], self.ends
        new.rest = [r[at] for r in self.rest]
        return new

    def __len__(self) -> int:
        return len(self.keys)


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each query: highest score, then smallest id, then key."""
    order = np.lexsort((keys, ids, -score, query))
    begins = np.searchsorted(query[order], query[order], "left")
    return order[np.arange(len(order)) - begins < k]


def _scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, dense: bool) -> np.ndarray:
    """The whole-number products of the pairs a[i], b[j]."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    a, b = number(a, most), number(b, most)
    if dense:
        return (a @ b.T)[i, j].astype(np.int64)
    return np.concatenate([(a[i[lo : lo + 65536]] * b[j[lo : lo + 65536]]).sum(1).astype(np.int64) for lo in range(0, len(i), 65536)] or [np.zeros(0, np.int64)])


def search(queries: Side, rows: Side, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query place, row place, score of the k best rows of each query among those that score reach or more; rows come longest first."""
    least = np.where(np.isfinite(reach), reach, -np.inf)
    at_q, at_r, score = (np.zeros(0, np.int64) for _ in range(3))
    for lo in range(0, len(rows), SLICE):
        part = rows[lo : lo + SLICE]
        open_q = np.flatnonzero(queries.norm * (part.norm.max() * (1 + MARGIN)) >= least)
        if not len(open_q):
            break  # later ones are shorter
        q = queries[open_q]
        slack = np.outer(q.norm, part.norm) * MARGIN
        product, begin = np.zeros_like(slack), 0
        live = np.ones(slack.shape, bool)
        for step, end in enumerate(q.ends):
            product += q.turned[:, begin:end] @ part.turned[:, begin:end].T
            begin = end
            live = product + np.outer(q.rest[step], part.rest[step]) + slack >= least[open_q][:, None]
            if live.mean() < 0.05:
                break
        live &= q.keys[:, None] != part.keys
        i, j = np.nonzero(live)
        found = _scores(q.x, part.x, i, j, len(i) > 0.05 * live.size)
        on = found >= least[open_q][i]
        at_q, at_r, score = np.concatenate([at_q, open_q[i[on]]]), np.concatenate([at_r, lo + j[on]]), np.concatenate([score, found[on]])
        held = _best(at_q, score, rows.ids[at_r], rows.keys[at_r], k)
        at_q, at_r, score = at_q[held], at_r[held], score[held]
        full = np.bincount(at_q, minlength=len(queries)) == k
        lowest = np.full(len(queries), np.inf)
        np.minimum.at(lowest, at_q, score.astype(np.float64))
        least = np.where(full, np.maximum(least, lowest), least)
    return at_q, at_r, score


def _ids(column) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def _side(table, length: int, turn: np.ndarray) -> Side:
    column = {n: c.combine_chunks() if isinstance(c := table.column(n), pa.ChunkedArray) else c for n in ("key", "vec_id", "x")}
    return Side(column["key"].to_numpy(), _ids(column["vec_id"]), matrix(column["x"], length), turn)


def _thresholds(seeds: Side, length: int, turn: np.ndarray, k: int):
    """key, vec_id, x, reach (the k-th best score among the seeds, none if fewer) and need, the length of a row that can reach that."""

    def run(batches):
        for batch in batches:
            queries = _side(batch, length, turn)
            reach = np.full(len(queries), -np.inf)
            at, _, score = search(queries, seeds, reach, k)
            full = np.bincount(at, minlength=len(queries)) == k
            lowest = np.full(len(queries), np.inf)
            np.minimum.at(lowest, at, score.astype(np.float64))
            reach = np.where(full, lowest, -np.inf)
            need = np.where(reach > 0, reach / np.maximum(queries.norm, 1e-300) * (1 - MARGIN), 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("key", "vec_id", "x")), pa.array(reach), pa.array(need)], ["key", "vec_id", "x", "reach", "need"])

    return tidy(run)


def ranged(rows: DataFrame, order: str, size: int) -> tuple[DataFrame, list[float]]:
    """rows as a table with block, numbered from 0 along order, of about size rows each, and the least value of order in each block.

    Range partitions of a quarter of a block are put together by their counts; rows of one value are parted by a hash.
    """
    spark = rows.sparkSession
    table = materialise(rows.repartitionByRange(max(1, math.ceil(4 * rows.count() / size)), F.asc(order), F.xxhash64("key")).withColumn("part", F.spark_partition_id()), "ranged")
    least, numbers, held = [], [], size
    for r in table.groupBy("part").agg(F.min(order).alias("least"), F.count("*").alias("n")).orderBy("part").collect():  # a row for each quarter of a block
        if held + r["n"] > size:
            least.append(r["least"])
            held = 0
        held += r["n"]
        numbers.append((r["part"], len(least) - 1))
    return table.join(spark.createDataFrame(numbers, "part int, block int"), "part").drop("part"), least


def _meet(length: int, turn: np.ndarray, k: int):
    """The best rows of each query of a chunk among those of a block."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            at_q, at_r, score = (np.zeros(0, np.int64) for _ in range(3))
        else:
            rows = rows.sort_by([("norm", "descending"), ("key", "ascending")])
            at_q, at_r, score = search(_side(queries, length, turn), _side(rows, length, turn), queries.column("reach").to_numpy(), k)
        return pa.table(
            [queries.column("key").take(pa.array(at_q)), queries.column("vec_id").take(pa.array(at_q)), rows.column("key").take(pa.array(at_r)), rows.column("vec_id").take(pa.array(at_r)), pa.array(score)],
            names=["query", "query_id", "key", "vec_id", "score"],
        )

    return run


def top_products(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """SCHEMA: the k best rows of vectors (vec_id, embedding) for each row whose id is divisible by query_step.

    Vectors that are null or hold null or non-finite components take no part. Rows are told apart by place: of rows that repeat, each
    is a query of its own and a candidate of the others. A row without an id is a candidate that comes last of ties, and no query.
    Fewer candidates than k give fewer rows. Vectors of different lengths are not compared. Ties of score and id go by place in the table..
    """

    def run(rows: DataFrame, length: int) -> DataFrame:
        spark = rows.sparkSession
        turn = rotation(rows, length)
        norms = rows.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))
        asked = rows.where(F.col("vec_id") % query_step == 0)
        first = norms.orderBy(F.desc("norm"), "key").limit(SEEDS).select("key", "vec_id", "x").toArrow()
        seeds = _side(first, length, turn)
        held = spark.sparkContext.broadcast(seeds)  # SEEDS vectors
        thresholds = materialise(asked.select("key", "vec_id", "x").mapInArrow(lambda batches: _thresholds(held.value, length, turn, k)(batches), "key long, vec_id long, x array<long>, reach double, need double"), "asked")
        chunks, need = ranged(thresholds, "need", CHUNK)
        blocks, negative = ranged(norms.withColumn("short", -F.col("norm")), "short", BLOCK)
        if not need or not negative:
            return spark.createDataFrame([], SCHEMA)
        # A chunk whose least need is at most a block's greatest length meets it: the first chunks, and the first blocks.
        longest = [-n * (1 + MARGIN) for n in negative]
        runs = [sum(at_most <= norm for at_most in need) for norm in longest]
        depth = [sum(norm >= at_most for norm in longest) for at_most in need]
        of_block = spark.createDataFrame(list(enumerate(runs)), "block int, chunks int").where("chunks > 0")
        of_chunk = spark.createDataFrame(list(enumerate(depth)), "chunk int, blocks int").where("blocks > 0")
        left = chunks.withColumnRenamed("block", "chunk").join(of_chunk, "chunk").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("chunk", "block", "key", "vec_id", "x", "reach")
        right = blocks.join(of_block, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("chunk", "block", "key", "vec_id", "x", "norm")
        found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(_meet(length, turn, k), "query long, query_id long, key long, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "key"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    return by_length(kept_rows(scaled(vectors, SCALE, 0)), SCHEMA, run)
