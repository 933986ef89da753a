"""op12: product codes of embeddings by Lloyd rounds that look at active entries only.

Each vector is cut into PARTS parts, each part position has a codebook of ENTRIES whole-number entries. A round writes every
vector's codes with the exact squared distance of each part. The next one compares a part whose entry did not move with the
moved entries only, against that stored distance: the entries that stayed are as far as before and lost before. Parts
whose entry moved are compared with all. Ties go to the lower index either way. Codebooks are PARTS x ENTRIES entries, whatever the rows,
and what a partition sends for an update is a count and sums for each entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, tidy
from .vectors import by_length, lists, matrix, number, scaled, wide

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
STATE = "vec_id long, label {label}, x array<long>, codes array<int>, distances array<long>"


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """rows x parts x width; the last part is filled up with zeros where the length can't be cut evenly."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)


def _nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each row's nearest entry, the lowest of ties, and the squared distance, exact."""
    most = 4 * part.shape[1] * max(int(np.abs(part).max(initial=0)), int(np.abs(entries).max(initial=0))) ** 2
    a, b = number(part, most), number(entries, most)
    distance = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    at = distance.argmin(1)
    return at, distance[np.arange(len(at)), at].astype(np.int64)


def _again(part: np.ndarray, code: np.ndarray, stored: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """_nearest, from the codes and distances that held before the entries in moved changed."""
    code, stored = code.copy(), stored.copy()
    stale = moved[code]
    if stale.any():
        code[stale], stored[stale] = _nearest(part[stale], entries)
    still, active = np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(still) and len(active):
        at, distance = _nearest(part[still], entries[active])
        at = active[at]
        better = (distance < stored[still]) | ((distance == stored[still]) & (at < code[still]))
        code[still[better]], stored[still[better]] = at[better], distance[better]
    return code, stored


def _assign(length: int, books: np.ndarray, before: np.ndarray | None):
    """The state with codes and distances to books; before: the books that the state's own codes and distances are of."""
    parts = len(books)
    moved = None if before is None else (books != before).any(2)

    def run(batches):
        for batch in batches:
            cut = _cut(matrix(batch.column("x"), length), parts)
            if before is None:
                found = [_nearest(cut[:, p], books[p]) for p in range(parts)]
            else:
                codes, stored = matrix(batch.column("codes"), parts), matrix(batch.column("distances"), parts)
                found = [_again(cut[:, p], codes[:, p], stored[:, p], books[p], moved[p]) for p in range(parts)]
            codes, distances = (np.stack(f, axis=1) for f in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("x"), lists(codes.astype(np.int32), pa.int32()), lists(distances, pa.int64())], ["vec_id", "label", "x", "codes", "distances"])

    return tidy(run)


def _sums(length: int, books: np.ndarray):
    """part, entry, at, n, total: of each entry, over the parts of a partition that have it."""
    parts, entries, width = books.shape

    def run(batches):
        total, n = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            cut, codes = _cut(matrix(batch.column("x"), length), parts), matrix(batch.column("codes"), parts)
            for p in range(parts):
                own = np.zeros((entries, width), np.int64)  # LARGEST times the rows of a batch
                np.add.at(own, codes[:, p], cut[:, p])
                total[p] += own.astype(object)
                n[p] += np.bincount(codes[:, p], minlength=entries)
        p, e = np.nonzero(n)
        at = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(at, pa.int32()), pa.array(n[p, e]), wide(total[p, e, at])], ["part", "entry", "at", "n", "total"])

    return tidy(run)


def moved_books(state: DataFrame, length: int, books: np.ndarray) -> np.ndarray:
    """books with each used entry at the floored mean of its parts."""
    sums = state.select("x", "codes").mapInArrow(_sums(length, books), "part int, entry int, at int, n long, total decimal(38,0)")
    new = books.copy()
    for r in sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return new


def _written(batches):
    for batch in batches:
        codes = np.stack(batch.column("codes").to_numpy(zero_copy_only=False)) if len(batch) else np.zeros((0, 0), np.int32)
        distances = batch.column("distances").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(["".join(f"{c:02x}" for c in row) for row in codes], pa.string()), pa.array([sum(map(int, row)) for row in distances], pa.int64())],
            ["vec_id", "label", "code", "error"],
        )


def compress(vectors: DataFrame, label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each row of vectors (vec_id, embedding, label) with a vector of finite components.

    Other rows give none. Rows are coded one by one, repeated ones and those without an id too; among the first codebooks'
    vectors, equal ids come by their vectors, and rows without an id last. Fewer rows than entries make smaller codebooks. A length that
    can't be cut evenly is filled up with zeros. Vectors of different lengths have codebooks of their own; label_error sums over all lengths.
    """
    label = vectors.schema[label_col].dataType.simpleString()
    shape = f"vec_id long, label {label}, code string, error long, codebooks_sha256 string"

    def run(rows: DataFrame, length: int) -> DataFrame:
        first = rows.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
        books, before = _cut(np.array([r["x"] for r in first], np.int64).reshape(len(first), length), parts).swapaxes(0, 1), None
        state = rows.select("vec_id", "label", "x")
        for _ in range(rounds):
            state = materialise(state.mapInArrow(_assign(length, books, before), STATE.format(label=label)), "codes")
            books, before = moved_books(state, length, books), books
        coded = state.mapInArrow(_assign(length, books, before), STATE.format(label=label)).mapInArrow(tidy(_written), f"vec_id long, label {label}, code string, error long")
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
        return coded.withColumn("codebooks_sha256", F.lit(digest))

    coded = materialise(by_length(scaled(vectors.withColumn("label", F.col(label_col)), SCALE, 0, "label"), shape, run), "coded")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
