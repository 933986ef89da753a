"""op7: near-duplicate embeddings by spherical k-means cells.

Centres are fitted on a bounded sample; every vector is put into the NEAREST cells whose centres are most alike
to it, and vectors of a cell are compared by blocked cosine products. Equal vectors are one class from the start
(its size counts in the links), and a large cell is cut into blocks by hash whose pairs are compared one by one,
so no group has to fit in a task and no pair inside it is skipped. As there are MOST_CELLS centres at most, cells grow with
the table: those of more than SPLIT vectors get centres of their own, fitted on a sample of the cell, and their vectors
go to the nearest of those. Cells in which many pairs are links stay whole, as parting would lose links. A pair that shares
several cells counts in the smallest. Recall is that of sharing a cell; it is measured against brute force in the tests (see README).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, tidy
from .components import components

LIKENESS = 0.9
#: Cells that a vector goes to; vectors a cell should hold; most cells; most sampled vectors of the fit.
NEAREST, CELL_SIZE, MOST_CELLS, SAMPLE = 6, 768, 4096, 20_000
BLOCK = 2048
#: Vectors of a cell that is parted again, sampled vectors of that fit, finer cells that a vector goes to, and the share of links that keeps a cell whole.
SPLIT, FINE_SAMPLE, FINE_NEAREST, DENSE = 16 * CELL_SIZE, 8192, 4, 0.05
FINE = 4096


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on unit vectors; starts from rows spread over the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of very large or small components finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _labels(size: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each of size rows reaches by links i - j."""
    label = ids.copy()
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return label


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Rows of as many numbers as the longest list, the others filled with -1."""
    size = np.diff(lists.offsets.to_numpy())
    out = np.full((len(size), max(1, size.max(initial=0))), -1, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy()
    return out


def _finer(most: int, nearest: int):
    """centres of a cell's sample, as one row; none if many of its pairs are links."""

    def run(sample: pa.Table) -> pa.Table:
        shape = pa.schema([("dim", pa.int32()), ("cell", pa.int64()), ("centres", pa.list_(pa.float64()))])
        sample = sample.sort_by([("hash", "ascending"), ("rep", "ascending")])  # rows arrive in any order
        x, n = _unit(sample.column("embedding")), sample.column("n")[0].as_py()
        some = x[np.linspace(0, len(x) - 1, min(len(x), 512)).astype(int)]
        cells = min(most, len(x) // 4, math.ceil(n * nearest / CELL_SIZE))
        if cells <= nearest or (some @ x.T >= LIKENESS).sum() - len(some) > DENSE * some.shape[0] * x.shape[0]:
            return shape.empty_table()
        return pa.table([[sample.column("dim")[0].as_py()], [sample.column("cell")[0].as_py()], [fit_centres(x, cells).ravel().tolist()]], schema=shape)

    return run


def _fine_cells(nearest: int):
    """rep, hash, cell, fine: of each vector of a cell, its nearest finer cells."""

    def run(rows: pa.Table, centres: pa.Table) -> pa.Table:
        shape = pa.schema([("rep", pa.int64()), ("hash", pa.int64()), ("cell", pa.int64()), ("fine", pa.list_(pa.int64()))])
        if not rows.num_rows or not centres.num_rows:
            return shape.empty_table()
        own = np.array(centres.column("centres")[0].as_py()).reshape(-1, rows.column("dim")[0].as_py())
        at = np.argpartition(-(_unit(rows.column("embedding")) @ own.T), nearest - 1, axis=1)[:, :nearest]
        fine = rows.column("cell").to_numpy()[:, None] + 1 + at
        return pa.table([rows.column("rep"), rows.column("hash"), rows.column("cell"), pa.array(fine.tolist(), pa.list_(pa.int64()))], schema=shape)

    return run


def part_large_cells(placed: DataFrame) -> DataFrame:
    """placed (rep, size, dim, embedding, cells) with the finer cells of large ones instead of those."""
    members = placed.select("dim", "rep", "embedding", F.xxhash64("embedding").alias("hash"), F.explode("cells").alias("cell"))
    large = members.groupBy("dim", "cell").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT)
    large = materialise(large, "large")
    if large.isEmpty():
        return placed
    members = members.join(large, ["dim", "cell"])
    sample = members.where(F.pmod(F.xxhash64("rep", F.lit("fine")), F.lit(1 << 30)) < F.lit(FINE_SAMPLE) / F.col("n") * (1 << 30))
    fits = materialise(sample.groupBy("dim", "cell").applyInArrow(_finer(FINE // 2, FINE_NEAREST), "dim int, cell long, centres array<double>"), "fits")
    salts = F.ceil(F.col("n") / 4096).cast("int")
    salted = members.join(fits.select("dim", "cell"), ["dim", "cell"], "left_semi").withColumn("salt", F.pmod(F.col("hash"), salts).cast("int"))
    spread = fits.join(large, ["dim", "cell"]).select(F.col("dim").alias("d"), F.col("cell").alias("c"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("s"), "centres")
    fine = salted.groupBy("dim", "cell", "salt").cogroup(spread.groupBy("d", "c", "s")).applyInArrow(_fine_cells(FINE_NEAREST), "rep long, hash long, cell long, fine array<long>")
    own = materialise(fine.groupBy("rep", "hash").agg(F.collect_list("cell").alias("parted"), F.flatten(F.collect_list("fine")).alias("fine")), "fine")  # NEAREST rows each at most
    none = F.array().cast("array<long>")
    both = placed.withColumn("hash", F.xxhash64("embedding")).join(own, ["rep", "hash"], "left")
    return materialise(both.select("rep", "size", "dim", "embedding", F.concat(F.array_except("cells", F.coalesce("parted", none)), F.coalesce("fine", none)).alias("cells")), "cells")


def _compare(block: pa.Table) -> pa.Table:
    """Links inside one block or between two blocks of a cell: of each row their number, and the smallest id it reaches here."""
    first, second, cell = (block.column(n)[0].as_py() for n in ("first", "second", "cell"))
    ids, sizes = block.column("rep").to_numpy(), block.column("size").to_numpy()
    side, x = block.column("part").to_numpy(), _unit(block.column("embedding"))
    cells = _padded(block.column("cells").combine_chunks())
    left = np.flatnonzero(side == first)
    right = left if first == second else np.flatnonzero(side == second)
    links = np.zeros(len(ids), np.int64)
    found_i, found_j = [], []
    for lo in range(0, len(left), 512):
        a = left[lo : lo + 512]
        i, j = np.nonzero(x[a] @ x[right].T >= LIKENESS)
        i, j = a[i], right[j]
        keep = i < j if first == second else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        shared = np.full(len(i), np.iinfo(np.int64).max, np.int64)
        for p in range(cells.shape[1]):
            hit = (cells[j] == cells[i, p][:, None]).any(1) & (cells[i, p] >= 0)
            shared = np.minimum(shared, np.where(hit, cells[i, p], shared))
        keep = shared == cell
        i, j = i[keep], j[keep]
        np.add.at(links, i, sizes[j])
        np.add.at(links, j, sizes[i])
        if len(i):
            label = _labels(len(ids), i, j, ids)  # fewer links than pairs go on
            on = np.flatnonzero(label != ids)
            found_i.append(ids[on])
            found_j.append(label[on])
    on = np.flatnonzero(links)
    a, b = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_i, found_j))
    n = len(on)
    return pa.table({"id": np.concatenate([ids[on], a]), "links": np.concatenate([links[on], np.zeros(len(a), np.int64)]), "low": pa.array(np.concatenate([ids[on], b]), pa.int64())}) if n or len(a) else pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "low": pa.array([], pa.int64())})


def link_vectors(vectors: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, and so does a row
    without an id (its component is null, kept false). Vectors of different lengths don't link. Repeated rows are
    vectors of their own that link with one another.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))") & F.expr("exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("embedding", F.when(fine, F.transform("embedding", lambda x: x + F.lit(0.0))))
    rows = rows.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit("second"), "embedding")})  # 128 bits stand for a vector
    classes = materialise(rows.where("embedding is not null").groupBy("embedding", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "classes").withColumn("dim", F.size("embedding"))
    lengths = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(64).collect()}
    centres = {}
    for dim, n in lengths.items():  # lengths beyond the 64 most frequent share one cell each
        if (cells := min(MOST_CELLS, math.ceil(n * nearest / CELL_SIZE))) > nearest:
            taken = classes.where(F.col("dim") == dim).select("embedding", "rep").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect()
            sample = np.array([r["embedding"] for r in taken])
            sample /= np.abs(sample).max(axis=1, keepdims=True)
            centres[dim] = fit_centres(sample / np.linalg.norm(sample, axis=1, keepdims=True), min(cells, len(sample)))
    held = spark.sparkContext.broadcast(centres)  # MOST_CELLS rows for each of 64 lengths at most

    def cells_of(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells: list = [[-1]] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if (own := held.value.get(int(dim))) is not None:
                    likeness = _unit(batch.column("embedding").take(pa.array(at))) @ own.T
                    for i, c in zip(at, np.argpartition(-likeness, nearest - 1, axis=1)[:, :nearest].tolist(), strict=True):
                        cells[i] = c
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("size"), batch.column("dim"), batch.column("embedding"), pa.array([[(c + 1) * FINE for c in own_cells] for own_cells in cells], pa.list_(pa.int64()))], ["rep", "size", "dim", "embedding", "cells"])

    placed = materialise(classes.select("rep", "size", "dim", "embedding").mapInArrow(tidy(cells_of), "rep long, size long, dim int, embedding array<double>, cells array<long>"), "cells")
    placed = part_large_cells(placed)
    parts = placed.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    spread = placed.withColumn("cell", F.explode("cells")).join(parts, ["dim", "cell"])
    spread = spread.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = spread.select("dim", "cell", "rep", "size", "embedding", "cells", "part", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"))
    found = materialise(blocks.groupBy("dim", "cell", "first", "second").applyInArrow(_compare, "id long, links long, low long"), "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    found = classes.select("rep", "size", "h1", "h2").join(counts, F.col("rep") == F.col("id"), "left").drop("id").join(groups, F.col("rep") == F.col("id"), "left")
    of_class = materialise(found.select("h1", "h2", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links")), "linked")
    odd = rows.where("embedding is null").select("vec_id", F.lit(None).cast("long").alias("component"), F.lit(None).cast("long").alias("links"))
    own = rows.where("embedding is not null").select("vec_id", "h1", "h2").join(of_class, ["h1", "h2"]).select("vec_id", "component", "links")  # vectors stay where they are
    return own.unionByName(odd).select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"))
