"""What the operators on integer vectors share: kept rows, their matrices, exact products of integers.

A table of vectors normally holds one length; vectors of other lengths are tables of their own, taken one after another.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise

#: Largest scaled component: what sums of it are made of stays far inside 64 bits.
LARGEST = float(1 << 50)
WIDE = pa.decimal128(38, 0)


def scaled(vectors: DataFrame, scale: int, shift: int, *more: str, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x = floor(scale * component) + shift and the columns in more, of rows whose vector is not null and has finite components only.

    A component whose scaled value is LARGEST or more is an error, as its products would not be whole numbers any more.
    """
    bounded_batches(vectors.sparkSession)
    kept = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"), *more)
    kept = kept.where("forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    whole = F.transform("x", lambda c: F.when(F.abs(c * F.lit(float(scale))) < LARGEST, F.floor(c * F.lit(float(scale))) + F.lit(shift)).otherwise(F.raise_error(F.lit("a vector component is too large")).cast("long")))
    return kept.withColumn("x", whole)


def by_length(rows: DataFrame, schema: str, run: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """The union of run(rows with vectors of one length, that length); empty with schema where there are no rows."""
    lengths = sorted(r[0] for r in rows.select(F.size("x").alias("length")).distinct().collect())
    found = [run(rows.where(F.size("x") == n) if len(lengths) > 1 else rows, n) for n in lengths]
    return reduce(DataFrame.unionByName, found) if found else rows.sparkSession.createDataFrame([], schema)


def kept_rows(rows: DataFrame) -> DataFrame:
    """rows as a table whose rows have a number of their own in the column key."""
    return materialise(rows.withColumn("key", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """The lists of column as rows of length numbers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), length)


def lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of x as lists."""
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel(), kind))


def number(x: np.ndarray, most: int) -> np.ndarray:
    """Integers x in the fastest kind in which whole numbers up to most are exact."""
    return x.astype(np.float64 if most < 1 << 53 else object)


def wide(numbers) -> pa.Array:
    """Python or 64-bit integers as decimal(38, 0)."""
    if isinstance(numbers, np.ndarray) and numbers.dtype != object:
        return pa.array(numbers, pa.int64()).cast(WIDE)
    return pa.array([Decimal(int(v)) for v in numbers], WIDE)
