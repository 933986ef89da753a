"""What the operators share: written tables, hash blocks of documents and small folds of text columns.

Cases that hold for every operator here: a null text counts as the empty text; rows with equal ids are
scored one by one; an empty table gives an empty result with the full schema; columns other than the named
ones are ignored, whatever their names.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifemart.session import ship_code

#: Rows and bytes of an Arrow batch that goes to a Python worker: long documents must not fill a worker.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; one of our own where it is unset and all run on one machine, as in tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="lifemart-")
    return _own_dirs[app]


def materialise(df: DataFrame, label: str = "table", compression: str = "snappy") -> DataFrame:
    """df as a written table: cuts lineage, is computed once and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small, and sees that tasks find this package."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Returns to the system what this worker has freed: workers wait between tasks beside the executor's other memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of batches that gives its memory back at its end."""

    def wrapped(*args):
        try:
            yield from run(*args)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class IdFilter:
    """Tells nearly all ids that are not in a table; never misses one that is. BITS an id or more, down to eight where MOST_BITS in all are reached."""

    BITS, MOST_BITS = 64, 1 << 27

    def __init__(self, ids: DataFrame):
        """ids: one column of longs, each once."""
        name, spark = ids.columns[0], ids.sparkSession
        self.bits = bits = min(self.MOST_BITS, 1 << max(16, (self.BITS * ids.count()).bit_length()))

        def places(batches):
            for batch in batches:
                at = (mix(batch.column(0).to_numpy()) & np.uint64(bits - 1)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"word": at >> 6, "bit": np.left_shift(np.int64(1), at & 63)})

        words = ids.select(name).where(F.col(name).isNotNull()).mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        mask = np.zeros(bits >> 6, np.int64)
        mask[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.held = spark.sparkContext.broadcast(mask)

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        at = (mix(ids) & np.uint64(self.bits - 1)).astype(np.int64)
        return self.held.value[at >> 6] >> (at & 63) & 1 > 0


def documents(docs: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text (null as empty) and the columns in more."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def block_count(docs: DataFrame, block_bytes: int, least: int = 24) -> int:
    """How many hash blocks of about block_bytes of text docs fill."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-total // block_bytes))


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """docs with the column block: by the hash of the id, so no source, text or copy makes a block large."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(blocks)), F.lit(blocks)).cast("int"))
