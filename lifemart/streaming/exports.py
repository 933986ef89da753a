"""Streams that keep a table: bucketed upserts, append-only exports that fail closed, and the inventory ledger under disorder."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ledger import STATES
from .streams import shared

LEDGER_SHAPE = "unit long, event_id long, kind string, before_state string, after_state string, applied boolean"
#: What a kind of event makes of a state, by the state's number.
STEPS = {("ALTA", 0): 1, ("SEPARACION", 1): 2, ("VENTA", 2): 3, ("CAIDA", 2): 1, ("CAIDA", 3): 1}


class HistoryChanged(ValueError):
    """An export tells rows that were loaded before otherwise."""


class Buckets:
    """A table in hash buckets of its keys, of which an upsert rewrites only those that its rows fall into.

    Buckets are written side by side; the manifest of a batch names the folder of each bucket's newest rows. It is written last, so a batch that
    fails leaves the table as it was, and a batch that runs again writes the same folders.
    """

    def __init__(self, spark: SparkSession, base: str, schema, keys: list[str], order: list[Column], buckets: int = 16):
        self.spark, self.base, self.schema, self.keys, self.order, self.buckets = spark, base, schema, keys, order, buckets
        self.versions: dict[int, int] = {}

    def restore(self, number: int) -> None:
        """The table as batch number left it."""
        rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.base}/manifest/{number}").collect()  # a row a bucket
        self.versions = {r["bucket"]: r["version"] for r in rows}

    def _path(self, bucket: int) -> str:
        return f"{self.base}/rows/{self.versions[bucket]}/_bucket={bucket}"

    def read(self) -> DataFrame:
        paths = [self._path(b) for b in sorted(self.versions)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, number: int) -> None:
        """Of each key the first row by order, among the batch's and the table's, stays."""
        batch = batch.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        touched = sorted(r[0] for r in batch.select("_bucket").distinct().collect())  # at most as many as buckets
        if not touched:
            return
        held = [b for b in touched if b in self.versions]
        both = batch
        for b in held:
            both = both.unionByName(self.spark.read.schema(self.schema).parquet(self._path(b)).withColumn("_bucket", F.lit(b)))
        rank = F.row_number().over(Window.partitionBy("_bucket", *self.keys).orderBy(*self.order))
        both.withColumn("_rank", rank).where("_rank = 1").drop("_rank").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.base}/rows/{number}")
        versions = self.versions | dict.fromkeys(touched, number)
        self.spark.createDataFrame(sorted(versions.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/{number}")
        self.versions = versions


def upsert_buckets(stream: DataFrame, keys: list[str], *order: Column, buckets: int = 16) -> Buckets:
    """Runs the stream over what is there into a bucketed table."""
    spark = stream.sparkSession
    table = Buckets(spark, shared(spark, "buckets"), stream.schema, keys, list(order), buckets)
    stream.writeStream.foreachBatch(table.merge).option("checkpointLocation", shared(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return table


class Exports:
    """Rows of sources that are exported whole again and again, and may only grow.

    Of each source the number of rows and a digest of them (a sum of hashes of place and content) are kept. A batch whose rows up to that
    number don't add up to the digest, or whose further rows leave a gap, is refused as a whole before anything is written; else only
    the rows after that number are loaded. What is compared is one row a source: the history itself is not read again.
    """

    def __init__(self, spark: SparkSession, base: str, source: str, place: str, content: list[str]):
        self.spark, self.base, self.source, self.place, self.content = spark, base, source, place, content
        self.known: str | None = None
        self.loaded: list[str] = []

    def _summary(self, rows: DataFrame) -> DataFrame:
        digest = F.sum(F.xxhash64(self.place, *self.content).cast("decimal(38,0)"))
        return rows.groupBy(self.source).agg(F.count("*").alias("n"), F.max(self.place).cast("long").alias("last"), digest.alias("digest"))

    def load(self, batch: DataFrame, number: int) -> None:
        rows = batch.distinct()  # the same export twice in a batch
        shape = rows.select(self.source).schema.add("_n", "long").add("_digest", "decimal(38,0)")
        known = self.spark.read.schema(shape).parquet(self.known) if self.known else self.spark.createDataFrame([], shape)
        marked = rows.join(known, self.source, "left").withColumn("_new", F.col(self.place) > F.coalesce("_n", F.lit(0)))
        before = self._summary(marked.where("not _new"))
        here = rows.select(self.source).distinct()
        told = known.join(here, self.source, "left_semi").join(before, self.source, "left")
        changed = told.where(~(F.col("n").eqNullSafe(F.col("_n")) & F.col("digest").eqNullSafe(F.col("_digest")))).select(self.source)
        after = self._summary(marked.where("_new")).join(known, self.source, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        gaps = after.where(F.col("n") != F.col("last") - F.col("_n")).select(self.source)
        wrong = [r[0] for r in changed.union(gaps).limit(5).collect()]
        if wrong:
            raise HistoryChanged(f"rows that were loaded before are changed, gone or out of place in {wrong}")
        path = f"{self.base}/rows/{number}"
        marked.where("_new").select(rows.columns).write.mode("overwrite").parquet(path)
        added = after.select(self.source, F.col("n").alias("_n"), F.col("digest").alias("_digest"))
        total = known.unionByName(added).groupBy(self.source).agg(F.sum("_n").alias("_n"), F.sum("_digest").cast("decimal(38,0)").alias("_digest"))
        total.write.mode("overwrite").parquet(digests := f"{self.base}/known/{number}")
        self.known, self.loaded = digests, [p for p in self.loaded if p != path] + [path]

    def read(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*self.loaded) if self.loaded else self.spark.createDataFrame([], schema)


def load_exports(stream: DataFrame, source: str, place: str, content: list[str]) -> tuple[Exports, str | None]:
    """Runs the stream of exports over what is there: the table, and why it stopped, if a batch was refused."""
    spark = stream.sparkSession
    table = Exports(spark, shared(spark, "exports"), source, place, content)
    refused: list[HistoryChanged] = []

    def load(batch: DataFrame, number: int) -> None:
        try:
            table.load(batch, number)
        except HistoryChanged as error:
            refused.append(error)
            raise

    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", shared(spark, "state")).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not refused:
            raise
    return table, str(refused[0]) if refused else None


class _Ledger(StatefulProcessor):
    """Holds the events of a bucket of units until the watermark has passed them, then applies each unit's in the order of time and id.

    A bucket has one value of state and at most one timer, at the earliest event that it holds, so a batch calls it once with rows and once as its timer expires.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        held = "held_units array<string>, micros array<long>, events array<long>, kinds array<string>"
        self.kept = handle.getValueState("kept", f"due long, units array<string>, states array<int>, {held}")

    def read(self) -> tuple[int | None, dict[str | None, int], list[tuple]]:
        """The timer that stands, the state of each unit, and the events held: time, id, unit, kind."""
        if not (row := self.kept.get()):
            return None, {}, []
        due, units, states, held, micros, events, kinds = row
        return due, dict(zip(units, states, strict=True)), list(zip(micros, events, held, kinds, strict=True))

    def keep(self, due: int | None, now: dict[str | None, int], held: list[tuple]) -> None:
        first = min(e[0] for e in held) // 1000 + 1 if held else None
        if due != first:
            if due is not None:
                self.handle.deleteTimer(due)
            if first is not None:
                self.handle.registerTimer(first)
        columns = [[e[i] for e in held] for i in (2, 0, 1, 3)]
        self.kept.update((first, list(now), list(now.values()), *columns))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        due, now, held = self.read()
        for frame in rows:
            held += zip(frame["micros"].tolist(), frame["event_id"].tolist(), frame["unit"].tolist(), frame["kind"].tolist(), strict=True)
        self.keep(due, now, held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        import pandas as pd

        limit = timerValues.getCurrentWatermarkInMs() * 1000
        _, now, held = self.read()
        out = []
        for _, event, unit, kind in sorted((e for e in held if e[0] <= limit), key=lambda e: e[:2]):
            old = now.get(unit, 0)
            new = now[unit] = STEPS.get((kind, old), old)
            out.append((None if unit is None else int(unit), event, kind, STATES[old], STATES[new], new != old))
        self.keep(None, now, [e for e in held if e[0] > limit])  # the timer that expired is gone
        frame = pd.DataFrame(out, columns=["unit", "event_id", "kind", "before_state", "after_state", "applied"])
        yield frame.astype({"unit": "Int64"})

    def close(self) -> None:
        pass


@contextlib.contextmanager
def rocks_state(spark: SparkSession):
    """Streams that start in here keep their state in RocksDB; afterwards the session is as before."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def ledger_under_disorder(stream: DataFrame, delay: str, buckets: int = 1024) -> DataFrame:
    """LEDGER_SHAPE of a stream of unit, event_id, ts, kind whose events may come late by delay, within a batch and across batches.

    Events wait in the state of their unit's bucket until the watermark (the latest time seen less delay) has passed them, by event-time timers, so the
    result is that of the sorted events. What comes later than delay is dropped by the watermark. The last events wait until later ones come. A bucket's
    state is the state of its units and what they have within delay, and a batch rewrites it; buckets should grow with the units. Start it in rocks_state.
    """
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).withColumn("micros", F.unix_micros("ts"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(buckets))).withColumn("unit", F.col("unit").cast("string"))
    return rows.groupBy("bucket").transformWithStateInPandas(_Ledger(), LEDGER_SHAPE, "Append", "EventTime")
