"""Structured Streaming jobs; each runs on a stream as on a table, and ends when the input there is is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ledger import STATES
from ..session import shared


def file_stream(df: DataFrame, path: str) -> DataFrame:
    """The rows of a parquet file, or of a folder of such files under any name, as a stream with the table's schema."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(df.schema)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.option("pathGlobFilter", "*.parquet").parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs the stream over what is there and returns what it wrote."""
    spark, out = stream.sparkSession, shared(stream.sparkSession, "out")
    if mode == "append":
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared(spark, "state")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    else:  # the last full result stands
        stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", shared(spark, "state")).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def upsert_stream(stream: DataFrame, keys: list[str], watermark: str, *order) -> DataFrame:
    """Each batch's latest row of a key replaces the target's; late rows that the source reads again merge once more.

    Targets are written side by side and the name of the newest is passed on, so a batch that fails leaves the old one.
    """
    spark, base = stream.sparkSession, shared(stream.sparkSession, "upsert")
    state = {"path": None}

    def merge(batch: DataFrame, number: int) -> None:
        target = spark.read.schema(batch.schema).parquet(state["path"]) if state["path"] else batch.limit(0)
        both = target.unionByName(batch)
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        both.withColumn("_r", rank).where("_r = 1").drop("_r").write.mode("overwrite").parquet(path := f"{base}/{number}")
        state["path"] = path

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", shared(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(state["path"]) if state["path"] else spark.createDataFrame([], stream.schema)


def ledger_stream(stream: DataFrame) -> DataFrame:
    """unit, event_id, kind, before_state, after_state, applied: the inventory state machine with a state for each unit.

    Rows of a unit that one batch brings are taken in time order; a batch as a whole must not be older than the one before.
    """
    import pandas as pd

    steps = {("ALTA", 0): 1, ("SEPARACION", 1): 2, ("VENTA", 2): 3, ("CAIDA", 2): 1, ("CAIDA", 3): 1}
    names = STATES

    def advance(key, frames, state):
        now = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        out = []
        for event, kind in zip(rows["event_id"], rows["kind"]):
            new = steps.get((kind, now), now)
            out.append((key[0], event, kind, names[now], names[new], new != now))
            now = new
        state.update((now,))
        yield pd.DataFrame(out, columns=["unit", "event_id", "kind", "before_state", "after_state", "applied"])

    return stream.groupBy("unit").applyInPandasWithState(advance, "unit long, event_id long, kind string, before_state string, after_state string, applied boolean", "state int", "append", "NoTimeout")


def windowed_counts(events: DataFrame, time: str, width: str, key: str, slide: str | None = None, late: str = "1 day", start: str | None = None) -> DataFrame:
    """Counts of each key in tumbling or sliding windows, on a table or a stream. start: how far windows begin after those that the epoch begins."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    g = rows.groupBy(F.window(time, width, slide or width, start), key).agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")


def message_events(messages: DataFrame) -> DataFrame:
    """One row for each thing a message says, by versioned rules."""
    rules = (("QUESTION", r"\?"), ("NUMBER", r"\d+"), ("LIST", r","))
    found = F.array(*(F.struct(F.lit(n).alias("event"), F.size(F.regexp_extract_all("text", F.lit(p), 0)).alias("mentions")) for n, p in rules))
    return messages.select("conv_id", "turn", F.inline(F.filter(found, lambda e: e["mentions"] > 0))).withColumn("rules_version", F.lit("v1"))


def reactions(announcements: DataFrame, answers: DataFrame, seconds: int = 900, named_seconds: int = 86_400) -> DataFrame:
    """conv_id, announcement, answer, how: what an answer may react to. EXPLICIT: the announcement that it names, up to named_seconds
    before; INTERVAL: of answers that name none, each announcement of the conversation up to seconds before."""
    a, b = announcements, answers
    if a.isStreaming:
        a, b = a.withWatermark("said_at", "1 day"), b.withWatermark("at", "1 day")
    longest = F.expr(f"INTERVAL {max(seconds, named_seconds)} SECONDS")
    after = (F.col("conv_id") == F.col("conv")) & (F.col("at") > F.col("said_at")) & (F.col("at") <= F.col("said_at") + longest)
    both = a.join(b.withColumnRenamed("conv_id", "conv"), after)
    explicit = (F.col("named") == F.col("announcement")) & (F.col("at") <= F.col("said_at") + F.expr(f"INTERVAL {named_seconds} SECONDS"))
    near = F.col("named").isNull() & (F.col("at") <= F.col("said_at") + F.expr(f"INTERVAL {seconds} SECONDS"))
    how = F.when(explicit, "EXPLICIT").when(near, "INTERVAL")
    return both.withColumn("how", how).where("how is not null").select("conv_id", "announcement", "answer", "how")


def single_reactions(found: DataFrame) -> DataFrame:
    """Of reactions by interval only those of answers with one candidate."""
    g = found.groupBy("conv_id", "answer", "how").agg(F.min("announcement").alias("announcement"), F.count("*").alias("n"))
    return g.where("n = 1 or how = 'EXPLICIT'").select("conv_id", "announcement", "answer", "how")


def parse_chat_lines(lines: DataFrame, header: str = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2})\] ([^:]+): (.*)$") -> DataFrame:
    """source, message_id, ordinal, sent_at, sender, body of chat lines (source, line_no, text): a line without a header continues the message before."""
    own = Window.partitionBy("source").orderBy("line_no")
    starts = lines.withColumn("starts", F.col("text").rlike(header).cast("int")).withColumn("ordinal", F.sum("starts").over(own))
    body = F.when(F.col("starts") == 1, F.regexp_extract("text", header, 3)).otherwise(F.col("text"))
    grouped = starts.where("ordinal > 0").groupBy("source", "ordinal").agg(
        F.max(F.when(F.col("starts") == 1, F.regexp_extract("text", header, 1))).alias("sent_at"),
        F.max(F.when(F.col("starts") == 1, F.regexp_extract("text", header, 2))).alias("sender"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", body.alias("body")))), lambda x: x["body"]), "\n").alias("body"),
    )
    again = F.row_number().over(Window.partitionBy("source", "sent_at", "sender", "body").orderBy("ordinal"))
    return grouped.withColumn("again", again).select("source", F.sha2(F.concat_ws("|", "source", "sent_at", "sender", "body", "again"), 256).alias("message_id"), "ordinal", "sent_at", "sender", "body")


def append_only(known: DataFrame, batch: DataFrame, order: str, content: str) -> tuple[DataFrame, DataFrame]:
    """(rows of known that the batch lacks or tells otherwise, the batch's rows after known): load the second only if the first is empty."""
    new = batch.select(F.col(order).alias("_o"), F.col(content).alias("_c"))
    changed = known.join(new, known[order] == F.col("_o"), "left").where(~F.col(content).eqNullSafe(F.col("_c"))).select(*known.columns)
    return changed, batch.join(known.select(order), order, "left_anti")
