"""A training corpus from raw documents: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifemart.llm import jaccard, packing, passages, quality
from lifemart.llm.common import materialise
from lifemart.llm.queries import BYTE_BPE, table

#: Names a row where ids may repeat or be missing.
ROW = "_row"
#: Numbers of rows (8 bytes each) that every executor may hold; beyond that they are joined by a shuffle.
MOST_HELD = 2_000_000


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model, learned from the labelled ones among docs, doesn't reject; rows of one id are judged by their own texts.

    Null and empty texts are scored by their counts; without labels nothing is rejected.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ROW, a number of each row: the id of rows that have one of their own, and numbers above all ids for the others."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_id"))
    shared = materialise(ids.groupBy("_id").count().where("_id is null or count > 1").select("_id"), "shared")
    if shared.isEmpty():
        return docs.withColumn(ROW, F.col("doc_id").cast("long"))
    same, base = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), (ids.agg(F.max("_id")).first()[0] or 0) + 1
    if base > 1 << 62:  # no room above
        return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    odd = materialise(docs.join(shared, same, "left_semi").withColumn(ROW, F.monotonically_increasing_id() + max(base, 0)), "odd")
    return docs.join(shared, same, "left_anti").withColumn(ROW, F.col("doc_id").cast("long")).unionByName(odd)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id; rows without an id rank last.

    Rows are what is compared, each under a number of its own: rows that repeat an id stay or go by their own texts.
    Texts without words are like none, but of those that are equal and have one id (or none) one row stays.
    """
    rows = numbered(docs)
    found = jaccard.near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), F.col("n_shingles").alias("_n"), F.col("component_id").alias("_group"))
    found = materialise(found, "found")
    own = rows.select(ROW, F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.xxhash64("text"), ROW).alias("_rank"))
    worded = own.join(found.where("_n > 0"), ROW).groupBy("_group").agg(F.min("_rank").alias("_rank")).select(F.col(f"_rank.{ROW}"))
    blank = rows.where(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))  # else whole texts would be shuffled to find these
    wordless = blank.join(found.where("_n = 0"), ROW, "left_semi").groupBy("doc_id", F.coalesce("text", F.lit(""))).agg(F.min(ROW).alias(ROW)).select(ROW)
    later = materialise(found.select(ROW).join(worded.unionByName(wordless), ROW, "left_anti").distinct(), "later")
    held = F.broadcast(later) if later.count() <= MOST_HELD else later  # else whole texts would be shuffled for them
    return rows.join(held, ROW, "left_anti").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur in an earlier document; a null text stays null, and a text that is left empty stays as a row."""
    return passages.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Each row of docs, an empty one too, is packed."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [("quality", keep_quality), ("near_duplicates", one_of_near_duplicates), ("passages", without_repeats), ("packing", packed)]

#: No stage but the first filter's join could be said in SQL (a learned model, an exact Jaccard closure, a tokenizer); the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
