"""Incremental scans, merges, contracts, hashes and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.temporal import latest


def scan_since(df: DataFrame, columns: list[str], watermark: str, since=None, lookback: str | None = None, strategy: str = "incremental", initial_where: Column | None = None, batch: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """Pruned to columns; incremental re-reads the look-back, append reads what is newer. The bound stays on the raw column and is pushed down.

    Without since it is the first load: initial_where instead of a bound. batch: the rows of one load, the oldest first by
    watermark and keys, so that the next one goes on from its watermark.
    """
    if batch is not None:
        rows = scan_since(df, list(dict.fromkeys([*columns, watermark, *(keys or [])])), watermark, since, lookback, strategy, initial_where)
        return rows.orderBy(watermark, *(keys or [])).limit(batch).select(*columns)
    if since is None:
        return (df if initial_where is None else df.where(initial_where)).select(*columns)
    bound = F.lit(since).cast(df.schema[watermark].dataType)
    if strategy == "append":
        return df.where(F.col(watermark) > bound).select(*columns)
    return df.where(F.col(watermark) >= (bound - F.expr(f"INTERVAL {lookback}") if lookback else bound)).select(*columns)


def merge_incremental(target: DataFrame, batch: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """target with the batch's latest row of each key in place of its own."""
    new = latest(batch, keys, *order)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def with_audit(df: DataFrame, run_id: str, loaded_at) -> DataFrame:
    for name in ("_etl_loaded_at", "_etl_source_run_id"):
        if name in df.columns:
            raise ValueError(f"{name} is a reserved column")
    return df.withColumns({"_etl_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"), "_etl_source_run_id": F.lit(run_id)})


def merge_append(target: DataFrame, batch: DataFrame, run_id: str, loaded_at) -> DataFrame:
    return target.unionByName(with_audit(batch, run_id, loaded_at), allowMissingColumns=True)


def replace_full(df: DataFrame, path: str) -> None:
    """Writes beside path and swaps the folders once all is written: a job that fails leaves the old table, and df may read it."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}.new-{mark}")
    place = spark._jvm.org.apache.hadoop.fs.Path
    now, new, old = place(path), place(f"{path}.new-{mark}"), place(f"{path}.old-{mark}")
    files = now.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(now)
    if had and not files.rename(now, old):
        raise OSError(f"{path} can't be moved aside")
    if not files.rename(new, now):
        if had:
            files.rename(old, now)
        raise OSError(f"{path} can't be replaced")
    if had:
        files.delete(old, True)


def upsert_partitions(df: DataFrame, path: str, by: str, keys: list[str]) -> None:
    """df's rows in place of those with the same (by, keys) in the table at path; only the partitions that df has are read and written."""
    spark = df.sparkSession
    old = spark.read.schema(df.schema).parquet(path).select(*df.columns).join(df.select(by).distinct(), by, "left_semi")
    merged = old.join(df.select(by, *keys), [by, *keys], "left_anti").select(*df.columns).unionByName(df)
    staged = f"{path}.new-{uuid.uuid4().hex}"
    merged.write.parquet(staged)  # the partitions to replace are read before they go
    write_partitions(spark.read.schema(df.schema).parquet(staged), path, by)


def export_by(df: DataFrame, path: str, by: str, *order: str) -> str:
    """One folder of CSV files for each value of by, with the columns in df's order and rows in the given one."""
    df.repartition(by).sortWithinPartitions(by, *order).write.option("header", True).partitionBy(by).csv(path)
    return path


def canonical_rows(raw: DataFrame, aliases: dict[str, list[str]], required: list[str], unique: list[str], derived: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a raw table of strings. Headers are matched trimmed and without case, blanks are null, and each
    name takes the first of its aliases that has a value; derived fills what is still null.

    A row without a required value is rejected (MISSING), and so are all rows of a value that unique says is there once
    (DUPLICATE; compared without case): rejected has their reasons.
    """
    there = {c.strip().lower(): c for c in raw.columns}
    value = lambda c: F.nullif(F.trim(F.col(f"`{there[c]}`")), F.lit(""))
    named = raw.select(*(F.coalesce(*(value(a) for a in names if a in there), F.lit(None).cast("string")).alias(name) for name, names in aliases.items()))
    for name, fill in (derived or {}).items():
        named = named.withColumn(name, F.coalesce(name, fill))
    marked = named
    for c in unique:
        twice = named.groupBy(F.lower(c).alias(f"_{c}")).count().where(f"_{c} is not null and count > 1").select(f"_{c}", F.lit(True).alias(f"_{c}_twice"))
        marked = marked.join(twice, F.lower(c) == F.col(f"_{c}"), "left")
    reasons = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"MISSING:{c}")) for c in required), *(F.when(F.col(f"_{c}_twice"), F.lit(f"DUPLICATE:{c}")) for c in unique)))
    marked = marked.select(*named.columns, reasons.alias("reasons"))
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def contract_rows(raw: DataFrame, dates: list[str] = (), times: list[str] = (), numbers: list[str] = (), optional: list[str] = (), rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a table of strings under a contract: strict dates, times with a zone, finite decimals, values
    where they aren't optional, and rules (name to condition over the parsed columns). rejected has the reasons."""
    text = {c: F.nullif(F.trim(c), F.lit("")) for c in raw.columns}
    parsed, bad = {}, []
    for c in raw.columns:
        if c in dates:
            parsed[c] = F.when(text[c].rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text[c], F.lit("yyyy-MM-dd")).cast("date"))
        elif c in times:
            parsed[c] = F.when(text[c].rlike(r"(Z|[+-]\d{2}:\d{2})$"), text[c].try_cast("timestamp"))
        elif c in numbers:
            parsed[c] = text[c].try_cast("decimal(38,6)")
        else:
            parsed[c] = text[c]
        bad.append(F.when(text[c].isNotNull() & parsed[c].isNull(), F.lit(f"INVALID:{c}")))
        if c not in optional:
            bad.append(F.when(text[c].isNull(), F.lit(f"MISSING:{c}")))
    rows = raw.select(*(v.alias(c) for c, v in parsed.items()), F.array_compact(F.array(*bad)).alias("_bad"))
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(True)), F.lit(f"RULE:{name}")) for name, ok in (rules or {}).items()), F.lit(None).cast("string")))
    rows = rows.withColumn("reasons", F.concat("_bad", broken)).drop("_bad")
    return rows.where(F.size("reasons") == 0).drop("reasons"), rows.where(F.size("reasons") > 0)


def append_new_keys(target: DataFrame, batch: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of batch to add, conflicts): a key that is there with the same content is left as it is, one with other content is a conflict,
    in the target or inside the batch."""
    content = [c for c in batch.columns if c not in keys]
    once = batch.distinct()
    twice = once.groupBy(*keys).count().where("count > 1").select(*keys)
    same = F.lit(True)
    for c in content:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = once.join(target.select(*keys, *(F.col(c).alias(f"_{c}") for c in content), F.lit(True).alias("_there")), keys, "left")
    conflicts = both.where(F.col("_there") & ~same).select(*batch.columns).unionByName(once.join(twice, keys, "left_semi").select(*batch.columns)).distinct()
    return both.where("_there is null").select(*batch.columns).join(twice, keys, "left_anti").select(*batch.columns), conflicts


def cast_to_contract(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The table in the declared types, and how many values of each column the cast loses; one pass for all columns."""
    cast = df.select(*(F.col(c).try_cast(t).alias(c) for c, t in types.items()))
    lost = df.agg(*(F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()))
    return cast, lost


#: Columns that loads write themselves.
RESERVED = ("_row_hash", "_rules", "_loaded_at", "_run_id")


def evolve_schema(target: DataFrame, source: DataFrame, keys: list[str], watermark: str | None = None, reserved: tuple[str, ...] = RESERVED) -> DataFrame:
    """The rows of both under the columns of either; keys and watermark must be there, and the source may not have reserved columns."""
    taken = sorted(c for c in source.columns if c.lower() in reserved)
    if taken:
        raise ValueError(f"the source has reserved columns {taken}")
    missing = [c for c in (*keys, *([watermark] if watermark else [])) if c not in source.columns]
    if missing:
        raise ValueError(f"the source lacks {missing}")
    return target.unionByName(source, allowMissingColumns=True)


def key_audit(df: DataFrame, keys: list[str], watermark: str) -> DataFrame:
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(null).alias("nulls"), F.min(watermark).alias("lo"), F.max(watermark).alias("hi"))
    return groups.agg(F.sum("nulls").alias("null_keys"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.min("lo").alias("min_watermark"), F.max("hi").alias("max_watermark"))


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """The hash of the values of columns of df; equal numbers have equal hashes, so a zero of either sign is 0."""
    kinds = dict(df.dtypes)
    value = lambda c: (F.when(F.col(c) == 0, F.lit(0).cast(kinds[c])).otherwise(F.col(c)) if kinds[c] in ("float", "double") else F.col(c)).alias(c)
    return F.sha2(F.to_json(F.struct(*map(value, sorted(columns))), {"ignoreNullFields": "false"}), 256)


def incremental_by_hash(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Each key of either side with what happens to it: INSERT, UPDATE, DELETE or UNCHANGED."""
    a = source.select(*keys, row_hash(source, columns).alias("_new"))
    b = target.select(*keys, row_hash(target, columns).alias("_old"))
    what = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").when(F.col("_new") != F.col("_old"), "UPDATE").otherwise("UNCHANGED")
    return a.join(b, keys, "full_outer").select(*keys, what.alias("what"))


def hashed(df: DataFrame, columns: list[str], rules: str) -> DataFrame:
    """df as a target: with the hash of each row and the version of the rules that made it."""
    return df.withColumns({"_row_hash": row_hash(df, columns), "_rules": F.lit(rules)})


def load_plan(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], rules: str) -> DataFrame:
    """Each key of either side with what a load does: INSERT, DELETE, UPDATE, UNCHANGED, or REBUILD of rows that other rules made, whatever their hash."""
    a = source.select(*keys, row_hash(source, columns).alias("_new"))
    b = target.select(*keys, F.col("_row_hash").alias("_old"), F.col("_rules").alias("_by"))
    old = ~F.col("_by").eqNullSafe(F.lit(rules))
    what = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").when(old, "REBUILD").when(F.col("_new") != F.col("_old"), "UPDATE").otherwise("UNCHANGED")
    return a.join(b, keys, "full_outer").select(*keys, what.alias("what"))


def apply_plan(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], rules: str) -> DataFrame:
    """The target after the load: unchanged rows as they are, the others from the source, deleted ones gone."""
    what = load_plan(source, target, keys, columns, rules)
    kept = target.join(what.where("what = 'UNCHANGED'").select(*keys), keys, "left_semi")
    new = source.join(what.where("what in ('INSERT', 'UPDATE', 'REBUILD')").select(*keys), keys, "left_semi")
    return kept.unionByName(hashed(new, columns, rules))


def hash_mismatches(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], rules: str) -> DataFrame:
    """The keys in which a target differs from its source: only on one side, another hash, or other rules. A load passes if there is none."""
    return load_plan(source, target, keys, columns, rules).where("what <> 'UNCHANGED'")


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
