"""What larger tables have and the smallest ones lack: tables that are folders, zeros of both signs, ranks that a sketch misses."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lifemart import registry
from lifemart.operators import quantiles
from lifemart.plans import inference, load_all, models
from lifemart.session import written

load_all()
SMALL = "/root/testdata/sf0.001"


def held(spark, name, folder, **tables):
    """Whether a query over folder gives the rows of its SQL over the given files."""
    duck = duckdb.connect()
    for table, files in tables.items():
        duck.execute(f"create view {table} as select * from read_parquet('{files}')")
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    found = registry.QUERIES[name](spark, str(folder)).select(names)
    rows = Counter(map(tuple, found.collect()))
    assert rows
    return rows == Counter(result.fetchall())


@pytest.mark.parametrize("name", ["src17_incremental_by_hash", "src17_rule_versions"])
def test_zeros_of_both_signs_are_equal(spark, tmp_path, name):
    rows = [(k, -0.0 if k % 3 else 0.0) for k in range(60)]
    spark.createDataFrame(rows, "c_custkey long, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert held(spark, name, tmp_path, customer=f"{tmp_path}/customer.parquet/*.parquet")


@pytest.mark.parametrize("name", ["st03_conversation_reactions", "st06_message_events"])
def test_streams_read_tables_that_are_folders(spark, tmp_path, name):
    spark.read.parquet(f"{SMALL}/conversations.parquet").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert held(spark, name, tmp_path, conversations=f"{SMALL}/conversations.parquet")


def test_identity_counts_every_client_of_a_document(spark, tmp_path):
    clients, users = [*range(300), None], [5, 5, 96, 298, 400, 10_000, None]
    spark.createDataFrame([(k,) for k in clients], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k,) for k in users], "user_id long").write.parquet(f"{tmp_path}/events.parquet")
    found = {r["source"]: (r["candidates"], r["evidence"]) for r in registry.QUERIES["jn16_multi_key_identity"](spark, str(tmp_path)).collect()}
    assert found == {u: (sum(c % 97 == u % 97 for c in clients[:-1]), 1 + (u < 300)) for u in users[:-1]}


def test_contamination_by_exact_ranks(spark, tmp_path):
    draw = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) / float(1 << 44)
    lines = spark.range(2_500_000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 1000).alias("l_partkey"), draw(1).alias("l_extendedprice"), draw(2).alias("l_quantity"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert held(spark, "ml28_contamination", tmp_path, lineitem=f"{tmp_path}/lineitem.parquet/*.parquet")


@pytest.mark.parametrize("name", ["ml03_unit_sale_probability", "ml04_fall_risk_benchmark", "ml06_logit_table", "ml13_reason_topics", "ml22_t_learner", "ml29_partial_dependence", "ml29_permutation_all"])
def test_fits_pass_over_a_written_table(spark, monkeypatch, name):
    """The rounds of a fit must not repeat the joins or the reading of texts before it."""
    labels = []
    for plans in (models, inference):
        monkeypatch.setattr(plans, "written", lambda df, label: labels.append(label) or written(df, label))
    registry.QUERIES[name](spark, SMALL)
    assert labels


def test_ranks_of_a_column_share_a_sketch(spark, monkeypatch):
    """Ten ranks of a column are one sketch a round, and the values are those of numpy."""
    sketches, real = [], F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *x: sketches.append(1) or real(*x))
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"), (F.col("id") % 3).alias("g"))
    wanted = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = quantiles.exact_quantiles(rows, ["x", "y"], wanted, small=15_000)
    assert len(sketches) == 2
    found |= quantiles.exact_quantiles(rows, ["x", "y"], [0.1], small=10)
    held = rows.collect()
    for (c, p), v in found.items():
        assert v == pytest.approx(np.quantile([r[c] for r in held], p), rel=1e-12)
    for r in quantiles.grouped_quantiles(rows.withColumn("g", F.nullif("g", F.lit(2))), "g", "x", wanted, "q", small=10).collect():
        assert r["q"] == pytest.approx(list(np.quantile([h["x"] for h in held if h["g"] == (2 if r["g"] is None else r["g"])], wanted)), rel=1e-12)
