"""Shards, fan-out, eligibility and audits."""

from contextlib import contextmanager

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from docstream.operators import audit, routing
from docstream.plans.inputs import log_of, targets_of
from docstream.schema import TARGETS


def keys(spark, n=500):
    return spark.range(n).select(F.col("id").cast("string").alias("key"))


def targets(spark, *data):
    return spark.createDataFrame(list(data), TARGETS)


@pytest.mark.parametrize("method", ["murmur3", "md5"])
def test_every_key_has_one_shard(spark, method):
    routed = routing.assign_shard(keys(spark), 4, method=method)
    counts = {r["shard_id"]: r["n_docs"] for r in audit.shard_counts(routed).collect()}
    assert set(counts) == {0, 1, 2, 3}
    assert sum(counts.values()) == 500
    assert routed.groupBy("key").agg(F.count_distinct("shard_id").alias("n")).filter("n > 1").count() == 0


def test_shards_follow_the_shuffle(spark):
    """With a partition count that is a multiple of the shard count a task holds one shard."""
    routed = routing.assign_shard(keys(spark).repartition(8, "key"), 4)
    by_task = routed.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("shard_id").alias("n"))
    assert {r["n"] for r in by_task.collect()} == {1}


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        routing.assign_shard(keys(spark), 4, method="crc")


def test_every_shard_holds_all(spark):
    counts = audit.shard_counts(routing.every_shard(keys(spark), 3))
    expected = keys(spark).agg(F.count(F.lit(1)))
    assert rows(counts) == [(0, 500), (1, 500), (2, 500)]
    assert audit.shard_count_check(counts, expected).count() == 0
    assert audit.shard_count_check(counts.filter("shard_id < 2").union(spark.createDataFrame([(2, 499)], "a int, b bigint")), expected).count() == 1


def test_fan_out_is_an_equi_join(spark, sf_dir):
    cores = targets_of(spark, sf_dir).select("collection", "core")
    out = routing.fan_out(keys(spark).withColumn("collection", F.lit("c0")), cores)
    plan = plan_of(out)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("salts", [1, 7])
def test_fan_out_reaches_every_target_of_its_collection_once(spark, salts):
    name = F.concat(F.lit("c"), F.pmod(F.col("id"), F.lit(2)))
    cores = spark.range(40).select(name.alias("collection"), F.concat(F.lit("core"), F.col("id")).alias("core"))
    docs = keys(spark, 20).withColumn("collection", F.lit("c1"))
    out = routing.fan_out(docs, cores, salts=salts)
    assert out.count() == out.distinct().count() == 400
    assert rows(routing.fan_out_counts(docs, cores), "n_docs") == [(20,)] * 20


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_fan_out_by_blocks_is_the_plain_join(spark, monkeypatch, broadcast):
    """Part blocks, several slabs, rows that come twice, nulls and collections on one side only."""
    monkeypatch.setattr(routing, "BLOCK_ROWS", 3)
    monkeypatch.setattr(routing, "SLAB_BLOCKS", 2)
    docs = spark.createDataFrame(
        [(f"k{i % 19}", f"c{i % 3}", i % 5) for i in range(40)] + [(None, "c0", 1), (None, "c0", 1), ("k", None, 2)],
        "key string, collection string, n int",
    )
    cores = spark.createDataFrame(
        [(i, f"c{i * i % 5}", f"core{i % 23}") for i in range(31)] + [(None, "c0", None), (7, None, "x")] + [(0, "c0", "core0")] * 2,
        "shard_id int, collection string, core string",
    )
    with _broadcast(spark, broadcast):
        out, plain = routing.fan_out(docs, cores, salts=3), docs.join(cores, "collection")
        assert out.dtypes == plain.dtypes
        assert rows(out) == rows(plain)


@contextmanager
def _broadcast(spark, most):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def test_fan_out_to_many_targets_is_stored_small(spark, tmp_path):
    """Six million rows; in the order document by document, targets repeat too far apart to shrink."""
    docs = keys(spark, 500).withColumn("collection", F.lit("c"))
    cores = spark.range(12_000).select(
        F.lit("c").alias("collection"), F.format_string("Supplier#%09d", F.col("id") * 7919 % 1_000_003).alias("core")
    )
    path = f"{tmp_path}/copies"
    with _broadcast(spark, "-1"):
        routing.fan_out(docs, cores, salts=1).write.parquet(path)
    found = spark.read.parquet(path).groupBy("core").agg(F.count_distinct("key").alias("keys"), F.count(F.lit(1)).alias("n"))
    assert rows(found.groupBy("keys", "n").count()) == [(500, 500, 12_000)]
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 0.4 * 6_000_000


T = [
    ("c", 0, "a", "NRT", "active", False, 5),
    ("c", 0, "b", "PULL", "active", True, 5),
    ("c", 1, "d", "PULL", "down", False, 6),
    ("c", 1, "e", "TLOG", "active", False, 7),
    ("other", 0, "f", "PULL", "active", False, 5),
]


def test_eligibility(spark):
    df = targets(spark, *T)
    assert rows(routing.eligible_targets(df, all_shards=True), "core") == [("a",), ("b",)]
    assert routing.eligible_targets(df, all_shards=False).count() == 5
    assert routing.eligible_targets(df, all_shards=True, clustered=False).count() == 5


def test_mode(spark):
    df = targets(spark, *T)
    assert rows(routing.mode_report(df)) == [("c", True, False), ("other", False, True)]
    routing.check_mode(df, "c", all_shards=False)
    routing.check_mode(df, "other", all_shards=True)
    with pytest.raises(ValueError, match="TLOG"):
        routing.check_mode(df, "c", all_shards=True)


def test_replica_audits(spark):
    df = targets(spark, *T)
    assert rows(audit.inactive_targets(df), "core") == [("d",)]
    wrong = audit.replica_mismatches(df)
    assert rows(wrong) == [("c", 1, 6, 7, 2, 0)]
    assert audit.error_report(wrong).first()["message"] == "shard 1: between 6 and 7 documents"
    unknown = targets(spark, ("c", 0, "a", "NRT", "active", True, None), ("c", 0, "b", "NRT", None, False, 3))
    assert audit.replica_mismatches(unknown).first()["n_unknown"] == 1
    assert audit.inactive_targets(unknown).count() == 1


def test_sum_check(spark):
    counts = spark.createDataFrame([(0, 3), (1, 4)], "shard_id int, n_docs bigint")
    seven = spark.range(7).agg(F.count(F.lit(1)))
    assert audit.shard_sum_check(counts, seven).first() == (7, 7, True)
    assert not audit.shard_sum_check(counts, spark.range(8).agg(F.count(F.lit(1)))).first()["agrees"]


def test_dense_offsets_add_up(spark):
    log = spark.range(100).select(
        F.lit("t").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"), F.floor(F.col("id") / 4).alias("offset")
    )
    from docstream.operators.offsets import end_offsets

    assert audit.seeded_vs_end(log, end_offsets(log)).first() == ("t", 100, 100, True)
    missing = log.filter("offset <> 3")
    assert audit.seeded_vs_end(missing, end_offsets(missing)).first() == ("t", 96, 100, False)


def test_counts_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(audit.doc_count(log_of(spark, sf_dir)))
    assert "ReadSchema: struct<user_id:bigint>" in plan
