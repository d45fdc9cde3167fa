"""Last write wins: replays, order, hot keys, plans."""

import random

import pytest
from helpers import plan_of, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from docstream.operators import upsert
from docstream.plans.inputs import log_of
from docstream.schema import RECORD_LOG

COLUMNS = RECORD_LOG.fieldNames()


def log(spark, data):
    base = spark.createDataFrame(
        data, "topic string, partition int, offset bigint, key string, value string, ts bigint"
    )
    return base.select("topic", "partition", "offset", "key", "value", F.timestamp_seconds("ts").alias("timestamp"))


def expected(data):
    """Within a partition the last arrival, between partitions the latest time."""
    arrived = {}
    for topic, partition, offset, key, value, ts in data:
        place = (key, topic, partition)
        if place not in arrived or offset >= arrived[place][0]:
            arrived[place] = (offset, value, ts)
    newest = {}
    for (key, topic, partition), (_, value, ts) in arrived.items():
        order = (ts, topic, partition)
        if key not in newest or order >= newest[key][0]:
            newest[key] = (order, value)
    return sorted((k, v) for k, (_, v) in newest.items())


record = st.tuples(
    st.sampled_from(["a", "b"]),
    st.integers(0, 2),
    st.integers(0, 40),
    st.sampled_from(["k1", "k2", "k3"]),
    st.integers(0, 5),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=30, unique_by=lambda r: r[:3]), st.randoms())
def test_redelivery_in_any_order(spark, records, rng):
    data = [(t, p, o, k, f"{t}{p}{o}", ts) for t, p, o, k, ts in records]
    again = data + [rng.choice(data) for _ in range(len(data))]
    rng.shuffle(again)
    for strategy in ("aggregate", "group_limit"):
        found = upsert.latest_by_key(log(spark, again), strategy=strategy)
        assert rows(found, "key", "value") == expected(data)


def test_all_columns_of_the_winner_are_kept(spark, sf_dir):
    whole = log_of(spark, sf_dir)
    found = upsert.latest_by_key(whole)
    assert found.columns == whole.columns
    assert found.join(whole, COLUMNS, "left_semi").count() == found.count()


def test_variant_and_map_payloads(spark):
    data = [("a", 0, i, "k", f'{{"n":{i}}}', i) for i in range(5)]
    docs = log(spark, data).withColumn("doc", F.parse_json("value"))
    newest = upsert.latest_by_key(docs.withColumn("m", F.create_map(F.lit("x"), F.col("offset"))))
    assert newest.select(F.variant_get("doc", "$.n", "int"), F.col("m")["x"]).first() == (4, 4)


def test_null_keys_and_null_times(spark):
    data = [("a", 0, 0, None, "old", 1), ("a", 0, 1, None, "new", 2), ("a", 0, 2, "k", "untimed", None), ("a", 0, 1, "k", "timed", 5)]
    found = upsert.latest_by_key(log(spark, data))
    # A clock, or the lack of one, says nothing about the order within a partition.
    assert rows(found, "key", "value") == [("k", "untimed"), (None, "new")]
    elsewhere = log(spark, [*data, ("a", 1, 0, "k", "other partition", 3)])
    assert ("k", "other partition") in rows(upsert.latest_by_key(elsewhere), "key", "value")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=20, unique_by=lambda r: r[:3]), st.randoms())
def test_compaction_at_any_split(spark, records, rng):
    data = [(t, p, o, k, f"{t}{p}{o}", ts) for t, p, o, k, ts in records]
    rng.shuffle(data)
    at = rng.randint(0, len(data))
    snapshot = upsert.latest_per_partition(log(spark, data[:at]))
    merged = upsert.merge_latest(snapshot, log(spark, data[at:]))
    assert rows(upsert.between_partitions(merged), "key", "value") == expected(data)


def test_hot_key_is_cut_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "hot")
    (
        spark.range(0, 40_000, 1, 8)
        .select(
            F.lit("t").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("id").alias("offset"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
            F.lit("v").alias("value"),
            F.timestamp_seconds("id").alias("timestamp"),
        )
        .write.parquet(path)
    )
    hot = spark.read.parquet(path)
    found = upsert.latest_by_key(hot)
    assert found.count() == 1 + hot.filter("key <> 'hot'").count()
    assert found.filter("key = 'hot'").first()["offset"] == 39_999
    before_exchange = plan_of(found).split("Exchange")[1]
    assert "partial_max" in before_exchange
    ranked = plan_of(upsert.latest_by_key(hot, strategy="group_limit"))
    assert "Partial" in ranked.split("Exchange")[1]


def test_unknown_strategy(spark, sf_dir):
    with pytest.raises(ValueError):
        upsert.latest_by_key(log_of(spark, sf_dir), strategy="sort")


def test_merge_never_steps_back(spark):
    old = log(spark, [("a", 0, 9, "k", "newer", 9), ("a", 0, 1, "only_old", "x", 1)])
    late = log(spark, [("a", 0, 3, "k", "older", 3), ("a", 0, 2, "only_new", "y", 2)])
    found = upsert.between_partitions(upsert.merge_latest(old, late))
    assert rows(found, "key", "value") == [("k", "newer"), ("only_new", "y"), ("only_old", "x")]


def test_union_of_logs_with_different_columns(spark):
    a = log(spark, [("a", 0, 0, "k", "v", 1)])
    both = upsert.union_logs(a, a.drop("value"))
    assert rows(both, "value") == [("v",), (None,)]


def test_key_partition_violations_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randrange(3), i, f"k{rng.randrange(12)}", "v", i) for i in range(60)]
    places = {}
    for topic, partition, _, key, _, _ in data:
        places.setdefault((topic, key), set()).add(partition)
    want = sorted(
        (t, sum(1 for k in places if k[0] == t), sum(1 for k, p in places.items() if k[0] == t and len(p) > 1))
        for t in "ab"
    )
    assert rows(upsert.key_partition_violations(log(spark, data))) == want
