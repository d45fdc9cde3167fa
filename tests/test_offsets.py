"""Commits, lag, stalls, replay and gaps against small cases and brute force."""

import random

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from docstream.functions.names import end_key, group_name, lag_key
from docstream.operators import documents, offsets
from docstream.plans.inputs import log_of
from docstream.schema import RECORD_LOG

GROUP = "KafkaImporterGroup:c"


def at(seconds):
    return F.timestamp_seconds(F.lit(seconds))


def classified(spark, data):
    """(topic, partition, offset, second, accepted)"""
    base = spark.createDataFrame(data, "topic string, partition int, offset bigint, s double, ok boolean")
    return base.select(
        "topic",
        "partition",
        "offset",
        F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint")).alias("timestamp"),
        F.when(F.col("ok"), F.struct(F.lit(1).alias("k"))).alias("doc"),
    )


def committed(spark, *data):
    return spark.createDataFrame(
        list(data), "group_id string, topic string, partition int, committed_offset bigint"
    )


def ends(spark, *data):
    return spark.createDataFrame(list(data), "topic string, partition int, end_offset bigint")


def history(spark, totals, group="g"):
    return spark.createDataFrame(
        [(group, i, t) for i, t in enumerate(totals)], "group_id string, poll int, total_lag bigint"
    )


def test_names(spark):
    one = spark.range(1).select(
        group_name(F.lit("c")),
        group_name(F.lit("c"), F.lit("c_shard1"), all_shards=True),
        group_name(F.lit("c"), F.lit("c_shard1"), all_shards=False),
        lag_key(F.lit("t"), F.lit(3), F.lit(GROUP)),
        end_key(F.lit("t"), F.lit(3)),
    )
    assert tuple(one.first()) == (GROUP, GROUP + ":c_shard1", GROUP, "t-3:" + GROUP, "t3")


def test_next_offset_passes_over_rejects(spark):
    log = classified(spark, [("t", 0, 4, 0.0, True), ("t", 0, 5, 1.0, False), ("t", 0, 6, 2.0, True), ("t", 1, 9, 0.0, False)])
    assert rows(offsets.next_offsets(log)) == [("t", 0, 7)]


def test_commits_come_one_round_late(spark):
    log = classified(spark, [("t", 0, 0, 0.5, True), ("t", 0, 1, 4.9, True), ("t", 0, 2, 5.0, True), ("t", 0, 3, 12.0, False)])
    ledger = offsets.commit_ledger(log, GROUP)
    assert rows(ledger.select(F.unix_seconds("round"), "next_offset", F.unix_seconds("commit_at"), "n_ok", "n_bad")) == [
        (0, 2, 10, 2, 0),
        (5, 3, 15, 1, 0),
    ]
    assert offsets.committed_as_of(ledger, at(9)).count() == 0
    assert rows(offsets.committed_as_of(ledger, at(10)), "committed_offset") == [(2,)]
    assert rows(offsets.committed_as_of(ledger, at(100)), "committed_offset") == [(3,)]


def test_lag_rules(spark):
    groups = committed(
        spark,
        (GROUP, "t", 0, 5),
        (GROUP, "t", 1, 12),
        (GROUP, "gone", 0, 1),
        ("KafkaImporterGroup:other:core", "t", 0, 9),
        ("someone-else", "t", 0, 1),
    )
    end = ends(spark, ("t", 0, 10), ("t", 1, 10), ("t", 2, 3), ("u", 0, 4))
    report = offsets.lag_report(groups, end, topics=["t", "gone"])
    assert rows(report, "lag_key", "lag") == [
        ("t-0:KafkaImporterGroup:c", 5),
        ("t-0:KafkaImporterGroup:other:core", 1),
        ("t-1:KafkaImporterGroup:c", -2),
    ]
    assert tuple(offsets.lag_summary(report).first()) == (4, 5, "t-0:KafkaImporterGroup:c")
    assert offsets.lag_report(groups, end, collection="c").count() == 2
    full = offsets.lag_report(groups, end, topics=["t"], collection="c", include_uncommitted=True)
    assert rows(full, "partition", "lag") == [(0, 5), (1, -2), (2, 3)]


def test_summary_of_no_lag(spark):
    empty = offsets.lag_report(committed(spark), ends(spark, ("t", 0, 1)))
    assert tuple(offsets.lag_summary(empty).first()) == (0, None, None)


def test_equal_lags_are_told_apart(spark):
    report = offsets.lag_report(
        committed(spark, (GROUP, "a", 0, 0), (GROUP, "b", 0, 0)), ends(spark, ("a", 0, 7), ("b", 0, 7))
    )
    assert offsets.lag_summary(report).first()["most_behind_partition"] == "b-0:" + GROUP
    assert rows(offsets.top_laggards(report, 1), "topic") == [("a",)]


def test_end_offsets_by_name(spark):
    log = classified(spark, [("t", 0, 4, 0.0, True), ("t", 1, 2, 0.0, True), ("u", 0, 9, 0.0, True)])
    assert rows(offsets.end_offsets_by_name(log, "t")) == [("t0", 5), ("t1", 3)]


@pytest.mark.parametrize(
    "totals,expected,n_still,stalled",
    [
        ([10, 10, 10, 7, 7, 7, 7, 0], 10, 6, False),
        ([10] * 12 + [0], 10, 12, True),
        ([9, 8, 7, 0], 10, 0, False),
        ([10, None, 10, 0], 10, 3, False),
        ([0, 5, 5, 5], 10, 0, False),
        ([-3], 10, 0, False),
    ],
)
def test_stalls(spark, totals, expected, n_still, stalled):
    found = offsets.stall_count(history(spark, totals), expected).first()
    assert (found["n_still"], found["stalled"]) == (n_still, stalled)


def test_lag_history_brute_force(spark):
    rng = random.Random(5)
    data, offset = [], {}
    for second in range(0, 120, 3):
        place = ("t", rng.randrange(2))
        offset[place] = offset.get(place, -1) + rng.randrange(1, 4)
        data.append((*place, offset[place], float(second), True))
    log = classified(spark, data)
    ledger = offsets.commit_ledger(log, GROUP, 10)
    found = {r["p"]: r["total_lag"] for r in offsets.lag_history(log, ledger, 10).select(F.unix_seconds("poll").alias("p"), "total_lag").collect()}
    rounds = {}
    for topic, p, o, s, _ in data:
        rounds[(p, int(s) // 10 * 10)] = max(o + 1, rounds.get((p, int(s) // 10 * 10), 0))
    for poll in range(10, 130, 10):
        total, any_row = 0, False
        for p in (0, 1):
            done = [n for (q, r), n in rounds.items() if q == p and r + 20 <= poll]
            seen = [o + 1 for _, q, o, s, _ in data if q == p and s < poll]
            if done and seen:
                any_row = True
                total += max(max(seen) - max(done), 0)
        assert found.get(poll) == (total if any_row else None), poll


def test_replay_window(spark):
    log = classified(spark, [("t", p, o, 0.0, True) for p in (0, 1) for o in range(5)])
    again = offsets.replay_window(log, committed(spark, (GROUP, "t", 0, 3)))
    assert rows(again, "partition", "offset") == [(0, 3), (0, 4)] + [(1, o) for o in range(5)]


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_gaps_brute_force(spark, block):
    rng = random.Random(block)
    have = {p: sorted(rng.sample(range(60), 25)) for p in range(3)}
    log = classified(spark, [("t", p, o, 0.0, True) for p, found in have.items() for o in found])
    want = sorted(
        (("t", p, a, b, b - a - 1) for p, found in have.items() for a, b in zip(found, found[1:]) if b - a > 1), key=repr
    )
    assert rows(offsets.offset_gaps(log, block)) == want
    totals = rows(offsets.gap_totals(log), "partition", "n_missing")
    assert totals == [(p, f[-1] - f[0] + 1 - len(f)) for p, f in have.items()]


def test_gaps_of_a_log_with_redelivery(spark):
    """As many records as offsets, but one of them twice and one missing."""
    log = classified(spark, [("t", 0, o, 0.0, True) for o in (0, 1, 1, 3, 70, 70)])
    assert rows(offsets.offset_gaps(log)) == [("t", 0, 1, 3, 1), ("t", 0, 3, 70, 66)]


def test_dense_log_has_no_gaps(spark):
    log = spark.range(3000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).alias("offset")
    )
    assert offsets.offset_gaps(log, block=100).count() == 0
    assert offsets.offset_gaps(log.filter("offset not between 150 and 449"), block=100).count() == 3


def test_windows_go_over_words_of_a_block(spark, sf_dir):
    plan = plan_of(offsets.offset_gaps(log_of(spark, sf_dir)))
    window = plan[plan.index("Window [lead(first") :]
    assert "_block" in window[: window.index("\n")]


def test_later_calls_see_new_files(spark, tmp_path):
    path = str(tmp_path / "log")

    def add(*values):
        spark.createDataFrame([("t", 0, o) for o in values], "topic string, partition int, offset bigint").write.mode("append").parquet(path)

    def read():
        return spark.read.parquet(path)

    add(1, 5)
    assert rows(offsets.offset_gaps(read()), "offset", "next_offset") == [(1, 5)]
    start = committed(spark, (GROUP, "t", 0, 4))
    assert rows(offsets.replay_window(read(), start), "offset") == [(5,)]
    add(9, 20)
    assert rows(offsets.offset_gaps(read()), "offset", "next_offset") == [(1, 5), (5, 9), (9, 20)]
    assert set(rows(offsets.replay_window(read(), start), "offset")) == {(5,), (9,), (20,)}


def test_lag_history_has_no_grid(spark, sf_dir):
    log = log_of(spark, sf_dir)
    ledger = offsets.commit_ledger(documents.classify(log, "json", "k int"), GROUP, 86_400)
    plan = plan_of(offsets.lag_history(log, ledger, 86_400))
    spread = plan[plan.index("Generate explode(sequence") :]
    assert "[group_id" in spread[: spread.index("\n")] and "partition" not in spread[: spread.index("\n")]


def test_offsets_read_three_columns(spark, sf_dir):
    plan = plan_of(offsets.end_offsets(log_of(spark, sf_dir)))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    assert "HashAggregate" in plan and "partial_max" in plan


def test_topic_filter_reaches_the_scan(spark, tmp_path):
    empty = spark.createDataFrame([("t", 0, 1, "k", "v", None)], RECORD_LOG)
    empty.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert "PushedFilters: [In(topic, [t,u])]" in plan_of(offsets.end_offsets(log, ["t", "u"]))
