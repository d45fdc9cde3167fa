"""Gaps kept batch by batch, and drains that stand still."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from docstream.operators.offsets import gaps_between, merge_runs, offset_gaps, seen_runs, stall_count
from docstream.plans.inputs import log_of
from docstream.schema import RECORD_LOG
from docstream.sources.record_log import write_log
from docstream.streaming.control import Ingest
from docstream.streaming.ingest import batch_writer, store_of

LOG = "topic string, partition int, offset bigint"


def settings(tmp_path, source="none", **changes):
    from test_streaming import config

    return config(tmp_path, source, track_offsets=True, **changes)


def test_runs_of_any_batches_merge_to_the_gaps_of_the_log(spark):
    rng = random.Random(4)
    seen = [("a", p, o) for p in range(3) for o in range(0, 40_000, 1 + p) if rng.random() > 0.02 * p] + [("b", 0, 7)]
    log = spark.createDataFrame(seen, LOG)
    batches = [[] for _ in range(4)]
    for row in seen:
        for k in rng.sample(range(4), rng.choice([1, 1, 1, 2])):
            batches[k].append(row)
    runs = [seen_runs(spark.createDataFrame(batch, LOG)) for batch in batches]
    whole = runs[0].unionByName(runs[1]).unionByName(merge_runs(runs[2].unionByName(runs[3])))
    assert rows(gaps_between(whole), "topic", "partition", "offset", "n_missing") == rows(offset_gaps(log), "topic", "partition", "offset", "n_missing")
    assert rows(merge_runs(whole)) == rows(seen_runs(log))
    assert seen_runs(log.limit(0)).count() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_gaps_after_batches_replays_and_late_fills(spark, sf_dir, tmp_path, compacted):
    log = log_of(spark, sf_dir).select(*RECORD_LOG.fieldNames())
    own = settings(tmp_path)
    write, store = batch_writer(own), store_of(spark, own)
    late = F.col("offset").between(200, 260)
    write(log.filter((F.col("offset") < 500) & ~late), 0)
    write(log.filter(F.col("offset").between(400, 800)), 1)
    if compacted:
        store.compact()
    write(log.filter(late), 2)
    write(log.filter("offset > 800"), 3)
    if compacted:
        store.compact()
    columns = ("topic", "partition", "offset", "next_offset", "n_missing")
    assert rows(store.gaps(), *columns) == rows(offset_gaps(log), *columns)


def test_a_stuck_partition_ends_the_drain(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    log = log_of(spark, sf_dir)
    write_log(log, path)
    stream = spark.readStream.schema(RECORD_LOG).parquet(path)
    stuck = (F.col("topic") == "view") & (F.col("partition") == 3)
    job = Ingest(spark, settings(tmp_path, path, commit_interval_ms=100), stream=stream.filter(~stuck), log=log)
    job.start()
    job.drain()
    report = job.drain_watched(limit=2, poll_seconds=0.05)
    job.stop()
    assert report.reason == "stalled" and report.n_still == 3
    told = stall_count(report.history(spark), expected=0, limit=2).first()
    assert (told["n_still"], told["stalled"], told["n_polls"]) == (report.n_still, True, len(report.polls))


def test_a_drain_that_catches_up(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    write_log(log_of(spark, sf_dir), path)
    job = Ingest(spark, settings(tmp_path, path))
    assert job.drain_watched(limit=2, poll_seconds=0.05).reason == "not running"
    job.run_to_end()
    assert job.drain_watched(limit=2, poll_seconds=0.05).reason == "caught up"
