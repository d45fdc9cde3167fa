"""Zone maps: which files a replay opens, and ends without reading the log."""

import os

from helpers import rows
from pyspark.sql import functions as F

from docstream.operators.offsets import end_offsets, replay_window
from docstream.plans.inputs import log_of
from docstream.schema import RECORD_LOG
from docstream.sources.record_log import write_log
from docstream.sources.zone_map import ZoneMap
from docstream.streaming.control import Ingest

COMMITTED = "topic string, partition int, committed_offset bigint"


def committed(spark, log, part=0.8):
    ends = end_offsets(log).collect()
    return spark.createDataFrame([(r["topic"], r["partition"], int(r["end_offset"] * part)) for r in ends], COMMITTED)


def test_replay_opens_the_tail_only(spark, sf_dir, tmp_path):
    log, path = log_of(spark, sf_dir), str(tmp_path / "log")
    write_log(log.repartitionByRange(10, "offset"), path)
    zones = ZoneMap(spark, path, str(tmp_path / "zones")).extend()
    start = committed(spark, log)
    n_files = sum(f.endswith(".parquet") for f in os.listdir(path))
    assert 0 < len(zones.tail_files(start)) <= n_files / 2
    assert len(zones.replay(start).inputFiles()) == len(zones.tail_files(start))
    assert rows(zones.replay(start)) == rows(replay_window(log.select(*RECORD_LOG.fieldNames()), start))
    assert rows(zones.end_offsets()) == rows(end_offsets(log))
    assert rows(zones.end_offsets(["view"])) == rows(end_offsets(log, ["view"]))
    past = start.withColumn("committed_offset", F.lit(10**9).cast("bigint"))
    assert zones.tail_files(past) == [] and zones.replay(past).count() == 0


def test_only_new_files_are_read(spark, sf_dir, tmp_path):
    log, path = log_of(spark, sf_dir).cache(), str(tmp_path / "log")
    zones = ZoneMap(spark, path, str(tmp_path / "zones"))
    half = log.agg(F.max("offset")).first()[0] // 2
    write_log(log.filter(F.col("offset") < half), path, by_topic=True)
    zones.extend()
    before = zones.kept().count()
    zones.extend()
    assert zones.kept().count() == before
    opened = []
    read = zones.read
    zones.read = lambda paths: opened.extend(paths) or read(paths)
    # The next files overlap the first ones, and one of them is empty.
    write_log(log.filter(F.col("offset") >= half - 20), path, by_topic=True)
    log.limit(0).select("partition", "offset", "key", "value", "timestamp").write.mode("append").parquet(path + "/topic=view")
    zones.extend()
    old = {r["file"] for r in spark.read.parquet(zones.path).limit(before).select("file").collect()}
    assert opened and not old & set(opened)
    start = committed(spark, log, 0.45)
    twice = log.filter((F.col("offset") < half) & (F.col("offset") >= half - 20))
    expected = replay_window(log.unionByName(twice), start)
    assert rows(zones.replay(start), "topic", "partition", "offset", "value") == rows(expected, "topic", "partition", "offset", "value")
    # Files that are gone don't count; a partition without a commit starts over.
    for folder, _, names in os.walk(path):
        if "topic=view" in folder:
            for name in names:
                os.remove(os.path.join(folder, name))
    assert not zones.end_offsets().filter("topic = 'view'").count()
    some = start.filter("topic <> 'click'")
    assert zones.replay(some).filter("topic = 'click'").count() == log.unionByName(twice).filter("topic = 'click'").count()
    log.unpersist()


def test_lag_and_replay_of_a_job(spark, sf_dir, tmp_path):
    from test_streaming import config

    log, path = log_of(spark, sf_dir), str(tmp_path / "log")
    write_log(log.repartitionByRange(6, "offset"), path)
    job = Ingest(spark, config(tmp_path, path))
    assert job.replay().count() == log.count()
    assert rows(job.lag(), "topic", "partition", "lag") == rows(end_offsets(log).withColumnRenamed("end_offset", "lag"), "topic", "partition", "lag")
    job.run_to_end()
    assert job.replay().count() == 0
    assert job.lag().filter("lag <> 0").count() == 0
