"""The ingest job end to end: counts, crashes, restarts, compaction, control."""

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from docstream.config import IngestConfig
from docstream.operators import audit
from docstream.operators.offsets import end_offsets
from docstream.operators.upsert import between_partitions, latest_by_key, merge_latest
from docstream.plans.inputs import damaged_log, log_of
from docstream.schema import RECORD_LOG, TARGETS
from docstream.session import shuffle_partitions
from docstream.sources.generators import numbers, random_documents
from docstream.sources.json_files import as_records
from docstream.sources.record_log import with_positions, write_log
from docstream.streaming import ingest, progress
from docstream.streaming.control import Ingest, lag_of_groups
from docstream.streaming.store import CollectionStore

TOPICS = ("click", "error", "purchase", "signup", "view")
DOC = "k int"


@pytest.fixture
def one_log(spark, sf_dir, tmp_path):
    """The event log in six files of increasing time."""
    path = str(tmp_path / "log")
    write_log(log_of(spark, sf_dir).repartitionByRange(6, "offset"), path)
    return path


def config(tmp_path, source, name="store", **changes):
    base = dict(
        collection=f"{tmp_path.name}-{name}",
        topics=TOPICS,
        source=source,
        store=str(tmp_path / name),
        schema=DOC,
        num_shards=4,
        buckets=4,
        max_per_trigger=2,
    )
    return IngestConfig(**{**base, **changes})


def shown(df):
    return rows(df, "key", "topic", "partition", "offset", "doc.k")


def batch_result(spark, sf_dir):
    from docstream.operators.documents import decode

    return shown(latest_by_key(decode(log_of(spark, sf_dir), "json", DOC)))


def test_empty_collection(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log))
    assert job.store.current() is None
    assert job.store.compact() is None
    assert job.store.last_batch() == -1
    assert job.state() == "NOT_INITIALIZED"
    whole = spark.read.parquet(one_log)
    assert job.status().first()["total_lag"] == end_offsets(whole).agg(F.sum("end_offset")).first()[0]
    job.stop()


def test_stream_equals_batch_in_three_batches(spark, sf_dir, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log))
    job.run_to_end()
    assert job.store.last_batch() == 2
    assert shown(job.store.current()) == batch_result(spark, sf_dir)
    assert job.lag().agg(F.max("lag")).first()[0] == 0
    assert job.state() == "STOPPED" and job.resume() is None
    metrics = progress.batch_metrics(job.store).orderBy("batch_id").collect()
    total = log_of(spark, sf_dir).count()
    assert [m["batch_id"] for m in metrics] == [0, 1, 2] and metrics[-1]["total_docs"] == total


def test_seeded_documents_are_all_found(spark, tmp_path):
    """N distinct documents sent, N found; shard counts add up; a second run adds nothing."""
    numbered = random_documents(numbers(spark, 500), 20, keep=("number",))
    docs = numbered.drop("number")
    records = as_records(numbered, "t", keep=("number",))
    placed = with_positions(records, "number", 10, F.timestamp_seconds(F.lit(0)))
    write_log(placed, str(tmp_path / "log"))
    schema = "id string, text string, doc_number int, doc_double double, some_flag boolean"
    job = Ingest(spark, config(tmp_path, str(tmp_path / "log"), topics="t", schema=schema))
    job.run_to_end()
    job.run_to_end()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert audit.seeded_vs_end(log, end_offsets(log)).first() == ("t", 500, 500, True)
    current = job.store.current()
    assert current.count() == 500
    counts = audit.shard_counts(current)
    assert audit.shard_sum_check(counts, spark.range(500).agg(F.count(F.lit(1)))).first()["agrees"]
    assert rows(current.select("doc.*")) == rows(docs)


def test_all_shards_hold_all(spark, tmp_path, sf_dir, one_log):
    job = Ingest(spark, config(tmp_path, one_log, routing="all"))
    job.run_to_end()
    n = len(batch_result(spark, sf_dir))
    assert rows(audit.shard_counts(job.store.current())) == [(s, n) for s in range(4)]
    job.store.compact()
    assert rows(audit.shard_counts(job.store.current())) == [(s, n) for s in range(4)]


STEPS = ["write_records", "write_ledger", "complete_batch"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_crash_at_every_step(spark, sf_dir, tmp_path, one_log, monkeypatch, step, after):
    """A batch that fails before or after one of its writes is repeated; the result is the same."""
    original = getattr(CollectionStore, step)
    fail = {"on": True}

    def broken(self, *args):
        batch_id = args[0] if step == "complete_batch" else args[1]
        if batch_id == 1 and fail["on"]:
            if after:
                original(self, *args)
            raise RuntimeError("executor lost")
        return original(self, *args)

    monkeypatch.setattr(CollectionStore, step, broken)
    job = Ingest(spark, config(tmp_path, one_log))
    with pytest.raises(Exception, match="executor lost"):
        job.run_to_end()
    done = 1 if (step == "complete_batch" and after) else 0
    assert job.store.last_batch() == done
    assert job.store.run_state() == "RUNNING"
    assert len(shown(job.store.current())) > 0
    fail["on"] = False
    job.run_to_end()
    assert job.store.last_batch() == 2
    assert shown(job.store.current()) == batch_result(spark, sf_dir)
    assert job.store.ledger().agg(F.sum("n_ok")).first()[0] == log_of(spark, sf_dir).count()


def test_half_written_batch_is_not_read(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log))
    job.run_to_end()
    before = shown(job.store.current())
    extra = job.store.records(1, 2).withColumn("offset", F.col("offset") + 1_000_000)
    job.store.write_records(extra.drop("batch_id"), 3)
    assert shown(job.store.current()) == before


def test_bad_records_do_not_stop_the_job(spark, sf_dir, tmp_path):
    write_log(damaged_log(spark, sf_dir), str(tmp_path / "log"))
    job = Ingest(spark, config(tmp_path, str(tmp_path / "log")))
    job.run_to_end()
    bad = job.store.quarantine()
    whole = damaged_log(spark, sf_dir).count()
    assert job.store.ledger().agg(F.sum("n_ok") + F.sum("n_bad")).first()[0] == whole
    assert bad.count() == job.store.ledger().agg(F.sum("n_bad")).first()[0] > 0
    assert {r[0] for r in bad.select("error_class").distinct().collect()} == {"decode_error", "reject_error"}


def test_only_bad_records(spark, tmp_path):
    bad = spark.createDataFrame([("click", 0, 0, "k", "[]", None)], RECORD_LOG)
    write_log(bad, str(tmp_path / "log"))
    job = Ingest(spark, config(tmp_path, str(tmp_path / "log")))
    job.run_to_end()
    assert job.store.last_batch() == 0
    assert job.store.quarantine().count() == 1
    current = job.store.current()
    assert current is None or current.count() == 0
    assert job.store.committed().count() == 0


def test_compaction_keeps_the_collection(spark, sf_dir, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, max_per_trigger=1))
    source = spark.read.schema(RECORD_LOG).parquet(one_log)
    job.run_to_end()
    assert job.store.last_batch() == 5
    want = shown(job.store.current())
    assert job.store.compact() == 0
    assert shown(job.store.current()) == want
    assert job.store.compact() == 0, "nothing new"
    late = source.withColumn("offset", F.col("offset") + 10_000_000).withColumn(
        "timestamp", F.col("timestamp") + F.expr("interval 100 days")
    )
    write_log(late.filter("topic = 'click'"), one_log)
    write_log(source.filter("topic = 'view'"), one_log)
    job.run_to_end()
    newer = shown(job.store.current())
    assert newer != want and len(newer) == len(want)
    assert job.store.compact() == 1
    assert shown(job.store.current()) == newer
    # A session that has never seen the snapshot reads it from its folder.
    generation = job.store.generation()
    spark.sql(f"DROP TABLE {job.store._table_name(1)}")
    assert shown(between_partitions(job.store.snapshot(generation))) == newer


def test_snapshot_is_not_shuffled(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, max_per_trigger=1))
    job.run_to_end()
    store = job.store
    store.compact()
    generation = store.generation()
    snapshot = store.snapshot(generation)
    changes = store.changelog(0, 2).select(*snapshot.columns)
    assert "Exchange" not in plan_of(between_partitions(snapshot))
    plan = plan_of(merge_latest(snapshot, changes, buckets=generation["buckets"]))
    over_union, below = plan.split("Union")
    assert "Exchange" not in over_union
    snapshot_branch, changes_branch = below.split("Bucketed: true")
    assert "Exchange" not in snapshot_branch and "partial_max" in changes_branch
    # The changes are shuffled twice, both times after a cut to one version per key and partition.
    with shuffle_partitions(spark, generation["buckets"]):
        plan = plan_of(merge_latest(snapshot, changes, buckets=generation["buckets"]))
    assert plan.count("Exchange") == 2


def test_transform_runs_between_decoding_and_upsert(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log), transform=lambda df: df.filter("doc.k < 50"))
    job.run_to_end()
    assert job.store.current().agg(F.max("doc.k")).first()[0] < 50
    assert job.lag().agg(F.max("lag")).first()[0] == 0


def test_variant_documents(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, format="variant", schema=None))
    job.run_to_end()
    job.store.compact()
    found = job.store.current().select(F.variant_get("doc", "$.k", "int").alias("k"))
    assert found.filter("k is null").count() == 0 and found.count() > 0


def test_start_at_latest(spark, tmp_path, one_log):
    """Only records after the first start are read; a restart goes on from there."""
    job = Ingest(spark, config(tmp_path, one_log, starting_offsets="latest"))
    job.run_to_end()
    assert job.store.ledger().count() == 0
    source = spark.read.schema(RECORD_LOG).parquet(one_log)
    write_log(source.filter("topic = 'click'").withColumn("offset", F.col("offset") + 10_000_000), one_log)
    job.run_to_end()
    n = spark.read.schema(RECORD_LOG).parquet(one_log).filter("offset >= 10000000").count()
    assert job.store.ledger().agg(F.sum("n_ok")).first()[0] == n > 0


def test_continuous_run_stop_and_resume(spark, sf_dir, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, commit_interval_ms=100))
    assert job.act("nonsense") == {"message": "Unknown command provided"}
    assert job.act() == {"message": "started", "running": True}
    assert job.start().id == job.query().id
    job.drain()
    status = job.act()
    assert status["status"] == "RUNNING" and status["should_run"] and status["total_lag"] == 0
    assert set(status["consumer_group_lag"].values()) == {0}
    assert progress.batch_metrics(job.store).agg(F.sum("n_docs")).first()[0] == log_of(spark, sf_dir).count()
    assert job.act("STOP") == {"message": "stopping", "running": False}
    assert job.state() == "STOPPED"
    assert job.resume() is None
    assert job.act()["running"]
    job.query().stop()
    assert job.resume().isActive
    job.act("stop")
    job.act("stop")
    assert shown(job.store.current()) == batch_result(spark, sf_dir)


def test_one_round_late_view(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log))
    job.run_to_end()
    def newest(ledger):
        return rows(ledger.groupBy("group_id", "topic", "partition").agg(F.max("next_offset")))

    ledger = job.store.ledger()
    assert rows(job.store.committed()) == newest(ledger)
    assert rows(job.store.committed(rounds_late=1)) == newest(ledger.filter("batch_id < 2"))
    assert job.store.committed(rounds_late=3).count() == 0


def test_mode_is_checked_before_the_start(spark, tmp_path, one_log):
    settings = config(tmp_path, one_log, routing="all", core="core1")
    targets = spark.createDataFrame(
        [(settings.collection, 0, "core1", "PULL", "active", False, 0), (settings.collection, 0, "core2", "TLOG", "active", True, 0)],
        TARGETS,
    )
    job = Ingest(spark, settings, targets)
    with pytest.raises(ValueError, match="TLOG"):
        job.act("start")
    assert job.query() is None and job.state() == "NOT_INITIALIZED"
    allowed = Ingest(spark, settings, targets.filter("replica_type <> 'TLOG'"))
    status = allowed.status().first()
    assert (status["current_core"], status["leader"], status["eligible"]) == ("core1", False, False)


def test_fields_declared_later_are_kept(spark, tmp_path):
    """Two runs with different declared fields, before and after a compaction."""
    source = str(tmp_path / "log")

    def send(offset, value):
        record = [("t", 0, offset, f"k{offset}", value, offset)]
        log = spark.createDataFrame(record, "topic string, partition int, offset bigint, key string, value string, ts bigint")
        write_log(log.select("topic", "partition", "offset", "key", "value", F.timestamp_seconds("ts").alias("timestamp")), source)

    def run(schema):
        job = Ingest(spark, config(tmp_path, source, topics="t", schema=schema, num_shards=1, buckets=1))
        job.run_to_end()
        return job.store

    send(0, '{"k": 1}')
    store = run("k int")
    for offset, compact in ((1, False), (2, True), (3, True)):
        if compact:
            store.compact()
        send(offset, f'{{"k": {offset}, "z": {10 * offset}, "y{offset}": "v"}}')
        store = run(f"k int, z int, y{offset} string")
        found = {r["key"]: r["doc"].asDict() for r in store.current().collect()}
        assert found["k0"]["k"] == 1 and found["k0"]["z"] is None
        for seen in range(1, offset + 1):
            assert found[f"k{seen}"]["z"] == 10 * seen and found[f"k{seen}"][f"y{seen}"] == "v"
    store.compact()
    assert {r["key"]: r["doc"].asDict() for r in store.current().collect()} == found
    with pytest.raises(ValueError, match="stored as"):
        run("k string")


def test_documents_go_by_their_id(spark, tmp_path):
    source = str(tmp_path / "log")
    data = [("x", '{"id": "a"}'), ("x", '{"id": "b"}'), (None, '{"id": "a"}'), (None, '{"id": null}'), ("c", "{}"), (None, "{}")]
    numbered = [("t", 0, i, k, v, i) for i, (k, v) in enumerate(data)]
    log = spark.createDataFrame(numbered, "topic string, partition int, offset bigint, key string, value string, ts bigint")
    write_log(log.select("topic", "partition", "offset", "key", "value", F.timestamp_seconds("ts").alias("timestamp")), source)
    job = Ingest(spark, config(tmp_path, source, topics="t", schema="id string", id_field="id"))
    job.run_to_end()
    assert rows(job.store.current(), "key", "offset") == [("a", 2), ("b", 1), ("c", 4)]
    assert rows(job.store.quarantine(), "offset", "error_class") == [(3, "reject_error"), (5, "reject_error")]
    keyed = Ingest(spark, config(tmp_path, source, "keyed", topics="t", schema="id string"))
    keyed.run_to_end()
    assert rows(keyed.store.current(), "key", "offset") == [("c", 4), ("x", 1)]
    assert keyed.store.quarantine().count() == 3


def test_readers_open_only_later_batches(spark, tmp_path, one_log, monkeypatch):
    job = Ingest(spark, config(tmp_path, one_log, max_per_trigger=1))
    job.run_to_end()
    store = job.store
    before = rows(store.committed()), rows(store.ledger().drop("batch_id"))
    store.compact()
    opened = []
    paths = store._batch_paths
    monkeypatch.setattr(store, "_batch_paths", lambda *a: opened.append(paths(*a)) or paths(*a))
    assert (rows(store.committed()), rows(store.ledger().drop("batch_id"))) == before
    assert store.quarantine().count() == 0 and store.last_batch() == 5
    assert not any(opened)


def test_lag_before_the_first_commit(spark, tmp_path, one_log, sf_dir):
    job = Ingest(spark, config(tmp_path, one_log), log=log_of(spark, sf_dir))
    status = job.status().first()
    ends = end_offsets(log_of(spark, sf_dir)).agg(F.sum("end_offset")).first()[0]
    assert status["total_lag"] == ends > 0
    other = Ingest(spark, config(tmp_path, one_log, "other"), log=log_of(spark, sf_dir))
    both = lag_of_groups([job, other]).groupBy("group_id").agg(F.sum("lag").alias("lag"))
    assert both.count() == 2 and {r["lag"] for r in both.collect()} == {ends}


def test_a_batch_is_written_in_one_pass(spark, tmp_path, one_log):
    """No shuffle: as many files as tasks read the source."""
    job = Ingest(spark, config(tmp_path, one_log, max_per_trigger=100))
    job.run_to_end()
    files = list((tmp_path / "store" / "records" / "batch_id=0").glob("accepted=true/*.parquet"))
    assert len(files) <= 6


@pytest.mark.parametrize("routing", ["hash", "all"])
def test_shards_as_folders(spark, sf_dir, tmp_path, one_log, routing):
    job = Ingest(spark, config(tmp_path, one_log, routing=routing))
    job.run_to_end()
    job.store.write_shards(str(tmp_path / "shards"))
    n = len(batch_result(spark, sf_dir))
    counts = dict(rows(audit.shard_counts(spark.read.parquet(str(tmp_path / "shards")))))
    assert set(counts) == {0, 1, 2, 3}
    assert sum(counts.values()) == (n if routing == "hash" else 4 * n)


def test_every_bucket_has_one_shard_and_one_file(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, buckets=8))
    job.run_to_end()
    job.store.compact()
    files = list((tmp_path / "store" / "snapshot" / "gen=0").glob("*.parquet"))
    assert len(files) <= 8
    by_file = (
        spark.read.parquet(str(tmp_path / "store" / "snapshot" / "gen=0"))
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.count_distinct("shard_id").alias("n"))
    )
    assert {r["n"] for r in by_file.collect()} == {1}


def test_buckets_change_only_when_told(spark, tmp_path, one_log):
    job = Ingest(spark, config(tmp_path, one_log, buckets=None))
    job.run_to_end()
    want = shown(job.store.current())
    job.store.compact()
    assert job.store.generation()["buckets"] == 4
    assert shown(job.store.current()) == want
    source = spark.read.schema(RECORD_LOG).parquet(one_log)
    write_log(source.filter("topic = 'view'"), one_log)
    job.run_to_end()
    job.store.compact()
    assert job.store.generation()["buckets"] == 4
    job.store.compact(buckets=16)
    assert job.store.generation()["buckets"] == 16
    assert shown(job.store.current()) == want


def test_log_by_topic_is_pruned(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    write_log(log_of(spark, sf_dir), path, by_topic=True)
    settings = config(tmp_path, path, topics="view", max_per_trigger=100)
    from docstream.sources.record_log import read_log

    assert read_log(spark, settings).schema == RECORD_LOG
    plan = plan_of(read_log(spark, settings).select("offset"))
    assert "= view)], PushedFilters: [], ReadSchema: struct<offset:bigint>" in plan
    job = Ingest(spark, settings)
    job.run_to_end()
    views = log_of(spark, sf_dir).filter("topic = 'view'")
    assert job.store.ledger().agg(F.sum("n_ok")).first()[0] == views.count()


def test_ends_out_of_a_progress_report(spark):
    from docstream.streaming.control import reported_ends

    found = reported_ends(spark, '{"a":{"0":5,"1":7},"b":{"0":9}}')
    assert rows(found) == [("a", 0, 5), ("a", 1, 7), ("b", 0, 9)]
    assert dict(found.dtypes)["partition"] == "int"


def test_kafka_tail_starts_at_the_committed_offsets(spark):
    import json

    from docstream.sources.record_log import starting_positions

    committed = spark.createDataFrame(
        [("g1", "a", 0, 5), ("g1", "a", 1, 7), ("g2", "a", 0, 3), ("g1", "b", 0, 9)],
        "group_id string, topic string, partition int, committed_offset bigint",
    )
    assert json.loads(starting_positions(committed)) == {"a": {"0": 3, "1": 7}, "b": {"0": 9}}


def test_rate_log(spark, tmp_path, one_log):
    lines = []
    listener = progress.RateLog(lines.append)
    spark.streams.addListener(listener)
    try:
        Ingest(spark, config(tmp_path, one_log)).run_to_end()
        import time

        deadline = time.time() + 20
        while time.time() < deadline and not any("stopped" in line for line in lines):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert any("batch 0" in line for line in lines)
