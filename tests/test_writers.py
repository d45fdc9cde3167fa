"""What a batch observes of itself, and writers that are fenced off."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from docstream.plans.inputs import damaged_log
from docstream.schema import RECORD_LOG
from docstream.sources.record_log import write_log
from docstream.streaming import ingest
from docstream.streaming.control import Ingest
from docstream.streaming.ingest import batch_offsets, batch_writer, store_of
from docstream.streaming.store import FencedError


def settings(tmp_path, source="none", **changes):
    from test_streaming import config

    return config(tmp_path, source, **changes)


@pytest.mark.parametrize("limit", [64, 0])
def test_observed_commits_equal_those_read(spark, sf_dir, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(ingest, "OBSERVED_PARTITIONS", limit)
    told = []
    commits = ingest.BatchMetrics.commits
    monkeypatch.setattr(ingest.BatchMetrics, "commits", lambda self: told.append(commits(self)) or told[-1])
    log = damaged_log(spark, sf_dir).select(*RECORD_LOG.fieldNames())
    own = settings(tmp_path)
    write = batch_writer(own)
    edges = [0, 300, 600, 10**9]
    for k in range(3):
        write(log.filter((F.col("offset") >= edges[k]) & (F.col("offset") < edges[k + 1])), k)
    write(log.limit(0), 3)
    # The first batch brings new partitions; later ones are told by their observation.
    assert [x is not None for x in told] == [False, bool(limit), bool(limit), True]
    store = store_of(spark, own)
    for k in range(3):
        read = batch_offsets(store.records(k - 1, k).drop("batch_id"), own)
        found = store.ledger().filter(F.col("batch_id") == k)
        assert rows(found, *read.columns) == rows(read)
    assert store.ledger().filter("batch_id = 3").count() == 0
    assert store.batches().agg(F.sum("n_ok") + F.sum("n_bad")).first()[0] == log.count()


@pytest.mark.parametrize("transform", [None, lambda df: df.filter("doc.k % 2 = 0")])
def test_the_source_is_scanned_once(spark, sf_dir, tmp_path, transform):
    log, path = damaged_log(spark, sf_dir), str(tmp_path / "log")
    write_log(log.repartitionByRange(4, "offset"), path)
    own = settings(tmp_path, path, available_now=True)
    query = ingest.start_query(spark, own, transform)
    query.awaitTermination()
    n = log.count()
    assert sum(p.numInputRows for p in query.recentProgress) == n
    counts = store_of(spark, own).batches().agg(F.sum("n_ok"), F.sum("n_bad")).first()
    # A record that the transform drops is done with all the same.
    assert counts[0] + counts[1] == n
    if transform:
        assert 0 < store_of(spark, own).changelog().count() < counts[0]


def test_older_writers_are_refused(spark, sf_dir, tmp_path):
    log = damaged_log(spark, sf_dir).select(*RECORD_LOG.fieldNames())
    own = settings(tmp_path)
    store = store_of(spark, own)
    parts = [log.filter(F.col("offset") < 300), log.filter(F.col("offset") >= 300)]
    older = batch_writer(own, epoch=store.claim_epoch())
    older(parts[0], 0)
    other = store_of(spark.newSession(), own)
    newer = batch_writer(own, epoch=other.claim_epoch())
    with pytest.raises(FencedError):
        older(parts[1], 1)
    assert store.last_batch() == 0
    newer(parts[1], 1)
    assert store.batches().agg(F.sum("n_ok") + F.sum("n_bad")).first()[0] == log.count()
    assert store.claim_epoch() == 3


def test_a_batch_that_loses_its_epoch_half_way_stays_incomplete(spark, sf_dir, tmp_path, monkeypatch):
    log = damaged_log(spark, sf_dir).select(*RECORD_LOG.fieldNames()).limit(50)
    own = settings(tmp_path)
    store = store_of(spark, own)
    older = batch_writer(own, epoch=store.claim_epoch())
    write_ledger = type(store).write_ledger
    monkeypatch.setattr(type(store), "write_ledger", lambda self, *a: (write_ledger(self, *a), store.claim_epoch()))
    with pytest.raises(FencedError):
        older(log, 0)
    assert store.last_batch() == -1


def test_every_start_has_an_epoch(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    write_log(damaged_log(spark, sf_dir), path)
    job = Ingest(spark, settings(tmp_path, path))
    job.run_to_end()
    job.run_to_end()
    assert job.store._epochs() and max(job.store._epochs()) == 2
