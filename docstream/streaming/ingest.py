"""The ingest job: record log -> documents -> collection (ST1-ST4, S11, S12)."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from docstream.config import IngestConfig
from docstream.functions.names import group_name
from docstream.operators.documents import accepted, classify, identify, is_accepted
from docstream.operators.offsets import POSITION, in_topics, seen_runs
from docstream.operators.routing import assign_shard
from docstream.sources.record_log import stream_log
from docstream.streaming.store import CollectionStore

Transform = Callable[[DataFrame], DataFrame]
# Partitions whose offsets and counts a write observes; of more, what was written is read again.
OBSERVED_PARTITIONS = 64


def store_of(spark: SparkSession, config: IngestConfig) -> CollectionStore:
    return CollectionStore(
        spark, config.store, config.buckets, config.all_shards, config.num_shards
    )


COMMITS = "topic string, partition int, next_offset bigint, n_ok bigint, n_bad bigint"


def _commit_columns(here: Column | bool = True) -> list[Column]:
    """Next offset, accepted records and others, of the rows that are ``here``."""
    ok, bad = F.col("accepted") & here, ~F.col("accepted") & here
    next_offset = F.max(F.when(ok, F.col("offset"))) + 1
    return [next_offset.alias("next_offset"), F.count_if(ok).alias("n_ok"), F.count_if(bad).alias("n_bad")]


def _of_group(commits: DataFrame, config: IngestConfig) -> DataFrame:
    core = F.lit(config.core) if config.core else None
    group = group_name(F.lit(config.collection), core, config.all_shards)
    return commits.select(group.alias("group_id"), *[part.split()[0] for part in COMMITS.split(", ")])


def batch_offsets(records: DataFrame, config: IngestConfig) -> DataFrame:
    """What one batch commits per (topic, partition)."""
    return _of_group(records.groupBy(*POSITION).agg(*_commit_columns()), config)


class BatchMetrics:
    """What a batch commits, observed while it is written.

    ``known`` are the partitions seen in earlier batches of this run. A batch with a record of
    another one, or a log of more than ``OBSERVED_PARTITIONS``, isn't told by its observation.
    """

    def __init__(self, known: list[tuple[str, int]]) -> None:
        self.known = known if len(known) <= OBSERVED_PARTITIONS else []
        self.observation = Observation()

    def observe(self, rows: DataFrame) -> DataFrame:
        told = [F.count(F.lit(1)).alias("n")]
        for k, (topic, partition) in enumerate(self.known):
            here = F.col("topic").eqNullSafe(F.lit(topic)) & F.col("partition").eqNullSafe(F.lit(partition))
            told += [column.alias(f"{name}_{k}") for column, name in zip(_commit_columns(here), ("next", "ok", "bad"), strict=True)]
        return rows.observe(self.observation, *told)

    def commits(self) -> list[tuple] | None:
        """(topic, partition, next offset, accepted, others) of the batch, once it is written; None if not all are known."""
        found = self.observation.get
        rows = [(*place, found.get(f"next_{k}"), found.get(f"ok_{k}", 0), found.get(f"bad_{k}", 0)) for k, place in enumerate(self.known)]
        rows = [row for row in rows if row[3] + row[4]]
        return rows if sum(row[3] + row[4] for row in rows) == found.get("n", 0) else None


def batch_writer(config: IngestConfig, transform: Transform | None = None, epoch: int | None = None):
    """The function that applies one micro-batch to the collection.

    Records are read, parsed and written once, task by task, without a shuffle. The commit record is
    observed on that write; where a partition is new, it is made from four columns of what was
    written. A transform may drop records, so there the judged records are kept on the executors'
    disks for the length of the batch, and written and counted from there: the source is scanned
    once. Both parts are keyed by the batch number and replace what an earlier attempt left; the
    completion mark comes last. A batch of an older ``epoch`` than the newest is refused, before it
    writes and before it is complete; what it wrote in between are the rows of the same batch.
    """
    known: list[tuple[str, int]] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        store = store_of(batch.sparkSession, config)
        if epoch is not None:
            store.check_epoch(epoch)
        judged = identify(classify(batch, config.format, config.schema), config.id_field)
        judged = judged.withColumn("accepted", is_accepted())
        if transform is not None:
            judged = judged.persist(StorageLevel.DISK_ONLY)
        try:
            apply(judged, store, batch_id)
        finally:
            if transform is not None:
                judged.unpersist()

    def apply(judged: DataFrame, store: CollectionStore, batch_id: int) -> None:
        started_ms = int(time.time() * 1000)
        # The text is kept only where it has no document.
        rows = judged.withColumn("value", F.when(~F.col("accepted"), F.col("value")))
        if transform is not None:
            rows = transformed(rows, transform)
        if not config.all_shards:
            rows = assign_shard(rows, config.num_shards)
        columns = rows.drop("accepted").schema
        metrics = BatchMetrics(known)
        store.write_records(rows if transform is not None else metrics.observe(rows), batch_id)
        commits = None if transform is not None else metrics.commits()
        if commits is not None:
            found = _of_group(judged.sparkSession.createDataFrame(commits, COMMITS), config)
        elif transform is not None:
            # A transform may drop records; their offsets are done with all the same.
            found = batch_offsets(judged, config)
        else:
            written = store.records(batch_id - 1, batch_id, columns)
            found = batch_offsets(judged if written is None else written, config)
        store.write_ledger(found, batch_id)
        if config.track_offsets:
            written = None if transform is not None else store.records(batch_id - 1, batch_id, columns)
            store.write_seen(seen_runs((judged if written is None else written).select(*POSITION, "offset")), batch_id)
        if commits is None and transform is None:
            seen = store.batch_positions(batch_id)
            known.extend(sorted(set(seen) - set(known), key=repr))
        if epoch is not None:
            store.check_epoch(epoch)
        store.complete_batch(batch_id, started_ms, columns)

    return write


def transformed(rows: DataFrame, transform: Transform) -> DataFrame:
    """Accepted documents changed by the user's step; records set aside pass by."""
    changed = transform(accepted(rows).drop("value", "accepted"))
    return changed.withColumn("accepted", F.lit(True)).unionByName(
        rows.filter(~F.col("accepted")), allowMissingColumns=True
    )


def start_query(
    spark: SparkSession,
    config: IngestConfig,
    transform: Transform | None = None,
    stream: DataFrame | None = None,
    epoch: int | None = None,
) -> StreamingQuery:
    """Start or resume the job from its checkpoint (ST1, ST2, ST6).

    ``stream`` stands in for the configured source when the records come from elsewhere.
    """
    records = stream_log(spark, config) if stream is None else stream.filter(in_topics(config.topics))
    if transform is None:
        store_of(spark, config).check_schema(classify(records, config.format, config.schema).schema["doc"].dataType)
    writer = (
        records.writeStream.queryName(config.collection)
        .option("checkpointLocation", config.checkpoint)
        .foreachBatch(batch_writer(config, transform, epoch))
    )
    if config.available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{config.commit_interval_ms} milliseconds").start()


def drain(query: StreamingQuery) -> None:
    """Work off everything the source holds (ST7)."""
    query.processAllAvailable()
