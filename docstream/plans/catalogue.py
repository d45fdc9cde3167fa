"""Registered queries: each reads the analytics tables and returns one DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstream.config import IngestConfig
from docstream.functions.names import base64_text, date_text, group_name
from docstream.operators import audit, documents, metrics, offsets, routing, upsert
from docstream.plans.inputs import (
    EVENT_DOC,
    LOG_PARTITIONS,
    damaged_log,
    damaged_value,
    document_log,
    envelope_log,
    envelope_value,
    event_log,
    gapped_key,
    log_of,
    lost_copy,
    shifted_log,
    shifted_time,
    stream_events,
    table,
    targets_of,
)
from docstream.session import scratch_dir
from docstream.sources.generators import random_documents, sample_documents
from docstream.sources.json_files import as_records, read_documents, write_documents
from docstream.sources.record_log import with_positions, write_log
from docstream.sources.zone_map import ZoneMap
from docstream.streaming.control import Ingest, ingest_status

Query = Callable[[SparkSession, str], DataFrame]

COLLECTION = "events"
SHARDS = 4
DAY = 86_400
# The moment lag is reported for and a crash is assumed at.
MOMENT = "2024-01-20 00:00:00"
ENVELOPE_DOC = "id string, event_type string, amount double"

_REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    _REGISTERED[query.__name__] = query
    return query


def queries() -> dict[str, Query]:
    return dict(_REGISTERED)


# Shared steps ----------------------------------------------------------------------------------


def _moment():
    return F.lit(MOMENT).cast("timestamp")


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.decode(log_of(spark, sf_dir), "json", EVENT_DOC)


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.latest_by_key(_decoded(spark, sf_dir))


def _shown(current: DataFrame) -> DataFrame:
    return current.select(
        "key",
        "topic",
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("doc.k").alias("k"),
    )


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = documents.classify(log_of(spark, sf_dir), "json", EVENT_DOC)
    return offsets.commit_ledger(classified, group_name(F.lit(COLLECTION)), DAY)


def _committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.committed_as_of(_ledger(spark, sf_dir), _moment())


def _lag(spark: SparkSession, sf_dir: str, include_uncommitted: bool = False) -> DataFrame:
    ends = offsets.end_offsets(log_of(spark, sf_dir).filter(F.col("timestamp") < _moment()))
    return offsets.lag_report(
        _committed(spark, sf_dir), ends, include_uncommitted=include_uncommitted
    )


def _keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct document keys: all that counting documents needs of them."""
    return _decoded(spark, sf_dir).select("key").distinct()


# Current documents -----------------------------------------------------------------------------


@registered
def current_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of every document."""
    return _shown(_current(spark, sf_dir))


@registered
def current_docs_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 with clocks that run backwards: within a partition the offset decides, not the time."""
    log = documents.decode(shifted_log(spark, sf_dir), "json", EVENT_DOC)
    return _shown(upsert.latest_by_key(log))


@registered
def current_docs_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 by document id: from the document, else the record key; records with neither are left out."""
    log = envelope_log(spark, sf_dir, with_gaps=True)
    found = documents.identify(documents.classify(log, "json", ENVELOPE_DOC), "id")
    current = upsert.latest_by_key(documents.accepted(found).drop("value"))
    return current.select("key", "topic", "partition", "offset", F.col("doc.amount").alias("amount"))


@registered
def current_docs_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 by ranking with a partial limit per task."""
    return _shown(upsert.latest_by_key(_decoded(spark, sf_dir), strategy="group_limit"))


@registered
def current_docs_per_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 within each topic."""
    return _shown(upsert.latest_by_key(_decoded(spark, sf_dir), ("topic", "key")))


@registered
def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read again after a crash change nothing."""
    log = _decoded(spark, sf_dir)
    again = offsets.replay_window(log, _committed(spark, sf_dir))
    return _shown(upsert.latest_by_key(upsert.union_logs(log, again)))


@registered
def upsert_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot up to a moment merged with the changes since."""
    log = _decoded(spark, sf_dir)
    snapshot = upsert.latest_per_partition(log.filter(F.col("timestamp") < _moment()))
    merged = upsert.merge_latest(snapshot, log.filter(F.col("timestamp") >= _moment()))
    return _shown(upsert.between_partitions(merged))


@registered
def upsert_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 with P6, P7: bad records are passed over, the version before them stays current."""
    return _shown(
        upsert.latest_by_key(documents.decode(damaged_log(spark, sf_dir), "json", EVENT_DOC))
    )


@registered
def doc_upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 on wide rows: newest document per language and source, with its whole text."""
    docs = table(spark, sf_dir, "documents").withColumn("key", F.concat_ws(":", "lang", "source"))
    return upsert.latest_by_key(docs, ("key",), ("doc_id",)).select(
        "key", "doc_id", "lang", "source", "n_chars", "text"
    )


@registered
def conversation_latest_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last turn of every conversation."""
    turns = table(spark, sf_dir, "conversations")
    return upsert.latest_by_key(turns, ("conv_id",), ("turn",)).select(
        "conv_id", "turn", "role", "text"
    )


@registered
def page_latest_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest page per host, with its whole HTML."""
    # A URL without a host stands for itself.
    found = F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1)
    host = F.when(found != "", found).otherwise(F.col("url"))
    pages = table(spark, sf_dir, "pages").withColumn("host", host)
    return upsert.latest_by_key(pages, ("host",), ("page_id",)).select(
        "host", "page_id", "url", "html"
    )


@registered
def key_partition_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: keys without an order of arrival, for a log by key and one dealt round."""
    events = table(spark, sf_dir, "events")
    dealt = event_log(events, partition=F.pmod(F.col("event_id"), F.lit(LOG_PARTITIONS)))

    def summary(log: DataFrame, name: str) -> DataFrame:
        return upsert.key_partition_violations(log).select(F.lit(name).alias("log"), "*")

    return summary(event_log(events), "by_key").unionByName(summary(dealt, "dealt"))


# Documents -------------------------------------------------------------------------------------


@registered
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every event document as a column."""
    decoded = documents.decode(envelope_log(spark, sf_dir), "json", ENVELOPE_DOC)
    return documents.normalise(decoded, ENVELOPE_DOC).select(
        "topic", "partition", "offset", "key", "id", "event_type", "amount"
    )


@registered
def decode_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields read from documents of undeclared schema."""
    decoded = documents.decode(envelope_log(spark, sf_dir), "variant")
    return decoded.select(
        "offset",
        F.variant_get("doc", "$.id", "string").alias("id"),
        F.variant_get("doc", "$.event_type", "string").alias("event_type"),
        F.variant_get("doc", "$.amount", "double").alias("amount"),
    )


@registered
def decode_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values kept as they are; only missing ones are set aside."""
    return documents.decode(damaged_log(spark, sf_dir), "raw").select(
        "offset", "key", F.col("doc.text").alias("text")
    )


@registered
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rendered as JSON records and decoded again."""
    docs = table(spark, sf_dir, "documents")
    records = documents.encode_documents(docs, "docs", "doc_id", docs.columns)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    decoded = documents.decode(records, "json", schema)
    return documents.normalise(decoded, schema).select("key", "doc_id", "text", "lang", "source", "n_chars")


@registered
def decode_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per outcome in a log with bad values."""
    return documents.failure_counts(
        documents.classify(damaged_log(spark, sf_dir), "json", EVENT_DOC)
    )


@registered
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records set aside, untouched."""
    bad = documents.rejected(documents.classify(damaged_log(spark, sf_dir), "json", EVENT_DOC))
    return bad.select("topic", "partition", "offset", "key", "value", "error_class", "error_detail")


@registered
def flatten_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: one row per document field; what reads as a number is shown as one."""
    number = F.col("field_value").try_cast("double")
    return documents.flatten_fields(envelope_log(spark, sf_dir), "offset").select(
        "offset",
        "field",
        F.when(number.isNull(), F.col("field_value")).alias("text"),
        number.alias("number"),
    )


@registered
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and their JSON types over two kinds of documents."""
    both = upsert.union_logs(document_log(spark, sf_dir), envelope_log(spark, sf_dir))
    return documents.field_profile(both)


@registered
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One merged type per field over two kinds of documents."""
    both = upsert.union_logs(document_log(spark, sf_dir), envelope_log(spark, sf_dir))
    return documents.inferred_fields(both)


@registered
def key_id_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose key is not their document's id."""
    decoded = documents.decode(envelope_log(spark, sf_dir), "json", ENVELOPE_DOC)
    return documents.key_mismatches(decoded).select("topic", "partition", "offset", "key", "doc_id")


@registered
def base64_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in base64."""
    return table(spark, sf_dir, "documents").select("doc_id", base64_text(F.col("text")).alias("encoded"))


@registered
def event_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as date text."""
    return table(spark, sf_dir, "events").select(
        "event_id", date_text(F.col("ts").cast("timestamp")).alias("date")
    )


# Routing and audits ----------------------------------------------------------------------------


@registered
def shard_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per shard."""
    return audit.shard_counts(
        routing.assign_shard(_keys_only(spark, sf_dir), SHARDS, method="md5")
    )


def _stored(spark: SparkSession, sf_dir: str, routing_: str) -> tuple[DataFrame, DataFrame]:
    """The collection after a streaming run, and its documents as stored in a folder per shard."""
    job = _ingest(spark, sf_dir, num_shards=SHARDS, routing=routing_)
    path = scratch_dir(spark, "shards")
    job.store.write_shards(path)
    return job.store.current(), spark.read.parquet(path)


@registered
def shard_sum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents counted in the stored shards add up to those of the collection."""
    current, stored = _stored(spark, sf_dir, "hash")
    return audit.shard_sum_check(audit.shard_counts(stored), audit.doc_count(current))


@registered
def fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per shard when every shard gets all."""
    return audit.shard_counts(routing.every_shard(_keys_only(spark, sf_dir), SHARDS))


@registered
def fanout_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current documents on every shard."""
    return _shown(_current(spark, sf_dir)).transform(lambda d: routing.every_shard(d, SHARDS))


def _collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document keys with their collection."""
    return _keys_only(spark, sf_dir).withColumn(
        "collection", F.concat(F.lit("c"), F.pmod(F.col("key").cast("bigint"), F.lit(2)).cast("string"))
    )


def _cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.eligible_targets(targets_of(spark, sf_dir), all_shards=True).select(
        "collection", "shard_id", "core"
    )


@registered
def fanout_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document on every eligible core of its own collection."""
    return routing.fan_out(_collections(spark, sf_dir), _cores(spark, sf_dir))


@registered
def fanout_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per eligible core in all-shard mode."""
    return routing.fan_out_counts(_collections(spark, sf_dir), _cores(spark, sf_dir)).select(
        "collection", "shard_id", "core", "n_docs"
    )


@registered
def shard_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored shard must hold every document; the copy in shard 2 has lost some."""
    current, stored = _stored(spark, sf_dir, "all")
    damaged = stored.filter(~lost_copy())
    return audit.shard_count_check(audit.shard_counts(damaged), audit.doc_count(current))


@registered
def eligible_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that read the log in all-shard mode."""
    return routing.eligible_targets(targets_of(spark, sf_dir), all_shards=True)


@registered
def mode_precondition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections that may run in all-shard mode."""
    return routing.mode_report(targets_of(spark, sf_dir))


@registered
def inactive_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicas of one collection that are not active."""
    return audit.inactive_targets(audit.of_collection(targets_of(spark, sf_dir), "c0")).select(
        "collection", "shard_id", "core", "state"
    )


def _mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored copies of every shard, one of them damaged, counted and compared."""
    _, stored = _stored(spark, sf_dir, "hash")
    copies = routing.assign_shard(stored.select("key"), SHARDS, method="md5").select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("core"))
    kept = copies.filter(~(lost_copy() & (F.col("core") == "b")))
    found = kept.groupBy("shard_id", "core").agg(F.count(F.lit(1)).alias("num_docs"))
    # A copy that has lost everything counts as empty.
    counts = copies.select("shard_id", "core").distinct().join(found, ["shard_id", "core"], "left").fillna(0)
    return audit.replica_mismatches(counts.withColumn("collection", F.lit(COLLECTION)))


@registered
def replica_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards whose stored copies differ."""
    return _mismatches(spark, sf_dir)


@registered
def error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per shard that differs."""
    return audit.error_report(_mismatches(spark, sf_dir))


@registered
def doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, L1: number of documents."""
    return audit.doc_count(_decoded(spark, sf_dir))


@registered
def seeded_vs_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per topic against end offsets."""
    log = log_of(spark, sf_dir)
    return audit.seeded_vs_end(log, offsets.end_offsets(log))


# Offsets and lag -------------------------------------------------------------------------------


@registered
def end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: end offset per partition."""
    return offsets.end_offsets(log_of(spark, sf_dir))


@registered
def end_offsets_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End offsets of one topic under their key."""
    return offsets.end_offsets_by_name(log_of(spark, sf_dir), "view")


@registered
def next_offsets_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next offset per partition over accepted records."""
    return offsets.next_offsets(documents.classify(damaged_log(spark, sf_dir), "json", EVENT_DOC))


@registered
def commit_ledger_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, W2: commit rounds of a day."""
    return _ledger(spark, sf_dir).select(
        "group_id",
        F.unix_seconds("round").alias("round_s"),
        "topic",
        "partition",
        "next_offset",
        F.unix_seconds("commit_at").alias("commit_s"),
        "n_ok",
        "n_bad",
    )


@registered
def committed_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: committed offsets at a moment."""
    return _committed(spark, sf_dir)


@registered
def lag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, P12-P15, ST11: lag of every partition and group."""
    return _lag(spark, sf_dir)


@registered
def lag_uncommitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with partitions nothing was committed for; the last of them are only two days old."""
    early = F.lit("2024-01-03 12:00:00").cast("timestamp")
    ends = offsets.end_offsets(log_of(spark, sf_dir).filter(F.col("timestamp") < early))
    committed = offsets.committed_as_of(_ledger(spark, sf_dir), early)
    return offsets.lag_report(committed, ends, include_uncommitted=True)


@registered
def lag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: total lag, largest lag and where."""
    return offsets.lag_summary(_lag(spark, sf_dir))


@registered
def lag_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five partitions furthest behind."""
    return offsets.top_laggards(_lag(spark, sf_dir), 5).select("lag_key", "lag")


@registered
def lag_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total lag at every daily poll."""
    history = offsets.lag_history(log_of(spark, sf_dir), _ledger(spark, sf_dir), DAY)
    return history.select("group_id", F.unix_seconds("poll").alias("poll_s"), "total_lag")


@registered
def lag_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls without progress, per topic of the log taken as a group of its own."""
    log = log_of(spark, sf_dir)
    group = group_name(F.col("topic"))
    classified = documents.classify(log, "json", EVENT_DOC)
    ledger = offsets.commit_ledger(classified, group, DAY)
    history = offsets.lag_history(log, ledger, DAY)
    return offsets.stall_count(history, expected=0)


@registered
def replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5: records read again after a crash, per partition."""
    again = offsets.replay_window(log_of(spark, sf_dir), _committed(spark, sf_dir))
    return again.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset")
    )


def _zoned(spark: SparkSession, sf_dir: str) -> ZoneMap:
    """The event log as files of increasing offsets, and the map of them."""
    path = scratch_dir(spark, "log")
    write_log(log_of(spark, sf_dir).repartitionByRange(8, "offset"), path)
    return ZoneMap(spark, path, scratch_dir(spark, "zones")).extend()


@registered
def replay_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5, S7: records read again after a crash, from the files that hold some."""
    again = _zoned(spark, sf_dir).replay(_committed(spark, sf_dir))
    return again.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset"), F.sum(F.length("value")).alias("n_chars")
    )


@registered
def zoned_end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: end offsets from the zone map of a log, which isn't read for them."""
    return _zoned(spark, sf_dir).end_offsets()


@registered
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of missing offsets."""
    return offsets.offset_gaps(log_of(spark, sf_dir))


@registered
def offset_gap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing offsets per partition."""
    return offsets.gap_totals(log_of(spark, sf_dir))


@registered
def group_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer groups of every core, in both modes."""
    return targets_of(spark, sf_dir).select(
        "core",
        group_name(F.col("collection")).alias("routed_group"),
        group_name(F.col("collection"), F.col("core"), all_shards=True).alias("all_shard_group"),
    )


@registered
def ingest_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: the status row of a stopped job at a moment, with the lag of every partition."""
    status = ingest_status(_lag(spark, sf_dir), "STOPPED", "core1")
    entries = F.array_sort(F.map_entries("consumer_group_lag"))
    shown = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return status.withColumn("consumer_group_lag", shown)


# Rates -----------------------------------------------------------------------------------------


@registered
def interval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: documents, running total and average time per hour."""
    per = metrics.interval_metrics(log_of(spark, sf_dir), 3600)
    return per.select(
        F.unix_seconds("interval_start").alias("interval_s"),
        "n_docs",
        "total_docs",
        "elapsed_ms",
        F.round("avg_ms_per_doc", 6).alias("avg_ms_per_doc"),
        F.round("busy_seconds", 3).alias("busy_seconds"),
    )


@registered
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per second of every topic."""
    return metrics.throughput(log_of(spark, sf_dir), "topic").select(
        "topic",
        "n_docs",
        F.round("seconds", 3).alias("seconds"),
        F.round("docs_per_second", 9).alias("docs_per_second"),
    )


@registered
def send_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running rate after every thousand sends."""
    return metrics.send_rate(log_of(spark, sf_dir), "offset", every=1000).select(
        "chunk",
        "n_sent",
        "total_sent",
        "elapsed_ms",
        F.round("docs_per_second", 9).alias("docs_per_second"),
    )


# Generated documents ---------------------------------------------------------------------------


@registered
def random_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: a random document per stored document."""
    return random_documents(table(spark, sf_dir, "documents"), size=100, seed=7, number="doc_id")


@registered
def sample_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small document per event."""
    events = table(spark, sf_dir, "events")
    return sample_documents(events, F.col("ts").cast("timestamp"), seed=7, number="event_id")


@registered
def seeded_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON files, read back and sent as records."""
    path = scratch_dir(spark, "documents")
    write_documents(table(spark, sf_dir, "documents"), path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = read_documents(spark, path, schema, multi_line=False)
    records = as_records(docs, "docs", "doc_id").withColumn("seq", F.col("key").cast("bigint"))
    placed = with_positions(records, "seq", LOG_PARTITIONS, F.timestamp_seconds("seq"))
    decoded = documents.decode(placed, "json", schema)
    return documents.normalise(decoded, schema).select(
        "topic", "partition", "offset", "key", "doc_id", "lang", "source", "n_chars", "text"
    )


# Streams ---------------------------------------------------------------------------------------


def _ingest(
    spark: SparkSession,
    sf_dir: str,
    value: Column | str = "props",
    log: Callable[[DataFrame], DataFrame] | None = None,
    run: bool = True,
    **settings,
) -> Ingest:
    """Run the ingest job over the events to their end, into a fresh folder.

    The topics are those of the table: every event type.
    """
    log = log or (lambda events: event_log(events, value))
    events = table(spark, sf_dir, "events")
    topics = [row[0] for row in events.select("event_type").filter("event_type IS NOT NULL").distinct().collect()]
    config = IngestConfig(
        collection=COLLECTION,
        topics=sorted(topics) or ["none"],
        source=f"{sf_dir}/events.parquet",
        store=scratch_dir(spark, "ingest"),
        **{"schema": EVENT_DOC, **settings},
    )
    job = Ingest(
        spark,
        config,
        stream=log(stream_events(spark, sf_dir)),
        log=log(events),
    )
    if run:
        job.run_to_end()
    return job


@registered
def stream_current_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, ST4, ST7, S11: the collection after a streaming run."""
    job = _ingest(spark, sf_dir, num_shards=SHARDS)
    return _shown(job.store.current())


@registered
def stream_compacted_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3, ST1: the collection read from a bucketed snapshot."""
    job = _ingest(spark, sf_dir, num_shards=SHARDS)
    job.store.compact()
    return _shown(job.store.current())


@registered
def stream_docs_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, ST1, U3 with clocks that run backwards: the collection after a run, compacted."""
    job = _ingest(spark, sf_dir, log=lambda e: event_log(e.withColumn("ts", shifted_time())), num_shards=SHARDS)
    job.store.compact()
    return _shown(job.store.current())


def _by_id(spark: SparkSession, sf_dir: str) -> Ingest:
    log = lambda e: event_log(e, envelope_value(with_gaps=True), key=gapped_key())
    return _ingest(spark, sf_dir, log=log, schema=ENVELOPE_DOC, id_field="id", num_shards=SHARDS)


@registered
def stream_docs_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, ST1 by document id."""
    current = _by_id(spark, sf_dir).store.current()
    return current.select("key", "topic", "partition", "offset", F.col("doc.amount").alias("amount"))


@registered
def stream_nameless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with neither a document id nor a key are set aside."""
    return _by_id(spark, sf_dir).store.quarantine().select(
        "topic", "partition", "offset", "key", "value", "error_class", "error_detail"
    )


@registered
def stream_all_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, A8, ST1: documents per shard after a streaming run in all-shard mode."""
    job = _ingest(spark, sf_dir, num_shards=SHARDS, routing="all")
    return audit.shard_counts(job.store.current())


@registered
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a streaming run sets aside; of the reason in words, whether there is one."""
    job = _ingest(spark, sf_dir, damaged_value())
    return job.store.quarantine().select(
        "topic", "partition", "offset", "key", "value", "error_class", F.col("error_detail").isNotNull().alias("has_detail")
    )


@registered
def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7, ST11: lag of every partition after the run; what is left are bad records at the end."""
    return _ingest(spark, sf_dir, damaged_value()).lag()


@registered
def stream_lag_before_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: lag of a job that has not run yet: everything the log holds."""
    return offsets.lag_summary(_ingest(spark, sf_dir, run=False).lag())


@registered
def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, ST1: runs of missing offsets from what batches kept of theirs, folded by compaction."""
    job = _ingest(spark, sf_dir, track_offsets=True)
    job.store.compact()
    return job.store.gaps()


@registered
def stream_commit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3, W2: commit rounds of a streaming run over a damaged log: a batch is a round."""
    ledger = _ingest(spark, sf_dir, damaged_value()).store.ledger()
    return ledger.groupBy("group_id", "topic", "partition").agg(
        F.max("next_offset").alias("next_offset"), F.sum("n_ok").alias("n_ok"), F.sum("n_bad").alias("n_bad")
    )
