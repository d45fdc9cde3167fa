"""Record logs, JSON files, generators, settings."""

import base64
import json
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from docstream.config import IngestConfig, parse_topics
from docstream.operators.offsets import end_offsets
from docstream.operators.routing import assign_shard
from docstream.schema import RANDOM_DOCUMENT, RECORD_LOG, SAMPLE_DOCUMENT
from docstream.sources import generators, json_files, record_log


def config(**changes):
    base = dict(collection="c", topics=("t",), source="broker:9092", store="/s")
    return IngestConfig(**{**base, **changes})


def test_topics():
    assert parse_topics(" a, b,,a ") == ("a", "b")
    assert config(topics="a,b").topics == ("a", "b")


@pytest.mark.parametrize(
    "changes",
    [
        dict(topics=" , "),
        dict(source=""),
        dict(store=""),
        dict(collection=""),
        dict(source_kind="jdbc"),
        dict(routing="random"),
        dict(routing="all", clustered=False),
        dict(starting_offsets="beginning"),
        dict(format="xml"),
        dict(num_shards=0),
        dict(max_per_trigger=0),
        dict(commit_interval_ms=-1),
    ],
)
def test_bad_settings(changes):
    with pytest.raises(ValueError):
        config(**changes)


def test_named_settings():
    read = IngestConfig.from_settings(
        {
            "topicNames": "a,b",
            "kafkaBroker": "h:9092",
            "incomingDataType": "JSON",
            "commitInterval": "7000",
            "ignoreShardRouting": "true",
            "kafkaPollInterval": "1000",
            "kafkaPollRecords": "50",
            "autoOffsetResetConfig": "latest",
        },
        collection="c",
        store="/s",
    )
    assert (read.topics, read.source, read.source_kind, read.format) == (("a", "b"), "h:9092", "kafka", "json")
    assert (read.commit_interval_ms, read.all_shards, read.poll_interval_ms) == (7000, True, 1000)
    assert read.starting_offsets == "latest"
    assert record_log.kafka_options(read)["kafka.max.poll.records"] == "50"
    defaults = IngestConfig.from_settings({"topicNames": "a", "kafkaBroker": "h"}, "c", "/s")
    assert (defaults.commit_interval_ms, defaults.poll_interval_ms, defaults.starting_offsets) == (5000, 45000, "earliest")
    assert not defaults.all_shards


@pytest.mark.parametrize("missing", ["topicNames", "kafkaBroker"])
def test_required_settings(missing):
    settings = {"topicNames": "a", "kafkaBroker": "h"}
    del settings[missing]
    with pytest.raises(ValueError, match=missing):
        IngestConfig.from_settings(settings, "c", "/s")


def test_unknown_start_word():
    with pytest.raises(ValueError):
        IngestConfig.from_settings({"topicNames": "a", "kafkaBroker": "h", "autoOffsetResetConfig": "newest"}, "c", "/s")


def test_kafka_options():
    options = record_log.kafka_options(
        config(source_kind="kafka", topics="a,b", max_per_trigger=10, kafka_options={"kafka.security.protocol": "SSL"})
    )
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "kafka.max.poll.interval.ms": "45000",
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }
    with pytest.raises(ValueError):
        record_log.kafka_options(config(kafka_options={"kafka.enable.auto.commit": "true"}))
    assert "maxOffsetsPerTrigger" not in record_log.kafka_options(config(), streaming=False)


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame([("a", 0, 0, "k", "{}", None), ("b", 0, 0, "k", "{}", None)], RECORD_LOG)
    record_log.write_log(log, path)
    record_log.write_log(log, path)
    assert record_log.read_log(spark, config(source=path, topics="a")).count() == 2
    assert record_log.read_log(spark, config(source=path, topics="a,b")).schema == RECORD_LOG


def test_positions_are_dense(spark):
    docs = generators.random_documents(generators.numbers(spark, 50), 5, keep=("number",))
    records = json_files.as_records(docs, "t", keep=("number",))
    placed = record_log.with_positions(records, "number", 4, F.timestamp_seconds("number"))
    assert placed.schema.simpleString() == RECORD_LOG.simpleString()
    assert rows(end_offsets(placed), "partition", "end_offset") == [(0, 13), (1, 13), (2, 12), (3, 12)]
    first = json.loads(placed.first()["value"])
    assert set(first) == {"id", "text", "doc_number", "doc_double", "some_flag"}


def test_array_file_and_line_file(spark, tmp_path):
    docs = [{"id": "a", "n": 1, "tags": ["x"]}, {"id": "b", "n": None}]
    array = tmp_path / "array.json"
    array.write_text(json.dumps(docs))
    read = json_files.read_documents(spark, str(array))
    assert rows(read, "id", "n") == [("a", 1), ("b", None)]
    json_files.write_documents(read, str(tmp_path / "lines"))
    again = json_files.read_documents(spark, str(tmp_path / "lines"), "id string, n bigint", multi_line=False)
    assert rows(again) == [("a", 1), ("b", None)]
    assert rows(json_files.as_records(read, "t"), "key", "topic") == [("a", "t"), ("b", "t")]


def test_random_documents(spark):
    numbered = generators.numbers(spark, 200)
    docs = generators.random_documents(numbered, 50, seed=1)
    assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in RANDOM_DOCUMENT]
    found = docs.collect()
    assert docs.collect() == found
    assert len({r["id"] for r in found}) == 200
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r["id"]) for r in found)
    assert all(re.fullmatch(r"[-0-9]*", base64.b64decode(r["text"]).decode()) for r in found)
    assert max(len(r["text"]) for r in found) > 400
    assert all(0 <= r["doc_double"] < 1 for r in found)
    assert {r["some_flag"] for r in found} == {True, False}
    assert min(r["doc_number"] for r in found) < 0 < max(r["doc_number"] for r in found)
    assert generators.random_documents(numbered, 50, seed=2).first() != found[0]


def test_sample_and_probe_documents(spark):
    moment = F.lit("2024-01-05 03:04:05").cast("timestamp")
    docs = generators.sample_documents(generators.numbers(spark, 3), moment)
    assert docs.schema.fieldNames() == SAMPLE_DOCUMENT.fieldNames()
    first = docs.first()
    assert first["id"].startswith("doc_") and first["title"] == "Hi mom"
    assert first["date"] == "Fri Jan 05 03:04:05 UTC 2024"
    probes = generators.probe_documents(spark, moment)
    assert rows(probes, "id") == rows(generators.probe_documents(spark, moment), "id")
    assert all(i.startswith("doc_") for (i,) in rows(probes, "id"))
    assert assign_shard(probes, 2, key="id").count() == 2


def test_paced_documents(spark):
    stream = generators.paced_documents(spark, per_second=5, size=10)
    assert stream.isStreaming
    assert isinstance(stream.schema["doc_number"].dataType, T.IntegerType)
