"""Record logs as batch tables and streams, and keyed record sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from docstream.config import IngestConfig
from docstream.operators.offsets import POSITION, end_offsets, in_topics
from docstream.schema import RECORD_LOG

RECORD_COLUMNS = RECORD_LOG.fieldNames()


def as_record_log(df: DataFrame, topic, partition, offset, key, value, timestamp) -> DataFrame:
    """Any table as a record log: one expression per record column."""
    exprs = dict(
        topic=topic, partition=partition, offset=offset, key=key, value=value, timestamp=timestamp
    )
    return df.select(
        *[_column(exprs[f.name]).cast(f.dataType).alias(f.name) for f in RECORD_LOG.fields]
    )


def _column(expr: Column | str) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


def kafka_options(config: IngestConfig, streaming: bool = True) -> dict[str, str]:
    """Options of the Kafka source.

    Offsets live in the query's checkpoint; the client never commits by itself.
    """
    options = {
        "kafka.bootstrap.servers": config.source,
        "subscribe": ",".join(config.topics),
        "startingOffsets": config.starting_offsets,
        "kafka.max.poll.interval.ms": str(config.poll_interval_ms),
    }
    if streaming:
        options["maxOffsetsPerTrigger"] = str(config.batch_limit)
    else:
        options["startingOffsets"] = "earliest"
    for name, value in config.kafka_options.items():
        if name.endswith("enable.auto.commit"):
            raise ValueError("offsets are kept in the checkpoint; auto commit cannot be set")
        options[name] = str(value)
    return options


def _from_kafka(raw: DataFrame) -> DataFrame:
    return as_record_log(
        raw,
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "timestamp",
    )


def starting_positions(committed: DataFrame) -> str:
    """Committed offsets in the form the Kafka source takes: one entry per partition."""
    row = committed.groupBy("topic", "partition").agg(F.min("committed_offset").alias("o"))
    by_topic = row.groupBy("topic").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "o"))).alias("ends")
    )
    return by_topic.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "ends"))))
    ).first()[0]


def read_log(
    spark: SparkSession, config: IngestConfig, committed: DataFrame | None = None
) -> DataFrame:
    """Records of the configured topics as a batch table.

    With ``committed``, Kafka is read from those offsets on, if there are any.
    """
    if config.source_kind == "kafka":
        options = kafka_options(config, streaming=False)
        if committed is not None and not committed.isEmpty():
            options["startingOffsets"] = starting_positions(committed)
        return _from_kafka(spark.read.format("kafka").options(**options).load())
    log = spark.read.schema(RECORD_LOG).parquet(config.source)
    return log.select(*RECORD_COLUMNS).filter(in_topics(config.topics))


def stream_log(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Records of the configured topics as a stream with the columns of ``RECORD_LOG``."""
    if config.source_kind == "kafka":
        options = kafka_options(config)
        return _from_kafka(spark.readStream.format("kafka").options(**options).load())
    log = (
        spark.readStream.schema(RECORD_LOG)
        .option("maxFilesPerTrigger", config.batch_limit)
        .parquet(config.source)
        .select(*RECORD_COLUMNS)
        .filter(in_topics(config.topics))
    )
    return log if config.starting_offsets == "earliest" else _from_latest(spark, config, log)


def _from_latest(spark: SparkSession, config: IngestConfig, stream: DataFrame) -> DataFrame:
    """Start of a parquet replay at the ends found on its first run (S3).

    The ends are kept beside the checkpoint, so a restart goes on from the same place. Partitions
    that appear later are read from their beginning.
    """
    path = f"{config.store}/starting_offsets"
    try:
        start = spark.read.parquet(path)
    except AnalysisException:
        ends = end_offsets(read_log(spark, config))
        ends.write.mode("errorifexists").parquet(path)
        start = spark.read.parquet(path)
    return (
        stream.join(start, POSITION, "left")
        .filter(F.col("offset") >= F.coalesce("end_offset", F.lit(0)))
        .select(*RECORD_COLUMNS)
    )


def write_keyed_kafka(records: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Send (topic, key, value) rows to Kafka; the broker assigns partitions and offsets."""
    (
        records.select("topic", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .options(**options)
        .save()
    )


def with_positions(
    records: DataFrame, seq: str, num_partitions: int, timestamp: Column | str = "timestamp"
) -> DataFrame:
    """Give (topic, key, value) rows a place in a log from their dense send number.

    Numbers 0, 1, 2, ... are dealt round over the partitions, so every partition has dense offsets
    and nothing has to be sorted. Meant for logs whose keys occur once.
    """
    return as_record_log(
        records,
        "topic",
        F.pmod(F.col(seq), F.lit(num_partitions)),
        F.floor(F.col(seq) / num_partitions),
        "key",
        "value",
        timestamp,
    )


def write_log(records: DataFrame, path: str, mode: str = "append", by_topic: bool = False) -> None:
    """Record log as parquet files (S10); ``by_topic`` gives every topic a folder of its own."""
    writer = records.select(*RECORD_COLUMNS).write.mode(mode)
    if by_topic:
        writer = writer.partitionBy("topic")
    writer.parquet(path)
