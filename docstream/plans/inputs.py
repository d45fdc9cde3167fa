"""Record logs and targets derived from the analytics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstream.config import MAX_FILES_PER_TRIGGER
from docstream.sources.record_log import as_record_log

LOG_PARTITIONS = 10
EVENT_DOC = "k int"

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream; the pattern lets the table be one file or a folder of files."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
        .parquet(f"{sf_dir}/events.parquet*")
    )


def event_log(
    events: DataFrame,
    value: Column | str = "props",
    partition: Column | None = None,
    key: Column | str = "user_id",
) -> DataFrame:
    """Record log of events: topic per event type, key per user, offset is the event id."""
    return as_record_log(
        events,
        topic="event_type",
        partition=F.pmod(F.col("user_id"), F.lit(LOG_PARTITIONS)) if partition is None else partition,
        offset="event_id",
        key=key,
        value=value,
        timestamp="ts",
    )


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(table(spark, sf_dir, "events"))


def damaged_value() -> Column:
    """Event properties with every kind of bad value in them; the first matching rule counts."""
    props, number = F.col("props"), F.col("event_id")
    return (
        F.when(number % 97 == 0, F.substring(props, F.lit(1), F.length(props) - 1))
        .when(number % 101 == 0, F.lit("null"))
        .when(number % 103 == 0, F.lit("[1]"))
        .when(number % 107 == 0, F.lit(None).cast("string"))
        .when(number % 109 == 0, F.lit('{"k": "x"}'))
        .otherwise(props)
    )


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(table(spark, sf_dir, "events"), damaged_value())


def envelope_value(with_gaps: bool = False) -> Column:
    """Events as whole documents that carry their id; every 41st id is wrong.

    ``with_gaps``: every 43rd document has no id.
    """
    number = F.col("event_id")
    doc_id = F.concat(F.col("user_id").cast("string"), F.when(number % 41 == 0, "x").otherwise(""))
    if with_gaps:
        doc_id = F.when(number % 43 != 0, doc_id)
    return F.to_json(F.struct(doc_id.alias("id"), "event_type", F.col("value").alias("amount")))


def gapped_key() -> Column:
    """User as key; every third event has none."""
    return F.when(F.col("event_id") % 3 != 0, F.col("user_id"))


def envelope_log(spark: SparkSession, sf_dir: str, with_gaps: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return event_log(events, envelope_value(with_gaps), key=gapped_key() if with_gaps else "user_id")


def shifted_time() -> Column:
    """Event times as clocks that run backwards by up to six days tell them."""
    return F.col("ts") - F.make_dt_interval(days=(F.col("event_id") % 7).cast("int"))


def shifted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(table(spark, sf_dir, "events").withColumn("ts", shifted_time()))


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as wide records: keyed by language and source, the newest has the largest id."""
    docs = table(spark, sf_dir, "documents")
    return as_record_log(
        docs,
        topic="lang",
        partition=F.lit(0),
        offset="doc_id",
        key=F.concat_ws(":", "lang", "source"),
        value=F.to_json(F.struct(*docs.columns)),
        timestamp=F.timestamp_seconds("doc_id"),
    )


def lost_copy() -> Column:
    """Documents that the damaged copy of shard 2 has lost: those with odd keys."""
    return (F.col("shard_id") == 2) & (F.col("key").cast("bigint") % 2 == 1)


def targets_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicas of two collections of four shards, dealt from the suppliers."""
    number = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("c"), (number % 2).cast("string")).alias("collection"),
        (number % 4).cast("int").alias("shard_id"),
        F.col("s_name").alias("core"),
        F.element_at(
            F.array(F.lit("NRT"), F.lit("TLOG"), F.lit("PULL")), (F.col("s_nationkey") % 3 + 1).cast("int")
        ).alias("replica_type"),
        F.when(number % 17 == 0, "down").otherwise("active").alias("state"),
        number.alias("number"),
        (100 + number % 4 + F.when(number % 29 == 0, 1).otherwise(0)).cast("bigint").alias("num_docs"),
    )
    leaders = base.groupBy("collection", "shard_id").agg(F.min("number").alias("leader"))
    return base.join(leaders, ["collection", "shard_id"]).select(
        "collection",
        "shard_id",
        "core",
        "replica_type",
        "state",
        (F.col("number") == F.col("leader")).alias("is_leader"),
        "num_docs",
    )
