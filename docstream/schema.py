"""Column layouts shared by the operators and the tables on disk."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

TARGETS = T.StructType(
    [
        T.StructField("collection", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("core", T.StringType()),
        T.StructField("replica_type", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("is_leader", T.BooleanType()),
        T.StructField("num_docs", T.LongType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("round", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("commit_at", T.TimestampType()),
        T.StructField("n_ok", T.LongType()),
        T.StructField("n_bad", T.LongType()),
    ]
)

RANDOM_DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("doc_number", T.IntegerType()),
        T.StructField("doc_double", T.DoubleType()),
        T.StructField("some_flag", T.BooleanType()),
    ]
)

SAMPLE_DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)

LOG_POSITION = ("topic", "partition")

# Order between the last arrivals of a key in several partitions.
PARTITION_ORDER = ("timestamp", *LOG_POSITION)
