"""Consistency checks of a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docstream.constants import ACTIVE_STATE


def doc_count(current: DataFrame, key: str = "key") -> DataFrame:
    """Documents of the collection (A5, L1)."""
    return current.agg(F.count_distinct(key).alias("n_docs"))


def shard_counts(current: DataFrame) -> DataFrame:
    """Documents per shard (A6); ``current`` has one row per document and shard."""
    return current.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_docs"))


def shard_sum_check(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: shard counts must add up to the number of documents."""
    return counts.agg(
        F.sum("n_docs").alias("shard_sum"), expected.scalar().alias("expected")
    ).withColumn("agrees", F.col("shard_sum").eqNullSafe(F.col("expected")))


def shard_count_check(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """In all-shard mode every shard must hold every document: the shards that do not."""
    return counts.withColumn("expected", expected.scalar()).filter(
        ~F.col("n_docs").eqNullSafe(F.col("expected"))
    )


def of_collection(targets: DataFrame, collection: str) -> DataFrame:
    return targets.filter(F.col("collection") == collection)


def inactive_targets(targets: DataFrame) -> DataFrame:
    """Replicas that are not active."""
    return targets.filter(~F.col("state").eqNullSafe(ACTIVE_STATE))


def replica_mismatches(targets: DataFrame) -> DataFrame:
    """Shards whose replicas disagree on the number of documents."""
    return (
        targets.groupBy("collection", "shard_id")
        .agg(
            F.min("num_docs").alias("min_docs"),
            F.max("num_docs").alias("max_docs"),
            F.count(F.lit(1)).alias("n_replicas"),
            F.count_if(F.col("num_docs").isNull()).alias("n_unknown"),
        )
        .filter((F.col("min_docs") != F.col("max_docs")) | (F.col("n_unknown") > 0))
    )


def error_report(mismatches: DataFrame) -> DataFrame:
    """One message per disagreeing shard."""
    return mismatches.select(
        "collection",
        "shard_id",
        F.format_string(
            "shard %d: between %d and %d documents", "shard_id", "min_docs", "max_docs"
        ).alias("message"),
    )


def seeded_vs_end(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Per topic: records sent against the sum of end offsets; equal when offsets are dense."""
    sent = log.groupBy("topic").agg(F.count(F.lit(1)).alias("n_records"))
    reached = ends.groupBy("topic").agg(F.sum("end_offset").alias("end_sum"))
    return (
        sent.join(reached, "topic", "full_outer")
        .select(
            "topic",
            F.coalesce("n_records", F.lit(0)).alias("n_records"),
            F.coalesce("end_sum", F.lit(0)).alias("end_sum"),
        )
        .withColumn("agrees", F.col("n_records") == F.col("end_sum"))
    )
