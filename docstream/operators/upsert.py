"""Current version of every document: last write wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from docstream.schema import LOG_POSITION, PARTITION_ORDER


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], strategy: str) -> DataFrame:
    """Newest row per key by ``order``, all columns kept."""
    keys, order = list(dict.fromkeys(keys)), list(order)
    if strategy == "group_limit":
        newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
        return (
            df.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") == 1)
            .drop("_rank")
        )
    if strategy != "aggregate":
        raise ValueError(f"Unknown strategy: {strategy}")
    order_cols = [c for c in order if c not in keys]
    payload = [c for c in df.columns if c not in keys and c not in order_cols]
    whole = F.struct(*order_cols, *payload)
    if all(_orderable(df.schema[c].dataType) for c in payload):
        # Order columns come first and decide; the payload rides along in the same struct.
        newest = F.max(whole)
    else:
        newest = F.max_by(whole, F.struct(*order_cols))
    return (
        df.groupBy(*keys)
        .agg(newest.alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )


def latest_per_partition(
    df: DataFrame, keys: Sequence[str] = ("key",), strategy: str = "aggregate"
) -> DataFrame:
    """Last arrival per key and (topic, partition): the largest offset; times do not matter.

    This is the grain that snapshots are kept at: merging it is associative, so no compaction
    changes a result.
    """
    return _newest(df, [*keys, *LOG_POSITION], ["offset"], strategy)


def between_partitions(
    df: DataFrame, keys: Sequence[str] = ("key",), strategy: str = "aggregate"
) -> DataFrame:
    """One version per key out of the last arrivals of several partitions: the latest time.

    Offsets of different partitions say nothing about each other; equal times are told apart by
    topic and partition.
    """
    return _newest(df, keys, PARTITION_ORDER, strategy)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str] = ("key",),
    order: Sequence[str] | None = None,
    strategy: str = "aggregate",
) -> DataFrame:
    """Newest row per key, all columns kept.

    Of a record log, within a (topic, partition) the largest offset wins, then between partitions
    the latest time. Other tables name their ``order``.

    ``aggregate`` keeps one row per key in every map task before the shuffle, so a key with any
    share of the rows sends at most one row per task. ``group_limit`` ranks instead, with the
    """
    if order is not None:
        return _newest(df, keys, order, strategy)
    return between_partitions(latest_per_partition(df, keys, strategy), keys, strategy)


def union_logs(*logs: DataFrame) -> DataFrame:
    """One log of several topics or replays."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def merge_latest(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = ("key",),
    buckets: int | None = None,
) -> DataFrame:
    """Last arrivals per key and partition of a snapshot and the changes since.

    With ``current`` bucketed by key into ``buckets``, only the changes are shuffled, brought down
    to one version per key and partition and dealt into the same buckets. The union keeps that
    partitioning, so the aggregate over it, and the choice between partitions after it, need no
    exchange, and the result can be written bucketed as it is.
    """
    if buckets is not None:
        changes = latest_per_partition(changes, keys).repartition(buckets, "key")
    return latest_per_partition(current.unionByName(changes), keys)


def key_partition_violations(log: DataFrame) -> DataFrame:
    """Per topic: keys, and keys found in more than one partition (U4).

    Versions of a key are ordered only within one partition, so such keys have no order of arrival.
    """
    per_key = log.groupBy("topic", "key").agg(
        (F.min("partition") != F.max("partition")).alias("split")
    )
    return per_key.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if("split").alias("n_split_keys")
    )
