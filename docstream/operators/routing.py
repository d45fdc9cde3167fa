"""Routing of documents to shards and replicas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docstream.functions.names import shard_of
from docstream.operators.upsert import _orderable

# Copies of each target that documents of its collection are dealt to.
SALTS = 32
# Rows, or targets, that a fan-out handles as one.
BLOCK_ROWS = 256
# Blocks of targets that all rows of a task are met with before the next.
SLAB_BLOCKS = 32


def assign_shard(df: DataFrame, num_shards: int, key: str = "key", method: str = "murmur3") -> DataFrame:
    """Hash routing: every key belongs to one shard."""
    return df.withColumn("shard_id", shard_of(F.col(key), num_shards, method))


def every_shard(df: DataFrame, num_shards: int) -> DataFrame:
    """All-shard routing: one copy of every row per shard (R2).

    A generator inside the task: rows are read and decoded once, and nothing is joined.
    """
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(num_shards - 1))).alias("shard_id"))


def _blocks(df: DataFrame, by: list[str], name: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows with the same ``by`` as arrays ``name`` of at most ``BLOCK_ROWS``, numbered from 0 by ``_block``."""
    before = F.row_number().over(Window.partitionBy(*by).orderBy(*by, *order)) - 1
    row = F.struct(*[c for c in df.columns if c not in by])
    numbered = df.withColumn("_block", F.floor(before / BLOCK_ROWS))
    return numbered.groupBy(*by, "_block").agg(F.collect_list(row).alias(name))


def fan_out(df: DataFrame, targets: DataFrame, key: str = "key", salts: int = SALTS) -> DataFrame:
    """One copy of every row per target of its own collection, with the target's columns.

    An equi-join of blocks on the collection, a slab of its targets and a salt: rows get a salt by
    hash of their key, and blocks of targets, a few for each collection, are repeated for every
    salt. So a collection with most of the rows is met by many tasks, and adaptive execution
    broadcasts the targets where they are small. The plan is the same for every number of targets.

    The result is a product and may be far larger than both tables, so its order counts: the same
    block of rows follows for one target after the other, slab by slab. Values of targets come in
    runs, those of rows repeat within a few kilobytes, and few targets are met in a row group, so
    that columnar files keep dictionaries for them and shrink what is repeated.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    rows = _blocks(salted, ["collection", "_salt"], "_rows")
    slab = F.floor(F.col("_block") / SLAB_BLOCKS).alias("_slab")
    # Slabs of a collection go to different tasks, so a repeated attempt has to number targets alike.
    order = [f.name for f in targets.schema if f.name != "collection" and _orderable(f.dataType)]
    cores = _blocks(targets, ["collection"], "_targets", order).select("collection", slab, "_targets", numbers.alias("_salt"))
    last = F.floor((F.count(F.lit(1)) - 1) / (BLOCK_ROWS * SLAB_BLOCKS))
    counted = targets.groupBy("collection").agg(last.alias("_last"))
    slabs = counted.select("collection", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_slab"))
    slabs = slabs.withColumn("_salt", numbers)
    tiles = rows.join(slabs, ["collection", "_salt"]).join(cores, ["collection", "_slab", "_salt"])
    # A function over an array is not compiled into the join. Compiled code keeps all that comes of
    # a row of the join before it hands on the first; so there is one target at a time.
    target = F.explode(F.transform("_targets", lambda t: t)).alias("_target")
    return tiles.select("collection", "_rows", target).select("collection", F.inline("_rows"), "_target.*")


def fan_out_counts(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Copies that every target gets: rows are counted per collection, and the counts are joined."""
    counts = df.groupBy("collection").agg(F.count(F.lit(1)).alias("n_docs"))
    return targets.join(counts, "collection")


def is_eligible(all_shards: bool, clustered: bool = True) -> Column:
    """Targets that read the log themselves."""
    if not clustered or not all_shards:
        return F.lit(True)
    return (F.col("replica_type") == "NRT") | F.col("is_leader")


def eligible_targets(targets: DataFrame, all_shards: bool, clustered: bool = True) -> DataFrame:
    return targets.filter(is_eligible(all_shards, clustered))


def mode_report(targets: DataFrame) -> DataFrame:
    """Per collection: whether all-shard routing is allowed."""
    return targets.groupBy("collection").agg(
        F.bool_or(F.col("replica_type") == "TLOG").alias("has_tlog"),
        (~F.bool_or(F.col("replica_type") == "TLOG")).alias("all_shards_allowed"),
    )


def check_mode(targets: DataFrame, collection: str, all_shards: bool) -> None:
    """Raise unless the collection can run in the wanted mode."""
    if not all_shards:
        return
    tlogs = targets.filter((F.col("collection") == collection) & (F.col("replica_type") == "TLOG"))
    if tlogs.limit(1).count():
        raise ValueError(f"all-shard routing is refused: {collection} has a TLOG replica")
