"""Names, keys and ids built from columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docstream.constants import GROUP_PREFIX, GROUP_SEPARATOR, SAMPLE_ID_PREFIX


def group_name(collection: Column, core: Column | None = None, all_shards: bool = False) -> Column:
    """Consumer group of a collection; in all-shard mode every core reads under its own."""
    parts = [F.lit(GROUP_PREFIX), collection]
    if all_shards and core is not None:
        parts.append(core)
    return F.concat_ws(GROUP_SEPARATOR, *parts)


def is_importer_group(group_id: Column) -> Column:
    return group_id.contains(GROUP_PREFIX)


def lag_key(topic: Column, partition: Column, group_id: Column) -> Column:
    """``topic-partition:group``, the key of one lag entry."""
    return F.concat(topic, F.lit("-"), partition.cast("string"), F.lit(":"), group_id)


def end_key(topic: Column, partition: Column) -> Column:
    """Topic and partition without a separator, the key of one end offset."""
    return F.concat(topic, partition.cast("string"))


def shard_of(key: Column, num_shards: int, method: str = "murmur3") -> Column:
    """Shard of a key.

    ``murmur3`` is the hash of Spark's own exchanges and buckets: with a partition count that is a
    multiple of ``num_shards``, rows shuffled by key are already apart by shard. ``md5`` gives the
    same numbers in any SQL engine.
    """
    if method == "murmur3":
        return F.pmod(F.hash(key), F.lit(num_shards))
    if method == "md5":
        head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
        return F.pmod(head, F.lit(num_shards)).cast("int")
    raise ValueError(f"Unknown shard method: {method}")


def base64_text(text: Column) -> Column:
    """Base64 on one line; Spark may break its own into lines of 76."""
    return F.replace(F.base64(text.cast("binary")), F.lit("\r\n"), F.lit(""))


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped id that is the same on every attempt of a task (P10)."""
    digest = F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def sample_id(*parts: Column) -> Column:
    return F.concat(F.lit(SAMPLE_ID_PREFIX), stable_uuid(*parts))


def date_text(moment: Column) -> Column:
    """Timestamp as text in the form ``Mon Jan 01 00:00:00 UTC 2024``."""
    return F.date_format(moment, "EEE MMM dd HH:mm:ss z yyyy")
